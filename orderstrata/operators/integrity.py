"""Checks of the rules a contract declares. Each returns the offending rows or keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstrata.contracts import Contract
from orderstrata.operators.clean import fitted, strictly


def referenced(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the parent table; rows with a NULL key go too."""
    return df.join(parent.select(key), key, "left_semi").select(df.columns)


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is given but does not occur in the parent table."""
    return (
        df.where(F.col(key).isNotNull())
        .join(parent.select(key), key, "left_anti")
        .select(df.columns)
    )


def unreferenced(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows that :func:`referenced` leaves out: orphans, and rows with a NULL key."""
    return df.join(parent.select(key), key, "left_anti").select(df.columns)


def missing_required(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with a NULL in a column that must be filled."""
    empty = [F.col(name).isNull() for name in contract.required]
    return df.where(reduce(Column.__or__, empty))


def repeated_keys(df: DataFrame, contract: Contract) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(contract.key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def _outside(name: str, allowed: tuple[str, ...]) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).isin(*allowed)


def outside_domain(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with a value that its column does not allow; NULL is allowed."""
    if not contract.domains:
        return df.limit(0)
    bad = [_outside(name, allowed) for name, allowed in contract.domains.items()]
    return df.where(reduce(Column.__or__, bad))


def _faults(contract: Contract, name: str, value: Column, typed: Column) -> list[tuple]:
    """What can be wrong with a value, given as ``value`` and ``typed``, and how it is told."""
    told = F.concat(F.lit(f"{name} does not take "), value.cast("string"))
    faults = [(value.isNotNull() & typed.isNull(), told)]
    if name in contract.required:
        faults.append((value.isNull(), F.lit(f"{name} is empty")))
    if name in contract.domains:
        inside = typed.isin(*contract.domains[name])
        faults.append((~inside, F.concat(F.lit(f"{name} does not allow "), typed)))
    return faults


def _told(faults: dict[str, list[tuple]]) -> Column:
    """The first fault of each column that has one."""
    firsts = [F.coalesce(*[F.when(bad, why) for bad, why in found]) for found in faults.values()]
    return F.array_compact(F.array(*firsts))


def reasons(df: DataFrame, contract: Contract) -> Column:
    """Why the contract does not take a row, an array of texts in its columns' order.

    Of each column one reason at most: a value that does not fit its type, then an empty
    one that must be filled, then one outside its domain. Texts are looked at trimmed.
    """
    return _told(
        {
            name: _faults(contract, name, F.col(name), fitted(df, contract.schema[name]))
            for name in contract.columns
        }
    )


def misfits(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows as they were given that the contract does not take, with the ``reasons``.

    Where :func:`~orderstrata.operators.clean.clean` and :func:`conform` fail, these are
    the rows that make them.
    """
    return df.withColumn("reasons", reasons(df, contract)).where("size(reasons) > 0")


def sort_out(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row cleaned, with the ``reasons`` against it and, if there are any, as it was.

    The contract's columns in their types, NULL where a value does not fit; ``reasons``;
    and ``given``, all columns of ``df``, NULL for a row without reasons. One look at each
    row, so that good and bad ones can be told apart in one scan.
    """
    typed = [fitted(df, field).alias(field.name) for field in contract.schema.fields]
    places = {name: f"_given_{at}" for at, name in enumerate(df.columns)}
    raw = [F.col(name).alias(place) for name, place in places.items()]
    looked_at = [F.col(name).alias(f"_raw_{name}") for name in contract.columns]
    # values are cast once, and reasons made up only for rows that have one
    both = df.select(*typed, *looked_at, *raw)
    faults = {
        name: _faults(contract, name, F.col(f"_raw_{name}"), F.col(name))
        for name in contract.columns
    }
    conditions = [F.coalesce(bad, F.lit(False)) for found in faults.values() for bad, _ in found]
    bad = reduce(Column.__or__, conditions)
    given = F.struct(*[F.col(place).alias(name) for name, place in places.items()])
    why = F.when(bad, _told(faults)).otherwise(F.array().cast("array<string>"))
    return both.select(
        *contract.columns, why.alias("reasons"), F.when(bad, given).alias("given")
    )


def conform(df: DataFrame, contract: Contract, among: Column | None = None) -> DataFrame:
    """The contract's columns in its types, failing the job on a row it does not allow.

    Needs no pass of its own: empty required columns and values outside their
    domain are caught row by row while the table is written. Where ``among`` is given, only
    rows for which it holds are looked at, and other columns stay behind the contract's.
    """
    others = [] if among is None else [c for c in df.columns if c not in contract.columns]
    looked_at = F.lit(True) if among is None else among

    def checked(name: str) -> Column:
        where = f"{contract.name}.{name}"
        value = strictly(df, name, contract.schema[name].dataType, where)
        if name in contract.required:
            missing = F.raise_error(F.lit(f"{where} is empty"))
            value = F.when(looked_at & F.col(name).isNull(), missing).otherwise(value)
        if name in contract.domains:
            told = F.concat(F.lit(f"{where} does not allow "), F.col(name))
            bad = looked_at & _outside(name, contract.domains[name])
            value = F.when(bad, F.raise_error(told)).otherwise(value)
        return value.alias(name)

    return df.select(*[checked(name) for name in contract.columns], *others)
