"""One row per key, and the rows left over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_order(df: DataFrame, key: str) -> list[Column]:
    others = [name for name in df.columns if name != key]
    return [F.asc_nulls_first(name) for name in others or [key]]


def keep_one(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the least by the other columns in their order, NULLs first.

    NULL keys form one group. Asking for the first row only lets the optimizer
    cut every task's rows to one per key before the shuffle (``WindowGroupLimit``),
    so a key held by very many rows sends no more than one from each task.
    """
    within_key = Window.partitionBy(key).orderBy(*_in_order(df, key))
    numbered = df.withColumn("_place", F.row_number().over(within_key))
    return numbered.where("_place = 1").drop("_place")


def marked(
    df: DataFrame,
    key: str,
    heavy: Sequence[object] = (),
    columns: Sequence[str] = (),
    among: Column | None = None,
) -> DataFrame:
    """Every row, with a flag ``kept`` on those that :func:`keep_one` keeps.

    One shuffle of the rows. ``heavy`` lists keys that too many rows have for one task, None
    for a missing one (see :func:`orderstrata.plans.sizing.heavy_keys`): their rows are
    numbered among those that one task has read, then the first ones of all tasks among each
    other, while all others go by the key as usual. ``columns`` are those that decide which
    row of a key comes first, all if none are named. Rows for which ``among`` does not hold are
    not kept; they stay where they are in the numbering of others, and apart by task.
    """
    order = _in_order(df.select(*columns) if columns else df, key)
    takes_part = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    values = [v for v in heavy if v is not None]
    is_heavy = F.coalesce(F.col(key).isin(values), F.lit(False)) if values else F.lit(False)
    if None in heavy:
        is_heavy = is_heavy | F.col(key).isNull()

    def numbered(rows: DataFrame, apart: Column) -> DataFrame:
        placed = rows.withColumns(
            {
                "_group": F.when(takes_part, F.col(key)),
                "_task": F.when(apart | ~takes_part, F.spark_partition_id()).otherwise(-1),
            }
        )
        near = Window.partitionBy("_group", "_task").orderBy(*order)
        return placed.withColumn("_near", F.row_number().over(near))

    first = takes_part & (F.col("_near") == 1)
    if not heavy:
        light = numbered(df, F.lit(False)).withColumn("kept", first)
        return light.select(*df.columns, "kept")
    light = numbered(df.where(~is_heavy), F.lit(False)).withColumn("kept", first)
    gathered = numbered(df.where(is_heavy), F.lit(True)).withColumn(
        "_task", F.when(first, F.lit(-1)).otherwise(F.col("_task"))
    )
    far = Window.partitionBy("_group", "_task").orderBy(*order)
    gathered = gathered.withColumn("_far", F.row_number().over(far))
    gathered = gathered.withColumn("kept", first & (F.col("_far") == 1))
    return light.select(*df.columns, "kept").unionAll(gathered.select(*df.columns, "kept"))


def torn_keys(df: DataFrame, key: str, column: str) -> DataFrame:
    """Keys whose rows have more than one value of ``column``, with the least of them.

    NULL is one value, less than all others. One shuffle of a narrow row for each key and task.
    """
    found = df.groupBy(key).agg(
        F.min(column).alias("_least"),
        F.max(column).alias("_most"),
        F.max(F.col(column).isNull()).alias("_missing"),
    )
    return found.where("_least < _most OR (_missing AND _most IS NOT NULL)")


def marked_in_place(
    df: DataFrame,
    key: str,
    column: str,
    parts: int,
    columns: Sequence[str] = (),
    among: Column | None = None,
    torn: bool = True,
) -> DataFrame:
    """:func:`marked`, with the rows put into ``parts`` tasks by ``column``, where they stay.

    ``column`` is the key, or the first of those that decide which row of a key comes first.
    Then a key's rows under one value of it lie in one task, and of several values the least
    has the row that is kept. One shuffle of the rows serves the numbering and what comes
    after it; besides, the keys of several values (:func:`torn_keys`) are looked for, unless
    ``torn`` is False as there are none, and take a short row for each value but the least.
    """
    order = _in_order(df.select(*columns) if columns else df, key)
    deciding = [name for name in columns or df.columns if name != key]
    if column != key and column != deciding[0]:
        raise ValueError(f"{column} is not the first column that decides among rows of a {key}")
    takes_part = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    rows = df.withColumns({"_takes_part": takes_part, "_loses": F.lit(False)})
    if torn and column != key:
        pairs = rows.where("_takes_part").select(key, column)
        least = torn_keys(pairs, key, column).select(F.col(key).alias("_key"), "_least", "_missing")
        met = pairs.join(least, F.col(key).eqNullSafe(F.col("_key")))
        later = (F.col(column) > F.col("_least")) | (F.col("_missing") & F.col(column).isNotNull())
        losing = met.where(later).select(key, column).distinct()
        told = losing.withColumns({"_takes_part": F.lit(True), "_loses": F.lit(True)})
        # a row that loses its group: it comes first there, so that no other one does
        rows = rows.unionByName(told, allowMissingColumns=True)
    group = Window.partitionBy(*dict.fromkeys([column, key, "_takes_part"]))
    placed = rows.repartition(parts, column).withColumn(
        "_place", F.row_number().over(group.orderBy(F.desc("_loses"), *order))
    )
    kept = F.col("_takes_part") & (F.col("_place") == 1)
    return placed.where("NOT _loses").select(*df.columns, kept.alias("kept"))


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row that :func:`keep_one` leaves out, equal rows once each.

    A key is numbered in two steps: first the rows that one task has read, then
    the first ones of all tasks against each other. No group of the first step
    is larger than a task's input, and no group of the second has more first
    rows than there were tasks, however many rows share the key. The price is two
    shuffles of every row, those known to be surplus after the first step included.
    """
    order = _in_order(df, key)
    of_one_task = Window.partitionBy(key, "_task").orderBy(*order)
    near = df.withColumn("_task", F.spark_partition_id()).withColumn(
        "_near", F.row_number().over(of_one_task)
    )
    # Rows known to be surplus stay apart from the first ones, by task as before.
    group = F.when(F.col("_near") == 1, F.lit(-1)).otherwise(F.col("_task"))
    of_all_tasks = Window.partitionBy(key, "_group").orderBy(*order)
    far = near.withColumn("_group", group).withColumn("_far", F.row_number().over(of_all_tasks))
    return far.where("_near > 1 OR _far > 1").select(df.columns)
