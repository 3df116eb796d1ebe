"""Tables kept in a database, as an alternative to Parquet."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from orderstrata.contracts import Contract
from orderstrata.operators.integrity import conform
from orderstrata.sources.empty import empty_table
from orderstrata.sources.parts import KEPT, PART, Layout, Parts, counted, counted_by_part


def quoted(text: str) -> str:
    """A text as SQL has it."""
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Split:
    """How to read a table in parallel: ranges of a numeric or date column.

    The bounds only place the ranges; rows outside them are read as well.
    """

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


@dataclass(frozen=True)
class JdbcTables:
    """Named tables of one database; every write replaces the whole table.

    ``properties`` are passed to the driver (user, password, ...). A table is read by
    several tasks by a :class:`Split` of a numeric or date column, or by ``predicates``,
    conditions in the database's SQL that part the rows among them, a task for each. Where
    neither is given but the table has one of the ``keys``, a column's name, the database is
    asked how to part it into ``parts`` by that column, whatever its type (see
    :meth:`planned`); any other table is read by a single task. ``connections`` bounds the
    tasks that write at a time.

    A typed write empties the table and those that refer to it, and keeps their
    definitions: parents are to be written before their children, as the stages do.
    """

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    splits: dict[str, Split] = field(default_factory=dict)
    predicates: dict[str, list[str]] = field(default_factory=dict)
    connections: int = 16
    keys: dict[str, str] = field(default_factory=dict)
    parts: int = 16

    def planned(self, name: str) -> Split | list[str] | None:
        """How to read a table by its key in ``parts``, as the database tells.

        For a key of numbers or dates that is the least and the greatest, between which Spark
        places even ranges. Other keys, as those of raw tables, which are texts, have no such
        ranges: the database numbers its rows in order of the key and names the least one of
        each part. Rows equal in the key stay together, those without one go with the first
        part, and each row belongs to exactly one. None for an empty table.
        """
        column = self.keys[name]
        kind = self._frame(dbtable=name).schema[column].dataType
        dialect = self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        key = dialect.quoteIdentifier(column)
        if isinstance(kind, (NumericType, DateType, TimestampType)):
            asked = f"SELECT min({key}) AS lower_end, max({key}) AS upper_end FROM {name}"
            ends = self._frame(query=asked).first()
            return None if ends[0] is None else Split(column, ends[0], ends[1], self.parts)
        placed = f"SELECT {key} AS k, ntile({self.parts}) OVER (ORDER BY {key}) AS part FROM {name}"
        asked = f"SELECT part, min(k) AS least FROM ({placed} WHERE {key} IS NOT NULL) t GROUP BY part"
        # parts go in the database's own order of texts, which need not be ours
        parts = sorted(tuple(row) for row in self._frame(query=asked).collect())
        lows = [quoted(least) for least in dict.fromkeys(least for _, least in parts)]
        if len(lows) < 2:
            return None
        inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(lows[1:], lows[2:])]
        return [f"{key} < {lows[1]} OR {key} IS NULL", *inner, f"{key} >= {lows[-1]}"]

    def _frame(self, **what: str) -> DataFrame:
        options = {**self.properties, "url": self.url, **what}
        return self.spark.read.format("jdbc").options(**options).load()

    def read_options(self, name: str, split: Split | None = None) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": name}
        split = self.splits.get(name, split)
        return {**options, **split.options()} if split else options

    def write_options(self, name: str, typed: bool) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": name}
        options["numPartitions"] = str(self.connections)
        if typed:
            # Empty the table but keep its definition, and let the database
            # turn text into its own enumerated types.
            options.update(truncate="true", cascadeTruncate="true", stringtype="unspecified")
        return options

    def read_raw(self, name: str) -> DataFrame:
        how = self.predicates.get(name)
        if how is None and name in self.keys and name not in self.splits and self.parts > 1:
            how = self.planned(name)
        if isinstance(how, list):
            return self.spark.read.jdbc(
                self.url, name, predicates=how, properties=self.properties
            )
        return self.spark.read.format("jdbc").options(**self.read_options(name, how)).load()

    def write_raw(self, name: str, df: DataFrame) -> int:
        """Rows written, counted by the job that writes them."""
        rows, counts = counted(df)
        self._save(name, rows, typed=False)
        return counts()[KEPT]

    def _save(self, name: str, df: DataFrame, typed: bool) -> None:
        options = self.write_options(name, typed)
        df.write.format("jdbc").options(**options).mode("overwrite").save()

    def exists(self, contract: Contract) -> bool:
        try:
            return bool(self.read(contract).schema.fields)
        except Exception:  # whatever a driver raises for a table that is not there
            return False

    def read(self, contract: Contract) -> DataFrame:
        return self.read_raw(contract.name)

    def read_for_join(self, left: Contract, right: Contract) -> tuple[DataFrame, DataFrame]:
        return self.read(left), self.read(right)

    def write(self, contract: Contract, df: DataFrame) -> int:
        rows, counts = counted(conform(df, contract))
        self._save(contract.name, rows, typed=True)
        return counts()[KEPT]

    def write_parts(
        self, contract: Contract, df: DataFrame, layout: Layout | None = None
    ) -> Parts:
        """Replaces a table by the rows of ``df`` whose ``part`` is ``kept``; counts all parts.

        The other parts have no table here: their frames are worked out again when asked for.
        A database lays its rows out by itself.
        """
        rows, counts = counted_by_part(df)
        kept = rows.where(F.col(PART) == KEPT).select(contract.columns)
        self._save(contract.name, conform(kept, contract), typed=True)
        found = counts()
        return Parts(found, {part: df.where(F.col(PART) == part).drop(PART) for part in found})

    def count(self, contract: Contract) -> int:
        """Rows of a table, counted by the database."""
        options = {**self.properties, "url": self.url}
        options["query"] = f"SELECT count(*) AS n FROM {contract.name}"
        return int(self.spark.read.format("jdbc").options(**options).load().first()[0])

    def create(self, contract: Contract) -> None:
        self._save(contract.name, conform(empty_table(self.spark, contract), contract), typed=True)
