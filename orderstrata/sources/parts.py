"""Tables written in parts: what becomes of each row, and how the rows are laid out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Parts of a table: its own rows, and those that were looked at and are none of them.
KEPT = "kept"
DUPLICATE = "duplicate"
REJECTED = "rejected"
MALFORMED = "malformed"
PARTS = (KEPT, DUPLICATE, REJECTED, MALFORMED)
# The column that says which part a row belongs to.
PART = "part"


@dataclass(frozen=True)
class Layout:
    """Rows in buckets by the hash of a column, sorted by it: joins on it need no shuffle."""

    column: str
    buckets: int

    def spread(self, df: DataFrame, lost: Column) -> DataFrame:
        """``df``, with any value for the column where ``lost`` rows have none.

        Malformed rows may have no bucket to be in; they would all go to that of NULL.
        """
        kind = df.schema[self.column].dataType
        anywhere = F.pmod(F.xxhash64(*df.columns), F.lit(2**31 - 1)).cast(kind)
        empty = lost & F.col(self.column).isNull()
        return df.withColumn(self.column, F.when(empty, anywhere).otherwise(F.col(self.column)))


@dataclass(frozen=True)
class Parts:
    """Rows of each part, counted while they were written, and the parts as lazy frames."""

    rows: dict[str, int] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)


def _observed(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict]]:
    seen = Observation()
    watched = df.observe(seen, *[count.alias(name) for name, count in counts.items()])
    # nothing was seen where the optimizer found that there is no row at all
    return watched, lambda: {name: seen.get.get(name, 0) for name in counts}


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df``, and its rows as the part ``kept`` once the job that writes it has ended."""
    return _observed(df, {KEPT: F.count(F.lit(1))})


def counted_by_part(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df``, and the rows of each part once the job that reads it whole has ended."""
    return _observed(df, {part: F.count_if(F.col(PART) == part) for part in PARTS})
