"""Whether a table is small enough to be sent whole to every executor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The most data a broadcast may hold. Larger than Spark's own limit for it,
# which goes by estimates from file sizes; here the bytes are counted.
BROADCAST_BYTES = 64 * 1024 * 1024
# More rows under one key than a task should sort alone.
HEAVY_ROWS = 1_000_000
# Counters of a task that looks for such keys, and how many keys it names at most. A key with
# more than 3.5 / 16384 of all rows is always seen.
COUNTERS = 10_000
MOST_KEYS = 1_000
# What a row takes for a column of fixed width, at most, and beside each text.
FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows take, by one aggregate over them."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    width = F.lit(FIXED_WIDTH * len(df.columns)).cast("bigint")
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def heavy_keys(
    df: DataFrame, columns: Sequence[str], rows: int = HEAVY_ROWS
) -> dict[str, list[object]]:
    """For each column the values that about ``rows`` rows or more have, None for a missing one.

    One scan of the columns, with a sketch of the most frequent values for each task: nothing
    is shuffled but these. It only finds where a shuffle has to be split, never what is
    kept, so that its counts may be rough.
    """
    counts = [
        count
        for at, name in enumerate(columns)
        for count in (
            F.call_function("approx_top_k", F.col(name), F.lit(MOST_KEYS), F.lit(COUNTERS)).alias(
                f"top{at}"
            ),
            F.count_if(F.col(name).isNull()).alias(f"missing{at}"),
        )
    ]
    found = df.agg(*counts).first()
    return {
        name: [
            entry["item"]
            for entry in found[f"top{at}"]
            if entry["count"] >= rows and entry["item"] is not None
        ]
        + [None] * (found[f"missing{at}"] >= rows)
        for at, name in enumerate(columns)
    }
