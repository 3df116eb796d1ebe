"""Connected components of a graph that is only ever a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstrata.llm.common import stored


def _towards_smallest(pairs: DataFrame, only_smaller: bool) -> DataFrame:
    """Links each node's neighbours to the smallest one; hubs are split by the skew join."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("low"))
    if only_smaller:
        moved = pairs.join(smallest, "u").where("v <> low").select(F.col("v").alias("u"), "low")
        kept = smallest.select("u", "low")
        return moved.unionAll(kept).select("u", F.col("low").alias("v"))
    low = F.least("u", "low")
    moved = pairs.join(smallest, "u").where("v > u")
    return moved.select(F.col("v").alias("u"), low.alias("v")).where("u <> v")


def _state(links: DataFrame) -> tuple[int, int]:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    row = links.agg(F.count("*").alias("n"), total.alias("total")).head()
    return row.n, int(row.total or 0)


def component_roots(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches.

    ``links`` holds two columns of numbers, in either direction, repeated or not;
    loops and rows with a NULL say nothing. Returns ``node`` and ``root``, a row
    for each node with a link to another; none for an empty table. Large and small
    stars in turn (Kiveris et al., 2014): a number of rounds that grows with the
    logarithm of the longest path, two joins a round, each round written to the
    shared folder, nothing but two numbers at the driver.
    """
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_smallest(both, only_smaller=False).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = stored(_towards_smallest(down, only_smaller=True).distinct(), "links")
        now = _state(edges)
        if now == before or now[0] == 0:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
