"""Connected components of an edge list by alternating stars.

Large and small stars (Kiveris et al., 2014) hang every node under the smallest
node it can see, in a number of rounds that grows with the logarithm of the
longest path. Neighbours are never listed: a round is minima, combined
map-side, and equi-joins whose sides are stored, so that hot nodes can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savormap.storage import cut_lineage


def _minima(edges: DataFrame) -> DataFrame:
    return cut_lineage(edges.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("least")))


def _large(edges: DataFrame) -> DataFrame:
    least = _minima(edges)
    joined = edges.join(least, edges["b"] == least["at"], "left")
    return cut_lineage(joined.select("a", F.coalesce("least", "b").alias("b")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    least = _minima(edges)
    joined = edges.join(least, edges["a"] == least["at"])
    below = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return cut_lineage(below.unionByName(least.select(F.col("at").alias("a"), F.col("least").alias("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node with an edge that isn't the smallest of its component.

    ``edges`` has long columns ``a`` and ``b``; direction, loops and repeats don't matter.
    """
    now = cut_lineage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(now)
    while True:
        now = _small(_large(now))
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
