"""Connected components by alternating large-star and small-star steps, wholly distributed.

Each step is one grouped minimum and one join, so a hub of any degree is never gathered; AQE may split its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage, discard


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that is not its component's smallest; edges has long columns u and v."""
    past: list[str] = []
    now = cut_lineage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), past)
    mark = _fingerprint(now)
    while mark[0]:
        own: list[str] = []
        now = cut_lineage(_small_star(_large_star(now)), own)
        discard(edges.sparkSession, past)  # the round before has been read for the last time
        past = own
        after = _fingerprint(now)
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
