"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.session import materialise

#: Rows of a key that one task joins, on average.
ROWS_PER_TASK = 65_536
#: Hot keys up to which their list is broadcast (some 40 bytes each); beyond it, the join shuffles.
BROADCAST_KEYS = 200_000


def join_dealt(many: DataFrame, one: DataFrame, keys: list[str], spread: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Joins each row of `many` with the one row of its key in `one`.

    Keys with more than `rows` rows are dealt into parts by the hash of `spread`, and their row of `one` is repeated for
    each part; all other keys join as they are. Null keys join nothing.
    """
    parts = F.ceil(F.col("__rows") / F.lit(rows)).cast("int").alias("__parts")
    hot = materialise(many.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > rows).select(*keys, parts))
    n = hot.count()
    if n == 0:
        return many.join(one, keys)
    hot = F.broadcast(hot) if n <= BROADCAST_KEYS else hot
    share = F.coalesce("__parts", F.lit(1))
    dealt = many.join(hot, keys, "left").withColumn("__part", F.pmod(F.xxhash64(spread), share).cast("int")).drop("__parts")
    copies = one.join(hot, keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), share - 1))).drop("__parts")
    return dealt.join(copies, [*keys, "__part"]).drop("__part")
