"""Joins and groups along time: the last checkpoint before each observation, sessions, and reports at several levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def as_of(observations: DataFrame, checkpoints: DataFrame, key: str, time: str, value: str, span: int, order: str | None = None) -> DataFrame:
    """Each observation with the last checkpoint of its key at or before it: `value` and `<value>_time`, null where none is.

    `time` is a whole number in both. Rows of both sides meet in ranges of `span`: inside a range the last checkpoint
    comes from a window over the range, before its first checkpoint from the ranges before, of which only the last
    checkpoint each goes on. So a hot key spreads over its ranges, and no row meets more than one checkpoint. Of
    checkpoints at one time the greatest `order` (or value) counts. Null times and keys have no checkpoint.
    """
    tie = F.col(order or value)
    marks = checkpoints.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, time, F.struct(F.col(time).alias("t"), tie.alias("o"), F.col(value).alias("v")).alias("__mark"))
    rows = observations.select(F.col(key), F.col(time), F.struct(*observations.columns).alias("__row"))
    both = rows.withColumn("__mark", F.lit(None).cast(marks.schema["__mark"].dataType)).unionByName(marks.withColumn("__row", F.lit(None).cast(rows.schema["__row"].dataType)))
    part = F.floor(F.col(time) / F.lit(span))
    both = both.withColumn("__part", part)
    inside = Window.partitionBy(key, "__part").orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__last", F.max("__mark").over(inside)).filter("__row is not null")
    ends = marks.groupBy(key, part.alias("__part")).agg(F.max("__mark").alias("__end"))
    # Each range's carry is the end of the last range with a checkpoint before it: a window over ranges, not over rows.
    ranges = seen.select(key, "__part").distinct().join(ends, [key, "__part"], "full_outer")
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(key, "__part", F.last("__end", ignorenulls=True).over(before).alias("__carry"))
    joined = seen.join(carried, [key, "__part"], "left")
    mark = F.coalesce("__last", "__carry")
    return joined.select("__row.*", mark["v"].alias(value), mark["t"].alias(f"{value}_time"))


def sessions(events: DataFrame, user: str, time: str, gap: str, late: str = "1 hour") -> DataFrame:
    """(user, session_start, session_end, n_events): runs of a user's events with less than `gap` between two of them.

    The end is the last event's time and the gap. On a stream a session comes when the watermark has passed its end;
    events later than `late` behind the newest are not taken, see `late_rows`.
    """
    timed = events.withWatermark(time, late) if events.isStreaming else events
    grouped = timed.groupBy(F.session_window(time, gap).alias("s"), user).agg(F.count(F.lit(1)).alias("n_events"))
    return grouped.select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")


def late_rows(query: StreamingQuery) -> int:
    """How much a stream has left out as too late, over the batches whose progress is kept.

    Spark counts behind its first merge: of a user's late rows of one batch, those within one gap count once.
    """
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def split_late(batch: DataFrame, time: str, watermark: Column) -> tuple[DataFrame, DataFrame]:
    """(rows in time, rows that came after the watermark had passed them); null times are late."""
    in_time = F.coalesce(F.col(time) >= watermark, F.lit(False))
    return batch.filter(in_time), batch.filter(~in_time)


def levels(rows: DataFrame, sets: list[list[str]], distinct: str, **measures: Column) -> DataFrame:
    """Counts, distinct values and measures of several grouping sets in one pass: one expansion and one shuffle plan.

    Columns of all sets (null where a set leaves one out), `level` (Spark's grouping number), n_rows, n_distinct and the measures.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(
        F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(distinct).alias("n_distinct"), *(m.alias(n) for n, m in measures.items())
    )


#: Bits of a distinct-count sketch: 2^12 registers, a standard error of 1.04 / 2^6.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / (1 << (SKETCH_BITS // 2))


def key_sketches(rows: DataFrame, segment: Column, key: str) -> DataFrame:
    """(segment, n_rows, keys): a mergeable sketch of the distinct keys of each segment, some kilobytes each."""
    return rows.groupBy(segment.alias("segment")).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(key, SKETCH_BITS).alias("keys"))


def estimated_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """(segment, left_keys, right_keys, union_keys, shared_keys) of two snapshots' sketches, without reading their rows.

    Counts have a standard error of `SKETCH_ERROR`; shared keys are a difference of them, with the errors of all three.
    """
    a, b = left.select("segment", F.col("keys").alias("__a")), right.select("segment", F.col("keys").alias("__b"))
    n = lambda c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("long"))
    union = F.when(F.col("__a").isNull(), F.col("__b")).when(F.col("__b").isNull(), F.col("__a")).otherwise(F.hll_union("__a", "__b"))
    counted = a.join(b, "segment", "full_outer").select("segment", n("__a").alias("left_keys"), n("__b").alias("right_keys"), n(union).alias("union_keys"))
    return counted.withColumn("shared_keys", F.greatest(F.lit(0).cast("long"), F.col("left_keys") + F.col("right_keys") - F.col("union_keys")))
