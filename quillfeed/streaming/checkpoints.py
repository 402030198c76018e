"""Changed posts on a stream: the checkpoint of every user and post is state, and the lookback is a timer.

An observation is a change if the post was not seen within the lookback before it, or with another count. The state of
a post goes when the watermark has passed its lookback: whatever comes then would find it too old anyway, so timers
bound the state and never decide a result. Posts are held in buckets, each one value of the state store: a micro-batch
reads and writes a bucket that it meets once, whatever the number of its posts, and not each post by calls of its own.
Buckets go by a hash of user and post together, so a hot user spreads over all tasks. The number of buckets belongs to
the state: a query must restart with the same. Observations without a time are changes and leave no state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ("user_id", "post_id", "time_ms", "seq", "reply_count")
#: Buckets of posts. A touched bucket is rewritten, so their number bounds both the calls and what a call carries.
BUCKETS = 1 << 12


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started inside; the session's own setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def observations(df: DataFrame, user: Column, post: Column, time: Column, seq: Column, count: Column) -> DataFrame:
    """user_id, post_id, time (timestamp), time_ms, seq (orders equal times) and reply_count."""
    return df.select(user.alias("user_id"), post.cast("string").alias("post_id"), time.alias("time"), F.unix_millis(time).alias("time_ms"), seq.cast("long").alias("seq"), count.cast("long").alias("reply_count"))


def changes(seen: DataFrame, lookback_ms: int) -> DataFrame:
    """The changes among a table of observations: user_id, post_id, time_ms, seq, previous_count, reply_count."""
    order = Window.partitionBy("user_id", "post_id").orderBy("time_ms", "seq")
    near = F.col("time_ms") - F.lag("time_ms").over(order) <= lookback_ms
    rows = seen.withColumn("previous_count", F.when(near, F.lag("reply_count").over(order))).withColumn("__near", F.coalesce(near, F.lit(False)))
    changed = ~F.col("__near") | ~F.col("reply_count").eqNullSafe(F.col("previous_count"))
    return rows.filter(changed).select("user_id", "post_id", "time_ms", "seq", "previous_count", "reply_count")


class ChangedPosts(StatefulProcessor):
    """The last observations of the posts of one bucket, and the one timer that looks for posts past their lookback."""

    def __init__(self, lookback_ms: int, user_type: str):
        self.lookback_ms, self.user_type = lookback_ms, user_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        post = f"struct<user_id: {self.user_type}, post_id: string, time_ms: bigint, seq: bigint, reply_count: bigint>"
        self.last = handle.getValueState("last", f"timer bigint, posts array<{post}>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, posts = self.last.get() or (None, ())
        known = {(user, post): (t, seq, count) for user, post, t, seq, count in posts}
        seen = [r for frame in rows for r in _with_nulls(frame)]  # the rows of one bucket in one micro-batch
        timed = [r for r in seen if r[2] is not None]
        changed = [(*r[:4], None, r[4]) for r in seen if r[2] is None]
        for user, post, t, seq, count in sorted(timed, key=lambda r: _place(r[2], r[3])):
            before = known.get((user, post))
            if before is not None and _place(t, seq) <= _place(before[0], before[1]):
                continue  # older than what is known, or the same again
            near = before is not None and t - before[0] <= self.lookback_ms
            if not near or before[2] != count:
                changed.append((user, post, t, seq, before[2] if near else None, count))
            known[user, post] = (t, seq, count)
        if timed:
            if timer is None:
                timer = min(v[0] for v in known.values()) + self.lookback_ms + 1
                self.handle.registerTimer(timer)
            self.last.update((timer, [(*k, *v) for k, v in known.items()]))
        if changed:
            yield pd.DataFrame(changed, columns=["user_id", "post_id", "time_ms", "seq", "previous_count", "reply_count"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        live = [tuple(p) for p in self.last.get()[1] if p[2] + self.lookback_ms + 1 > now]
        if live:
            timer = min(p[2] for p in live) + self.lookback_ms + 1
            self.handle.registerTimer(timer)
            self.last.update((timer, live))
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _place(time_ms: int, seq: int | None) -> tuple:
    """Where an observation stands among those of its post; without a number it comes first at its time."""
    return time_ms, seq is not None, seq


def _without_nulls(seen: DataFrame) -> list[Column]:
    """COLUMNS with a value in place of each null, since pandas would read long numbers beside nulls as floats, and `absent`: a bit for each."""
    types = dict(seen.dtypes)
    absent = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(COLUMNS)), F.lit(0))
    return [*(F.coalesce(c, F.lit(0).cast(types[c])).alias(c) for c in COLUMNS), absent.alias("absent")]


def _with_nulls(frame: pd.DataFrame) -> Iterator[tuple]:
    """The rows of COLUMNS as they were."""
    for *row, absent in zip(*(frame[c].tolist() for c in (*COLUMNS, "absent")), strict=True):
        yield tuple(None if absent >> i & 1 else v for i, v in enumerate(row)) if absent else tuple(row)


def changes_on_stream(seen: DataFrame, lookback_ms: int, late: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """`changes` on a stream of observations; rows later than `late` behind the newest are not taken."""
    user_type = seen.schema["user_id"].dataType.simpleString()
    schema = f"user_id {user_type}, post_id string, time_ms long, seq long, previous_count long, reply_count long"
    bucket = F.pmod(F.xxhash64("user_id", "post_id"), F.lit(buckets)).alias("bucket")
    keyed = seen.withWatermark("time", late).select(bucket, "time", *_without_nulls(seen)).groupBy("bucket")
    return keyed.transformWithStateInPandas(ChangedPosts(lookback_ms, user_type), schema, "Append", "EventTime")
