"""Streaming: micro-batches of landed records merged into a corpus, and event-time reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quillfeed.operators.merge import MergeRules, merge_versions, upsert
from quillfeed.session import discard, materialise
from quillfeed.sources import versions

#: Rows of a bucket of keys, on average: a batch rewrites the buckets that it meets, at most so many rows for each of its keys.
ROWS_PER_BUCKET = 16_384
#: Buckets of a corpus that notes no number of its own.
UNNOTED_BUCKETS = 64


def read_corpus(spark: SparkSession, path: str) -> DataFrame | None:
    """The corpus at `path` by its last commit, or None before the first."""
    folders = versions.current(spark, path)
    return _read(spark, path, folders.values()) if folders else None


def _read(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*(f"{path}/{f}" for f in folders)).drop("conflicts")


def buckets_for(rows: int) -> int:
    """The least power of two that gives buckets of `ROWS_PER_BUCKET` rows."""
    return 1 << max(0, (-(-rows // ROWS_PER_BUCKET) - 1).bit_length())


def merge_batch(batch: DataFrame, path: str, key: str, seq: str, rules: MergeRules, buckets: int | None = None) -> None:
    """Merges one micro-batch into the corpus at `path`, a store of versions with a stream for each bucket of keys.

    Only the buckets that the batch meets are read and written again, and one commit names them all: the corpus is
    whole at every moment. The number of buckets follows the corpus, so that a batch costs as its keys, not as the
    corpus: where it has outgrown its buckets by two, it is dealt anew into as many as its rows ask for, which happens
    once each time that it doubles. `buckets` sets a fixed number. Merging a batch again gives the same corpus, so a
    retried micro-batch does no harm. What the merge writes beside the corpus goes with its end.
    """
    spark, scratch = batch.sparkSession, []
    before, noted = versions.current(spark, path), versions.notes(spark, path)
    have = int(noted.get("buckets", UNNOTED_BUCKETS if before else 1))
    try:
        batch = materialise(batch, scratch)
        came = batch.count()
        if not came:
            return
        rows = int(noted["rows"]) if "rows" in noted else _read(spark, path, before.values()).count() if before else 0
        wanted = buckets or buckets_for(rows + came)
        anew = wanted != have if buckets or not before else wanted > 2 * have
        number = wanted if anew else have
        bucket = F.pmod(F.xxhash64(key), F.lit(number)).cast("int")
        if anew:
            stored = list(before.values())
        else:
            met = [str(r[0]) for r in batch.select(bucket).distinct().collect()]  # `number` at most, and the batch's keys
            stored = [before[b] for b in met if b in before]
        old = _read(spark, path, stored) if stored else None
        merged = merge_versions(batch, key, seq, rules) if old is None else upsert(old, batch, key, seq, rules)
        merged = merged.withColumn(seq, F.lit(-1).cast("long")).withColumn("__bucket", bucket)
        name = versions.write_version(merged.repartition("__bucket"), path, partition="__bucket")
        fresh = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/{name}")
        if fresh.filter(F.size("conflicts") > 0).limit(1).count():
            raise ValueError("a record changed what may not change")  # no commit names the folder; a later one deletes it
        total = rows + fresh.count() - (0 if old is None else old.count())  # counts come from the files' footers
        gone = tuple(before) if anew else ()
        versions.commit(spark, path, versions.partitions(spark, path, name, "__bucket"), gone, {"buckets": str(number), "rows": str(total)})
    finally:
        discard(spark, scratch)


def merge_stream(stream: DataFrame, path: str, checkpoint: str, key: str, seq: str, rules: MergeRules, **trigger) -> StreamingQuery:
    """Starts a query that keeps the corpus at `path` merged."""
    handle: Callable[[DataFrame, int], None] = lambda batch, _: merge_batch(batch, path, key, seq, rules)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(events: DataFrame, time: str, kind: str, size: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts by window and kind; works on a batch and, with a watermark that drops state, on a stream."""
    timed = events.withWatermark(time, late) if events.isStreaming else events
    return timed.groupBy(F.window(time, size).alias("w"), kind).agg(F.count(F.lit(1)).alias("n_events")).select(
        F.col("w.start").alias("window_start"), kind, "n_events"
    )


def deduplicated(events: DataFrame, key: str, time: str, within: str = "1 hour") -> DataFrame:
    """Each key once; on a stream within the watermark, so state stays bounded."""
    return events.withWatermark(time, within).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
