"""Sinks: staged replacement, JSON, Markdown, reports, gated promotion."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfeed.session import materialise
from quillfeed.sources import versions
from quillfeed.sources.landed import exists


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def recover(spark: SparkSession, path: str) -> None:
    """Ends what a stopped replacement of `path` has begun: forward if the new data are whole, else back.

    While the target exists, what lies beside it is of no use. Where it is gone, its old data wait beside it, and the
    staged data, which were whole before the target was touched, take its place.
    """
    fs, target = _fs(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(target.getParent()):
        return
    beside = [s.getPath() for s in fs.listStatus(target.getParent())]
    named = lambda kind: {p.getName().rpartition("-")[2]: p for p in beside if p.getName().startswith(f"{target.getName()}.{kind}-")}
    stages, olds = named("stage"), named("old")
    if not fs.exists(target):
        for run, old in olds.items():
            if run in stages and fs.exists(at(stages[run], "_SUCCESS")):
                fs.rename(stages[run], target)
            else:
                fs.rename(old, target)
            break
    if fs.exists(target):
        for left in (*stages.values(), *olds.values()):
            fs.delete(left, True)


def replace_atomically(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Writes beside the target, then renames twice: the old data go aside, the new take their place.

    On failure the staged files go and the old data stay. A run that stops between any two steps loses nothing:
    `recover`, with which every replacement and `read_stored` begin, finishes it. Streams that must change together,
    or be readable at every moment, are kept in a store of versions.
    """
    spark = df.sparkSession
    recover(spark, path)
    run = uuid.uuid4().hex
    stage, old = f"{path}.stage-{run}", f"{path}.old-{run}"
    fs, target = _fs(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    try:
        df.write.format(fmt).options(**options).save(stage)
    except Exception:
        fs.delete(at(stage), True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, at(old)):
        fs.delete(at(stage), True)
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at(stage), target):
        recover(spark, path)
        raise OSError(f"cannot rename to {path}")
    if had:
        fs.delete(at(old), True)


def read_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """What `replace_atomically` has stored, or None."""
    recover(spark, path)
    return spark.read.format(fmt).load(path) if exists(spark, path) else None


def write_json(df: DataFrame, path: str) -> None:
    """The corpus as JSON lines, null fields kept."""
    replace_atomically(df, path, "json", ignoreNullFields="false")


def markdown_block(kind: str, ordinal: Column) -> Column:
    """One record as a Markdown block."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    head = [F.concat(F.lit("## Reply " if kind == "replies" else "## Post "), ordinal.cast("string")), F.lit("")]
    head += [F.concat(F.lit("ID: "), text("id")), F.concat(F.lit("Time: "), text("created_at"))]
    if kind == "replies":
        head += [F.concat(F.lit("Origin: "), text("origin")), F.concat(F.lit("Post ID: "), text("post_id")), F.concat(F.lit("Post Link: "), text("post_target"))]
    else:
        counts = F.concat(F.lit("Replies: "), number("reply_count"), F.lit(" | Likes: "), number("like_count"), F.lit(" | Reposts: "), number("retweet_count"))
        head += [F.concat(F.lit("Link: "), text("target")), counts, F.when(F.nullif(F.col("title"), F.lit("")).isNotNull(), F.concat(F.lit("Title: "), F.col("title")))]
    return F.concat_ws("\n", *head, F.lit(""), text("clean_text"), F.lit(""), F.lit("---"), F.lit(""))


def render_markdown(records: DataFrame, kind: str, order: list[Column], as_of: str) -> DataFrame:
    """(part, ordinal, value): the header and one block for each record, in corpus order.

    Ordinals come from a range sort and per-partition offsets, not from one global window.
    """
    ordered = records.orderBy(*order)
    with_part = ordered.withColumn("__id", F.monotonically_increasing_id())
    kept = materialise(with_part.withColumn("__part", F.shiftright("__id", 33)).withColumn("__in", F.col("__id").bitwiseAND((1 << 33) - 1)))
    sizes = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.orderBy("__part")) - F.col("n")  # one row for each partition of the sort
    before = sizes.select("__part", running.alias("__before"))
    numbered = kept.join(F.broadcast(before), "__part").withColumn("ordinal", F.col("__before") + F.col("__in") + 1)
    blocks = numbered.select(F.lit(1).alias("part"), "ordinal", markdown_block(kind, F.col("ordinal")).alias("value"))
    head = records.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("part"), F.lit(0).cast("long").alias("ordinal"),
        F.concat(F.lit(f"# {kind}\n\nUpdated at: {as_of}\nTotal: "), F.col("n").cast("string"), F.lit("\n\n---\n")).alias("value"),
    )
    return head.unionByName(blocks)


def write_markdown(blocks: DataFrame, path: str) -> None:
    """Text files in corpus order."""
    replace_atomically(blocks.orderBy("part", "ordinal").select("value"), path, "text")


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """One small JSON report; written whatever the run's outcome is."""
    row = spark.createDataFrame([(json.dumps(report, ensure_ascii=False, sort_keys=True),)], "value string")
    replace_atomically(row.coalesce(1), path, "text")


def run_with_report(spark: SparkSession, path: str, work: Callable[[dict], None]) -> dict:
    """Runs `work` on a report, which is written even if the work raises."""
    report: dict = {"status": "running"}
    try:
        work(report)
        report["status"] = report.get("status") if report.get("status") != "running" else "complete"
    except Exception as error:
        report |= {"status": "failed", "error": {"code": type(error).__name__, "message": str(error)[:500]}}
        raise
    finally:
        write_report(spark, path, report)
    return report


def promote(spark: SparkSession, base: str, streams: dict[str, DataFrame], failures: DataFrame, all_or_nothing: bool = True) -> dict[str, str | None]:
    """Promotes streams into the store at `base`. All or nothing: only without any failure, and then in one commit.

    Else each stream for itself. Returns the error of each stream, None where it was promoted.
    """
    if all_or_nothing:
        if failures.limit(1).count():
            return dict.fromkeys(streams, "not promoted: there were failures")
        try:
            versions.publish(spark, base, streams)
        except Exception as error:
            return dict.fromkeys(streams, f"not promoted: {str(error)[:500]}")
        return dict.fromkeys(streams)
    out: dict[str, str | None] = {}
    for name, df in streams.items():
        try:
            versions.publish(spark, base, {name: df})
            out[name] = None
        except Exception as error:
            out[name] = str(error)[:500]
    return out


__all__ = ["exists", "markdown_block", "promote", "read_stored", "recover", "render_markdown", "replace_atomically", "run_with_report", "write_json", "write_markdown", "write_report"]
