"""Coverage of scans: declared against observed counts, gaps, coverage classes, status and exit codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The names of coverages, the best last, and where a declared count comes from.
PARTIAL_REFUSED, PARTIAL_PAGES, PARTIAL_RESPONSE = "partial_waf", "partial_page_limit", "partial_incomplete_response"
COMPLETE_WITH_GAPS, COMPLETE = "accessible_main_stream_complete_with_known_gaps", "changed_posts_main_stream_complete"
FROM_TIMELINE, FROM_ENDPOINT = "timeline", "comment_endpoint_final_page"


def coverage(observations: DataFrame, posts: DataFrame, key: str = "post_id", item_id: str = "comment_id", page: str = "page") -> DataFrame:
    """One row for each scanned post: declared, observed, truncated, unverified and the visibility gap.

    `observations` has a row for each page and comment seen (comment null on an empty page), with `complete`,
    `explicit` and `endpoint_count` of the page. The last page's count counts as declared, else the post's own.
    """
    seen = observations.groupBy(key).agg(
        F.count_distinct(item_id).alias("observed"),
        F.max("complete").alias("__complete"),
        F.max_by("explicit", page).alias("__explicit"),
        F.max_by("endpoint_count", page).alias("__endpoint"),
    )
    rows = seen.join(posts.select(key, "reply_count"), key, "left")
    complete = F.coalesce("__complete", F.lit(False))
    explicit = complete & F.coalesce("__explicit", F.lit(False))
    endpoint = F.when(complete, F.col("__endpoint"))
    declared = F.coalesce(endpoint, "reply_count")
    short = F.col("observed") < declared
    unverified = F.coalesce((F.col("observed") > declared) | (short & ~explicit), F.lit(False))
    gap = F.when(
        short & ~unverified,
        F.struct(
            declared.alias("declared_count"), F.col("observed").alias("visible_count"), (declared - F.col("observed")).alias("unavailable_count"),
            F.when(endpoint.isNull(), FROM_TIMELINE).otherwise(FROM_ENDPOINT).alias("count_source"),
        ),
    )
    return rows.select(key, declared.alias("declared"), "observed", (~complete).alias("truncated"), unverified.alias("unverified"), gap.alias("gap"))


def coverage_class(scanned: Column, candidates: Column, truncated: Column, unverified: Column, gaps: Column) -> Column:
    """The name of the coverage that these counts of posts amount to."""
    return (
        F.when(scanned != candidates, PARTIAL_REFUSED)
        .when(truncated > 0, PARTIAL_PAGES)
        .when(unverified > 0, PARTIAL_RESPONSE)
        .when(gaps > 0, COMPLETE_WITH_GAPS)
        .otherwise(COMPLETE)
    )


def summary(covered: DataFrame, candidates: int | Column) -> DataFrame:
    """One row: counts of posts, the coverage class and the status that follows."""
    total = candidates if isinstance(candidates, Column) else F.lit(candidates)
    counts = covered.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if("truncated").alias("truncated"), F.count_if("unverified").alias("unverified"),
        F.count_if(F.col("gap").isNotNull()).alias("gaps"),
    )
    named = counts.withColumn("coverage", coverage_class(F.col("scanned"), total, F.col("truncated"), F.col("unverified"), F.col("gaps")))
    return named.withColumn("status", sync_status(F.col("coverage"), F.lit(False))).withColumn("exit_code", exit_code(F.col("status")))


def sync_status(coverage_name: Column, trouble: Column) -> Column:
    """complete, or needs_verification where coverage is partial or a stream had an error or was truncated."""
    return F.when(coverage_name.startswith("partial_") | trouble, "needs_verification").otherwise("complete")


def exit_code(status: Column) -> Column:
    return F.when(status == "complete", 0).when(status == "needs_verification", 2).otherwise(1)


def attempt_status(attempted: Column, valid: Column, failures: Column, existing: Column) -> Column:
    """failed where something was tried, nothing valid came and nothing is stored; else by whether there were failures."""
    return (
        F.when((attempted > 0) & (valid == 0) & (failures > 0) & (existing == 0), "failed")
        .when(failures > 0, "needs_verification")
        .otherwise("complete")
    )


def first_failures(failures: DataFrame, text: str, seq: str) -> DataFrame:
    """Distinct failures with the place of their first occurrence."""
    return failures.groupBy(text).agg(F.min(seq).alias(seq))


def added(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: total after, and how many more than before."""
    old, new = before.agg(F.count(key).alias("old")), after.agg(F.count(key).alias("total"))
    return new.crossJoin(old).select("total", (F.col("total") - F.col("old")).alias("added"))  # one row each
