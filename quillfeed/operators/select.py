"""Incremental selection and checkpoint state: changed posts, recent posts, baselines, resume cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.operators.merge import total_order
from quillfeed.session import materialise


def changed_posts(posts: DataFrame, baselines: DataFrame, position: str, count: str, limit: int, key: str = "post_id", force: bool = False) -> DataFrame:
    """Among the first `limit` posts: those without a baseline, or whose count differs from it, up or down."""
    previous = baselines.select(key, F.col(count).alias("previous_count"), F.lit(True).alias("__known"))
    rows = posts.filter(F.col(position) < limit).join(previous, key, "left")
    return rows.filter(F.lit(force) | F.col("__known").isNull() | ~F.col(count).eqNullSafe(F.col("previous_count"))).drop("__known")


def confirmed_ids(scanned: DataFrame, truncated: DataFrame, unverified: DataFrame, key: str = "post_id") -> DataFrame:
    """Scanned posts that are neither truncated nor unverified."""
    return scanned.join(truncated.select(key).unionByName(unverified.select(key)).distinct(), key, "left_anti")


def advance_checkpoint(baselines: DataFrame, posts: DataFrame, confirmed: DataFrame, position: str, count: str, limit: int, key: str = "post_id") -> DataFrame:
    """Baselines after a run: confirmed posts within the limit take their current count, all others keep theirs."""
    fresh = posts.filter(F.col(position) < limit).join(confirmed.select(key).distinct(), key, "left_semi").select(key, F.col(count).alias("__fresh"))
    return baselines.join(fresh, key, "full_outer").select(key, F.coalesce("__fresh", count).alias(count))


def recent_posts(posts: DataFrame, as_of_ms: int, lookback_days: int, limit: int, epoch: str = "epoch_ms", key: str = "post_id") -> DataFrame:
    """The newest posts within the lookback; if there is none, the newest of all.

    A recent post stands before every older one in the total order, so the first `limit` rows hold both answers.
    """
    cutoff = as_of_ms - lookback_days * 86_400_000
    top = posts.orderBy(*total_order(epoch, key)).limit(limit)
    flagged = top.withColumn("__recent", F.coalesce(F.col(epoch) >= cutoff, F.lit(False)))
    some = flagged.agg(F.coalesce(F.max("__recent"), F.lit(False)).alias("__some"))
    return flagged.crossJoin(F.broadcast(some)).filter(~F.col("__some") | F.col("__recent")).drop("__recent", "__some")  # one row


def skip_existing(refs: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct references that are not stored yet."""
    return refs.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def ordered_digest(rows: DataFrame, stream: str, order: list[str], *fields: str, block: int = 65_536) -> DataFrame:
    """(stream, digest): SHA-256 over the rows of a stream in order, in two levels.

    Rows are numbered within their stream; blocks of 65,536 rows have digests, and the stream's digest is over those.
    A long stream is spread over ranges of its order, whose sizes are added up, so no task gathers it. Rows that tie in
    the order stand by their own digests.
    """
    literal = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    ranged = rows.select(stream, *order, literal.alias("__d")).repartitionByRange(stream, *order, "__d")
    ranged = materialise(ranged.withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy(stream, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(stream, "__part", (F.sum("__n").over(Window.partitionBy(stream).orderBy("__part")) - F.col("__n")).alias("__before"))  # a row for each range
    place = F.row_number().over(Window.partitionBy(stream, "__part").orderBy(*order, "__d")) - 1
    numbered = ranged.withColumn("__in", place).join(before, [stream, "__part"]).select(stream, (F.col("__before") + F.col("__in")).alias("__at"), "__d")
    ordered = lambda at, d: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, d))), lambda x: x[d]), "")
    blocks = numbered.groupBy(stream, F.floor(F.col("__at") / block).alias("__block")).agg(F.sha2(ordered("__at", "__d"), 256).alias("__b"))
    return blocks.groupBy(stream).agg(F.sha2(ordered("__block", "__b"), 256).alias("digest"))


def resume_start(scanned: Column, timeline_now: Column, timeline_then: Column, replies_now: Column, replies_then: Column) -> tuple[Column, Column]:
    """(start, violation): 0 where the timeline has changed or progress was not fingerprinted, else the cursor.

    A reply corpus that differs from its fingerprint is a violation.
    """
    fresh = (scanned == 0) | timeline_then.isNull() | (timeline_then != timeline_now) | replies_then.isNull()
    changed = (scanned > 0) & replies_then.isNotNull() & (replies_then != replies_now)
    invalid = scanned.isNull() | (scanned < 0)
    return F.when(fresh, F.lit(0)).otherwise(scanned), F.when(invalid, "invalid_cursor").when(changed, "reply_corpus_changed")


def checkpoint_violations(state: dict, user_id: str) -> list[str]:
    """Codes of what is wrong with a checkpoint state (one small object on the driver)."""
    digits = lambda x: isinstance(x, str) and x.isascii() and x.isdigit()
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool) and x >= 0
    ids = lambda x: isinstance(x, list) and all(digits(i) for i in x) and len(set(x)) == len(x)
    counts = state.get("post_reply_counts")
    gaps = state.get("comment_visibility_gaps", [])
    checks = {
        "schema_version": state.get("schema_version") == 1,
        "post_reply_counts": isinstance(counts, dict) and all(digits(k) and whole(v) for k, v in counts.items()),
        "scanned_post_ids": ids(state.get("scanned_post_ids")),
        "confirmed_post_ids": ids(state.get("confirmed_post_ids")),
        "latest_post_id": "latest_post_id" in state and (state["latest_post_id"] is None or digits(state["latest_post_id"])),
        "comment_visibility_gaps": isinstance(gaps, list) and all(gap_is_valid(g) for g in gaps) and len({g["post_id"] for g in gaps}) == len(gaps),
        "user_id": "user_id" not in state or state["user_id"] == user_id,
    }
    for name in ("comment_method", "comment_coverage", "nested_reply_coverage"):
        checks[name] = isinstance(state.get(name), str) and bool(state[name])
    return [name for name, fine in checks.items() if not fine]


def gap_is_valid(gap: object) -> bool:
    """Whether a visibility gap has exactly its fields and its counts add up."""
    fields = {"post_id", "declared_count", "visible_count", "unavailable_count", "count_source"}
    if not isinstance(gap, dict) or set(gap) != fields:
        return False
    declared, visible, hidden = gap["declared_count"], gap["visible_count"], gap["unavailable_count"]
    whole = all(isinstance(x, int) and not isinstance(x, bool) for x in (declared, visible, hidden))
    named = isinstance(gap["post_id"], str) and gap["post_id"].isascii() and gap["post_id"].isdigit()
    source = gap["count_source"] in ("comment_endpoint_final_page", "timeline")
    return whole and named and source and declared >= 1 and visible >= 0 and hidden >= 1 and visible + hidden == declared


def initial_checkpoint(user_id: str) -> dict:
    """The state before the first run."""
    if not (user_id.isascii() and user_id.isdigit()):
        raise ValueError("user id must be digits")
    return {
        "schema_version": 1, "user_id": user_id, "updated_at": None, "latest_post_id": None, "latest_post_time": None,
        "post_reply_counts": {}, "comment_method": "not_run", "comment_coverage": "not_requested", "scanned_post_ids": [],
        "confirmed_post_ids": [], "comment_visibility_gaps": [], "nested_reply_coverage": "not_requested",
    }


def checkpoint_for(state: dict, user_id: str) -> dict:
    """A valid state of this user; without a user it starts anew; any other violation raises ValueError."""
    wrong = checkpoint_violations(state, user_id)
    if wrong:
        raise ValueError("checkpoint state: " + ", ".join(wrong))
    return state if "user_id" in state else initial_checkpoint(user_id)
