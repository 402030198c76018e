"""Keyed merge with conflict detection, total order, deduplication and set operations.

The pairwise merge rule is a fold, but each of its parts has a closed form over all versions of a key, so one grouped
aggregation - one shuffle with partial aggregation on the map side - gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.functions.text import utf8_trimmed_length
from quillfeed.functions.times import UNKNOWN


@dataclass(frozen=True)
class MergeRules:
    """How the columns of a record merge.

    same: must be equal in all versions. same_if_known: non-null values must be equal. times: (value, raw) pairs, of
    which a known value beats `unknown`. texts: (text, clean) pairs that move together, the longer wins. richest: the
    longer text wins. latest: the last non-null value wins. Ties go to the later version.
    """

    same: tuple[str, ...] = ()
    same_if_known: tuple[str, ...] = ()
    times: tuple[tuple[str, str], ...] = ()
    texts: tuple[tuple[str, str], ...] = ()
    richest: tuple[str, ...] = ()
    latest: tuple[str, ...] = ()


#: The rules of feed records.
RECORD_RULES = MergeRules(
    same=("kind", "url", "post_id"),
    same_if_known=("reply_to", "in_reply_to_comment_id"),
    times=(("created_at", "created_at_raw"), ("post_created_at", "post_created_at_raw")),
    texts=(("text", "clean_text"),),
    richest=("title", "post_title", "post_text", "origin", "source"),
    latest=("reply_count", "like_count", "retweet_count", "view_count"),
)


@dataclass
class _Plan:
    aggregates: list[Column] = field(default_factory=list)
    conflicts: list[Column] = field(default_factory=list)
    outputs: list[Column] = field(default_factory=list)


def merge_versions(versions: DataFrame, key: str, seq: str, rules: MergeRules) -> DataFrame:
    """One row for each key: merged columns, and `conflicts` (names of the columns that may not change but did)."""
    plan, have = _Plan(), set(versions.columns)
    later = F.col(seq)

    def last(value: Column, when: Column) -> Column:
        return F.max_by(F.when(when, value), F.when(when, later))

    def keep(agg: Column, name: str) -> None:
        plan.aggregates.append(agg.alias(name))

    for name in (n for n in rules.same if n in have):
        filled = F.coalesce(F.col(name).cast("string"), F.lit("\u0000"))
        keep(F.min(filled), f"__lo_{name}")
        keep(F.max(filled), f"__hi_{name}")
        keep(F.max_by(F.col(name), later), name)
        plan.conflicts.append(F.when(F.col(f"__lo_{name}") != F.col(f"__hi_{name}"), F.lit(name)))
        plan.outputs.append(F.col(name))
    for name in (n for n in rules.same_if_known if n in have):
        keep(F.min(name), f"__lo_{name}")
        keep(F.max(name), f"__hi_{name}")
        keep(last(F.col(name), F.col(name).isNotNull()), name)
        plan.conflicts.append(F.when(F.col(f"__lo_{name}") != F.col(f"__hi_{name}"), F.lit(name)))
        plan.outputs.append(F.col(name))
    for value, raw in (t for t in rules.times if set(t) <= have):
        known = F.col(value).isNotNull() & (F.col(value) != UNKNOWN)
        keep(F.min(F.when(known, F.col(value))), f"__lo_{value}")
        keep(F.max(F.when(known, F.col(value))), f"__hi_{value}")
        keep(last(F.col(raw), known), f"__known_{raw}")
        keep(last(F.col(raw), F.col(raw).isNotNull()), f"__any_{raw}")
        keep(F.max(F.col(value)), f"__seen_{value}")
        plan.conflicts.append(F.when(F.col(f"__lo_{value}") != F.col(f"__hi_{value}"), F.lit(value)))
        plan.outputs.append(F.coalesce(F.col(f"__lo_{value}"), F.when(F.col(f"__seen_{value}").isNotNull(), F.lit(UNKNOWN))).alias(value))
        plan.outputs.append(F.when(F.col(f"__lo_{value}").isNotNull(), F.col(f"__known_{raw}")).otherwise(F.col(f"__any_{raw}")).alias(raw))
    for text, clean in (t for t in rules.texts if set(t) <= have):
        score = utf8_trimmed_length(text) + utf8_trimmed_length(clean)
        keep(F.max_by(F.struct(text, clean), F.struct(score, later)), f"__{text}")
        plan.outputs += [F.col(f"__{text}.{text}").alias(text), F.col(f"__{text}.{clean}").alias(clean)]
    for name in (n for n in rules.richest if n in have):
        there = F.col(name).isNotNull()
        keep(F.max_by(F.when(there, F.col(name)), F.when(there, F.struct(utf8_trimmed_length(name), later))), name)
        plan.outputs.append(F.col(name))
    for name in (n for n in rules.latest if n in have):
        keep(last(F.col(name), F.col(name).isNotNull()), name)
        plan.outputs.append(F.col(name))
    conflicts = F.array_compact(F.array(*plan.conflicts)) if plan.conflicts else F.array().cast("array<string>")
    return versions.groupBy(key).agg(*plan.aggregates).select(key, *plan.outputs, conflicts.alias("conflicts"))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, seq: str, rules: MergeRules) -> DataFrame:
    """Merges incoming versions into a corpus; stored rows come before all incoming ones."""
    stored = existing.drop(seq).withColumn(seq, F.lit(-1).cast("long"))
    fresh = incoming.withColumn(seq, F.col(seq).cast("long"))
    return merge_versions(stored.unionByName(fresh, allowMissingColumns=True), key, seq, rules)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """The frame itself; ValueError if a key repeats."""
    if duplicate_keys(df, *keys).limit(1).count():
        raise ValueError(f"repeated key in {keys}")
    return df


def total_order(epoch: str = "epoch_ms", key: str = "id") -> list[Column]:
    """Latest first, unknown times last; then larger ids first, by length and text."""
    return [F.coalesce(F.col(epoch), F.lit(0)).desc(), F.length(F.col(key)).desc(), F.col(key).desc()]


def latest(df: DataFrame, epoch: str = "epoch_ms", key: str = "id", n: int = 1) -> DataFrame:
    """The first rows of the total order; Spark plans one TakeOrdered, no sort of the whole."""
    return df.orderBy(*total_order(epoch, key)).limit(n)


def first_wins(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows, and incoming ones with a new key."""
    return existing.unionByName(incoming.join(existing.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def last_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(seq)).alias("__row")).select(key, "__row.*")


def numbered(df: DataFrame, partition: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """Adds the place of each row in an order, within a partition."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def reconcile_gaps(previous: DataFrame, current: DataFrame, checkpointed: DataFrame, active: DataFrame, key: str = "post_id") -> DataFrame:
    """Earlier gaps of posts that are active and not newly checkpointed, and all current ones; the current one wins.

    Violations - repeated keys, or a current gap of a post that is not checkpointed - raise ValueError.
    """
    for gaps in (previous, current):
        require_unique(gaps, key)
    if current.join(checkpointed, key, "left_anti").limit(1).count():
        raise ValueError("current gaps must belong to checkpointed posts")
    kept = previous.join(active.select(key).distinct(), key, "left_semi").join(checkpointed.select(key).distinct(), key, "left_anti")
    return kept.join(current.select(key), key, "left_anti").unionByName(current)
