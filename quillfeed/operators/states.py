"""Checkpoint states as rows: what is wrong with each of many states, as columns.

A state is a JSON text. Its maps and nested arrays are read once as variants and judged where they stand, so that a
table of states is validated in one pass, without a shuffle. `select.checkpoint_violations` says the same of one dict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.functions.ids import MAX_SAFE
from quillfeed.functions.payload import PARSED, parsed_rows, root_fields

#: The fields of a visibility gap, and where its count may come from.
GAP_FIELDS = ("count_source", "declared_count", "post_id", "unavailable_count", "visible_count")
GAP_SOURCES = ("comment_endpoint_final_page", "timeline")
NAMED = ("comment_method", "comment_coverage", "nested_reply_coverage")

_ID = r'\A"[0-9]+"\z'


def _whole(literal: Column) -> Column:
    """The value of a JSON number that is a whole one, 0 to 2^53 - 1; 4.0 is 4."""
    whole = lambda n: F.when((n == F.floor(n)) & (n <= MAX_SAFE), n.try_cast("long"))
    return let(literal, lambda x: F.when(x.rlike(r"\A[0-9]"), let(x.try_cast("decimal(38,10)"), whole)))


def _items(v: Column) -> Column:
    """The literals of an array; null for anything else."""
    return F.transform(F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")), lambda x: F.coalesce(F.to_json(x), F.lit("null")))


def _distinct(values: Column) -> Column:
    return F.size(F.array_distinct(values)) == F.size(values)


def _ids(v: Column) -> Column:
    return let(_items(v), lambda items: F.forall(items, lambda x: x.rlike(_ID)) & _distinct(items))


def gap_fine(literal: Column) -> Column:
    """Whether a gap has exactly its fields and its counts add up."""

    def judge(fields: Column) -> Column:
        text = lambda name: F.to_json(fields[name])
        counts = F.struct(*(_whole(text(name)).alias(name) for name in ("declared_count", "visible_count", "unavailable_count")))
        adds_up = lambda n: (n["declared_count"] >= 1) & (n["unavailable_count"] >= 1) & (n["visible_count"] + n["unavailable_count"] == n["declared_count"])
        closed = F.array_sort(F.map_keys(fields)) == F.array(*(F.lit(name) for name in GAP_FIELDS))
        source = text("count_source").isin(*(f'"{s}"' for s in GAP_SOURCES))
        return closed & text("post_id").rlike(_ID) & source & let(counts, adds_up)

    return F.coalesce(let(root_fields(F.try_parse_json(literal)), judge), F.lit(False))


def gap_problems(v: Column) -> Column:
    """Codes of what is wrong with a list of gaps (a variant): not an array, broken gaps, or a post that comes twice."""

    def judge(items: Column) -> Column:
        posts = F.transform(items, lambda g: F.get_json_object(g, "$.post_id"))
        broken = ~F.forall(items, gap_fine)
        return F.when(items.isNull(), "not_an_array").when(broken, "broken_gap").when(~_distinct(posts), "repeated_post")

    return let(_items(v), judge)


def state_violations(state: Column, user_id: Column) -> Column:
    """Names of the fields of a checkpoint state that are wrong for this user, in a fixed order; `not_an_object` alone for other texts."""
    return _root_violations(root_fields(F.try_parse_json(state)), user_id)


def _root_violations(fields: Column, user_id: Column) -> Column:
    def judge(root: Column) -> Column:
        text = lambda name: F.to_json(root[name])
        absent = lambda name: ~F.map_contains_key(root, name)
        counts = let(root_fields(root["post_reply_counts"]), lambda m: F.forall(F.map_entries(m), lambda e: e["key"].rlike(r"\A[0-9]+\z") & _whole(F.to_json(e["value"])).isNotNull()))
        fine = {
            "schema_version": _whole(text("schema_version")) == 1,
            "post_reply_counts": counts,
            "scanned_post_ids": _ids(root["scanned_post_ids"]),
            "confirmed_post_ids": _ids(root["confirmed_post_ids"]),
            "latest_post_id": (text("latest_post_id") == "null") | text("latest_post_id").rlike(_ID),
            "comment_visibility_gaps": absent("comment_visibility_gaps") | gap_problems(root["comment_visibility_gaps"]).isNull(),
            "user_id": absent("user_id") | (text("user_id") == F.concat(F.lit('"'), user_id, F.lit('"'))),
            **{name: text(name).rlike(r'(?s)\A".+"\z') for name in NAMED},
        }
        codes = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in fine.items())))
        return F.when(root.isNull(), F.array(F.lit("not_an_object"))).otherwise(codes)

    return let(fields, judge)


def judged_states(states: DataFrame, state: str = "state", user: str = "user_id") -> DataFrame:
    """Adds `violations`, and `starts_anew`: a valid state that names no user is given up for the initial one."""
    rows, p = parsed_rows(states, state)
    rows = rows.withColumn("violations", _root_violations(root_fields(p.variant), F.col(user).cast("string")))
    return rows.withColumn("starts_anew", (F.size("violations") == 0) & ~p.has("user_id")).drop(PARSED)
