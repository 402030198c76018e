"""Recovery data: unversioned records become declared legacy ones, declared ones must already hold, others are strict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.functions.ids import canonical_url, count_from_literal, loose_id
from quillfeed.functions.payload import Payload
from quillfeed.functions.text import clean_html
from quillfeed.functions.times import epoch_ms_from_literal, format_epoch_ms, is_unknown_literal
from quillfeed.operators.contracts import CONTRACTS, SCHEMA_VERSION, upgrade, violations
from quillfeed.session import materialise

LEGACY = CONTRACTS[4]
#: Fields of legacy posts and replies in recovery data.
SHARED_FIELDS = "schema_version record_contract id created_at_raw created_at text clean_text reply_count like_count created_ms legacy_migrated_fields".split()
POST_FIELDS = [*SHARED_FIELDS, *"target retweet_count view_count title mode".split()]
REPLY_FIELDS = [
    *SHARED_FIELDS,
    *"""post_id post_target post_link reply_to in_reply_to_comment_id post_created_at_raw post_created_at post_title
    post_text post_excerpt source origin status_id fetched_from_page post_reply_count""".split(),
]
_STRINGS = ("post_title", "post_text", "post_excerpt", "source", "origin")


def route(p: Payload) -> Column:
    """legacy (no version), declared (the legacy contract) or strict."""
    declared = p.text("record_contract").eqNullSafe(LEGACY)
    return F.when(~p.has("schema_version") & ~p.has("record_contract"), "legacy").when(declared, "declared").otherwise("strict")


def recover(body: Column, user_id: str, domain: str) -> Column:
    """struct(route, record, violations): the record as JSON text, null where something is violated."""

    def of(p: Payload) -> Column:
        kind = route(p)
        made = upgrade(p.body, domain)
        strict = let(made, lambda m: F.struct(m.alias("record"), F.when(m.isNull(), F.array(F.lit("record_contract"))).otherwise(violations(m, domain)).alias("violations")))
        chosen = F.when(kind == "strict", strict).otherwise(_legacy(p, kind == "declared", user_id, domain))
        return let(
            F.struct(kind.alias("route"), chosen.alias("x")),
            lambda s: F.struct(s["route"].alias("route"), F.when(F.size(s["x"]["violations"]) == 0, s["x"]["record"]).alias("record"), s["x"]["violations"].alias("violations")),
        )

    return Payload.parsed(body, of)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _literal_of(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)


def _bare(literal: Column) -> Column:
    return F.regexp_replace(literal, r'\A"|"\z', "")


def _legacy(p: Payload, declared: Column, user_id: str, domain: str) -> Column:
    """struct(record, violations) of a legacy record; a declared one must be in its normal form already."""
    reply = p.has("post_id") | p.has("post_target") | p.has("post_link")
    broken: dict[str, Column] = {}
    value: dict[str, Column] = {"schema_version": F.lit(str(SCHEMA_VERSION)), "record_contract": F.lit(f'"{LEGACY}"')}

    def identity(name: str, nullable: bool, needed: Column) -> None:
        literal = p.literal(name)
        normal = F.coalesce(_quoted(loose_id(_bare(literal))), F.when(F.lit(nullable) & (literal == "null"), F.lit("null")))
        broken[name] = F.when(literal.isNull(), needed).otherwise(normal.isNull() | (declared & (normal != literal)))
        value[name] = normal

    def number(name: str, needed: Column, least: int = 0) -> None:
        literal = p.literal(name)
        n = count_from_literal(literal)
        broken[name] = F.when(literal.isNull(), needed).otherwise(n.isNull() | (n < least) | (declared & (p.kind(name) != "number")))
        value[name] = n.cast("string")

    def time(name: str, needed: Column) -> None:
        raw_name = f"{name}_raw"
        raw, made = F.coalesce(p.literal(raw_name), p.literal(name)), p.literal(name)
        normal = format_epoch_ms(epoch_ms_from_literal(raw))
        same = F.when(declared, made == _quoted(normal)).otherwise(format_epoch_ms(epoch_ms_from_literal(made)) == normal)
        differs = p.has(raw_name) & p.has(name) & ~F.coalesce(same, F.lit(False))
        unknown = (normal == "unknown") & ~is_unknown_literal(raw)
        broken[name] = F.when(raw.isNull(), needed).otherwise(unknown | differs | (declared & (p.has(raw_name) != p.has(name))))
        value[raw_name], value[name] = raw, F.when(raw.isNotNull(), _quoted(normal))

    def string(name: str) -> None:
        broken[name] = p.has(name) & (p.kind(name) != "string")
        value[name] = p.literal(name)

    yes, no = F.lit(True), F.lit(False)
    allowed = F.when(reply, F.array(*map(F.lit, REPLY_FIELDS))).otherwise(F.array(*map(F.lit, POST_FIELDS)))
    broken["unsupported_field"] = F.size(F.array_except(p.keys, allowed)) > 0
    broken["schema_version"] = declared & ~p.literal("schema_version").eqNullSafe(str(SCHEMA_VERSION))
    identity("id", False, yes)
    time("created_at", yes)
    string("text")
    cleaned = F.coalesce(p.text("clean_text"), clean_html(p.text("text")))
    broken["clean_text"] = (p.has("clean_text") & (p.kind("clean_text") != "string")) | (~p.has("text") & ~p.has("clean_text")) | (p.has("text") & (cleaned != clean_html(p.text("text"))))
    value["clean_text"] = _literal_of(cleaned)
    identity("post_id", False, reply)
    post = loose_id(_bare(p.literal("post_id")))
    given = F.coalesce(F.nullif(p.text("post_target"), F.lit("")), F.nullif(p.text("post_link"), F.lit("")))
    url = canonical_url(given, domain, F.lit(user_id), post)
    other = canonical_url(p.text("post_link"), domain, F.lit(user_id), post)
    both = p.has("post_target") & p.has("post_link")
    broken["post_target"] = reply & (given.isNull() | url.isNull() | (both & ~other.eqNullSafe(url)) | (declared & (given != url)))
    value["post_target"] = F.when(reply, _quoted(url))
    target = canonical_url(p.text("target"), domain, F.lit(user_id), loose_id(_bare(p.literal("id"))))
    broken["target"] = ~reply & (F.nullif(p.text("target"), F.lit("")).isNull() | target.isNull() | (declared & (p.text("target") != target)))
    value["target"] = F.when(~reply, _quoted(target))
    for name in ("reply_count", "retweet_count", "view_count"):
        number(name, ~reply)
    number("like_count", yes)
    for name in ("reply_to", "in_reply_to_comment_id", "status_id"):
        identity(name, True, no)
    broken["status_id_differs"] = reply & F.coalesce(loose_id(_bare(p.literal("status_id"))) != post, no)
    time("post_created_at", no)
    for name in ("title", "mode", *_STRINGS):
        string(name)
    for name, least in (("fetched_from_page", 1), ("post_reply_count", 0), ("created_ms", 0)):
        number(name, no, least)
    listed = F.from_json(p.literal("legacy_migrated_fields"), "array<string>")
    broken["legacy_migrated_fields"] = p.has("legacy_migrated_fields") & ~F.coalesce(~F.exists(listed, lambda x: x.isNull() | (x == "")), F.lit(False))
    value["legacy_migrated_fields"] = p.literal("legacy_migrated_fields")

    found = F.array_compact(F.array(*(F.when(F.coalesce(c, yes), F.lit(n)) for n, c in broken.items())))
    parts = F.array_compact(F.array(*(F.when(v.isNotNull(), F.concat(F.lit(f'"{n}":'), v)) for n, v in value.items())))
    record = F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    return F.struct(record.alias("record"), F.when(~p.is_object(), F.array(F.lit("not_an_object"))).otherwise(found).alias("violations"))


def recovered(df: DataFrame, user_id: str, domain: str, body: str = "body") -> DataFrame:
    """The frame with route, record and violations; ValueError if ids repeat among the valid records."""
    made = df.select("*", recover(F.col(body), user_id, domain).alias("__r")).select(*df.columns, "__r.route", "__r.record", "__r.violations")
    out = materialise(made)  # read twice: by the check of ids and by the caller
    keys = out.select(Payload(F.col("record")).text("id").alias("id")).filter("id is not null")
    if keys.groupBy("id").count().filter("count > 1").limit(1).count():
        raise ValueError("repeated id")
    return out
