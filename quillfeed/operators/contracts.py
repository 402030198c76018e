"""Record contracts: fields, kinds and rules of stored records, as violation codes per row.

Rows are JSON texts; every rule is an expression over the text, so a whole corpus is validated in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.functions.ids import MAX_SAFE, canonical_url, count_from_literal, last_segment, loose_id, url_parts
from quillfeed.functions.payload import Payload
from quillfeed.functions.text import clean_html
from quillfeed.functions.times import epoch_ms_from_literal, format_epoch_ms, is_unknown_literal

SCHEMA_VERSION = 1
STRICT = "normalized_v1"
#: Names of the record contracts, the strict one first.
CONTRACTS = (STRICT, "normalized_without_view_count_v1", "framework_index_link_v1", "framework_index_source_v1", "legacy_normalized_v1")
#: The fields that a record may have.
FIELDS = """schema_version record_contract id created_at_raw created_at target post_id post_target post_link reply_to
in_reply_to_comment_id post_created_at_raw post_created_at title text clean_text post_title post_text origin source mode
post_excerpt reply_count like_count retweet_count view_count status_id user_id post_reply_count created_ms
fetched_from_page legacy_migrated_fields""".split()
STRINGS = ("title", "post_title", "post_text", "origin", "source", "mode", "post_excerpt")
POST_COUNTS = ("reply_count", "like_count", "retweet_count", "view_count")
REPLY_COUNTS = ("reply_count", "like_count")


def is_reply(p: Payload) -> Column:
    return p.has("post_id") | p.has("post_target")


def _bare(literal: Column) -> Column:
    return F.regexp_replace(literal, r'\A"|"\z', "")


def _safe_number(p: Payload, name: str, least: int = 0) -> Column:
    """Whether a field holds a whole number of at least `least`, written as a number."""
    n = count_from_literal(p.literal(name))
    return F.coalesce((p.kind(name) == "number") & (n >= least) & (n <= MAX_SAFE), F.lit(False))


def _digit_text(p: Payload, name: str) -> Column:
    return F.coalesce(p.text(name).rlike(r"\A[0-9]+\z"), F.lit(False))


def rules(p: Payload, expected: Column, post_expected: Column, domain: str) -> dict[str, Column]:
    """Violation code to condition, for records of the strict contract.

    `expected` and `post_expected` are the normal forms of the two raw times.
    """
    reply = is_reply(p)
    raw, made = p.literal("created_at_raw"), p.text("created_at")
    post_raw, post_made = p.literal("post_created_at_raw"), p.text("post_created_at")
    target, post_target = p.text("target"), p.text("post_target")
    plain_raw = p.kind("created_at_raw").isin("string", "number", "null")
    migrated = F.from_json(p.literal("legacy_migrated_fields"), "array<string>")
    bad_number = lambda name, least=0: p.has(name) & ~_safe_number(p, name, least)
    bad_null_id = lambda name: p.has(name) & ~((p.kind(name) == "null") | _digit_text(p, name))
    out = {
        "not_an_object": ~p.is_object(),
        "contract_without_version": p.has("record_contract") & ~p.has("schema_version"),
        "schema_version": p.has("schema_version") & ~p.literal("schema_version").eqNullSafe(str(SCHEMA_VERSION)),
        "record_contract": p.has("record_contract") & ~p.text("record_contract").eqNullSafe(STRICT),
        "unsupported_field": F.size(F.array_except(p.keys, F.array(*map(F.lit, FIELDS)))) > 0,
        "id": ~_digit_text(p, "id"),
        "created_at_raw_missing": ~p.has("created_at_raw"),
        "created_at_raw_kind": p.has("created_at_raw") & ~plain_raw,
        "created_at_raw_invalid": plain_raw & (expected == "unknown") & ~is_unknown_literal(raw),
        "created_at": ~made.eqNullSafe(expected),
        "text_kind": ~p.kind("text").eqNullSafe("string"),
        "clean_text_kind": ~p.kind("clean_text").eqNullSafe("string"),
        "clean_text_differs": p.text("clean_text") != clean_html(p.text("text")),
        "reply_with_target": reply & (p.has("target") | p.has("post_link")),
        "reply_without_post_id": reply & ~_digit_text(p, "post_id"),
        "post_target": reply & ~post_target.eqNullSafe(canonical_url(post_target, domain)),
        "post_target_id": reply & (last_segment(url_parts(post_target)["path"]) != p.text("post_id")),
        "post_with_link": ~reply & p.has("post_link"),
        "target": ~reply & ~target.eqNullSafe(canonical_url(target, domain)),
        "target_id": ~reply & (last_segment(url_parts(target)["path"]) != p.text("id")),
        "post_time_pair": p.has("post_created_at_raw") != p.has("post_created_at"),
        "post_created_at_raw_kind": p.has("post_created_at_raw") & ~p.kind("post_created_at_raw").isin("string", "number", "null"),
        "post_created_at_raw_invalid": p.has("post_created_at_raw") & (post_expected == "unknown") & ~is_unknown_literal(post_raw),
        "post_created_at": p.has("post_created_at_raw") & p.has("post_created_at") & ~post_made.eqNullSafe(post_expected),
        "user_id": p.has("user_id") & ~_digit_text(p, "user_id"),
        "fetched_from_page": bad_number("fetched_from_page", 1),
        "legacy_migrated_fields": p.has("legacy_migrated_fields")
        & ~F.coalesce(
            (p.kind("legacy_migrated_fields") == "array")
            & (F.size(migrated) == F.size(F.array_distinct(migrated)))
            & ~F.exists(migrated, lambda x: x.isNull() | (x == "")),
            F.lit(False),
        ),
        "status_id_differs": reply & (p.text("status_id") != p.text("post_id")),
    }
    for name in POST_COUNTS:
        needed = ~reply if name not in REPLY_COUNTS else F.lit(True)
        out[name] = needed & ~_safe_number(p, name)
    for name in ("reply_to", "in_reply_to_comment_id", "status_id"):
        out[name] = bad_null_id(name)
    for name in STRINGS:
        out[f"{name}_kind"] = p.has(name) & (p.kind(name) != "string")
    for name in ("post_reply_count", "created_ms"):
        out[name] = bad_number(name)
    return out


def violations(body: Column, domain: str) -> Column:
    """Codes of the rules that a record breaks, in order of the rules; empty for a valid one."""

    def of(p: Payload) -> Column:
        time = lambda name: format_epoch_ms(epoch_ms_from_literal(p.literal(name)))
        both = F.struct(time("created_at_raw").alias("own"), time("post_created_at_raw").alias("post"))

        def listed(t: Column) -> Column:
            broken = [F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in rules(p, t["own"], t["post"], domain).items()]
            return F.array_compact(F.array(*broken))

        return F.when(~p.is_object(), F.array(F.lit("not_an_object"))).otherwise(let(both, listed))

    return Payload.parsed(body, of)


def shape(body: Column) -> Column:
    """Which of the seven shapes (contract and kind) a record has; null if none or more than one."""
    return Payload.parsed(body, _shape)


def _shape(p: Payload) -> Column:
    has = lambda *names: _all(p.has(n) for n in names)
    no = lambda *names: _all(~p.has(n) for n in names)
    base = has("schema_version", "record_contract", "id", "created_at", "created_at_raw")
    texts, either = has("text", "clean_text"), p.has("text") | p.has("clean_text")
    of = lambda name: base & p.text("record_contract").eqNullSafe(name)
    post = has("target", "reply_count", "like_count", "retweet_count") & no("post_id", "post_target", "post_link")
    strict_post = post & texts & has("view_count")
    shapes = {
        "normalized_v1/post": of(CONTRACTS[0]) & strict_post,
        "normalized_v1/reply": of(CONTRACTS[0]) & texts & has("post_id", "post_target", "reply_count", "like_count") & no("target", "post_link"),
        f"{CONTRACTS[1]}/post": of(CONTRACTS[1]) & post & texts,
        f"{CONTRACTS[2]}/post": of(CONTRACTS[2]) & strict_post,
        f"{CONTRACTS[3]}/post": of(CONTRACTS[3]) & strict_post,
        f"{CONTRACTS[4]}/post": of(CONTRACTS[4]) & post & has("view_count") & either,
        f"{CONTRACTS[4]}/reply": of(CONTRACTS[4]) & has("post_id", "like_count") & (p.has("post_target") | p.has("post_link")) & either & no("target"),
    }
    return one_of(shapes)


def one_of(options: dict[str, Column]) -> Column:
    """The name of the only option that holds; null if none or several do."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in options.items())))
    return F.when(F.size(found) == 1, found[0])


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def upgrade(body: Column, domain: str) -> Column:
    """A stored record as a strict one, or null where it is of another contract.

    Without a schema version a record is legacy: ids and counts may be numbers or padded digits, clean_text and the
    raw time are derived where missing, and what was derived is listed. Version 1 without a contract is stamped. The
    result is to be held against `violations`.
    """
    return Payload.parsed(body, lambda p: _upgraded(p, domain))


def _upgraded(p: Payload, domain: str) -> Column:
    legacy = ~p.has("schema_version")
    foreign = p.has("record_contract") & ~p.text("record_contract").eqNullSafe(STRICT)
    raw = F.when(legacy & ~p.has("created_at_raw"), F.coalesce(p.literal("created_at"), F.lit("null"))).otherwise(p.literal("created_at_raw"))
    time = F.to_json(F.struct(format_epoch_ms(epoch_ms_from_literal(raw)).alias("v")))
    time_literal = F.regexp_extract(time, r'(?s)\A\{"v":(.*)\}\z', 1)
    clean = F.regexp_extract(F.to_json(F.struct(clean_html(p.text("text")).alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)
    stale = legacy & (~p.has("clean_text") | ~p.text("clean_text").eqNullSafe(clean_html(p.text("text"))))
    derived = F.array_compact(
        F.array(
            F.when(legacy & ~p.has("created_at_raw"), "created_at_raw"),
            F.when(legacy & ~p.has("created_at"), "created_at"),
            F.when(stale, "clean_text"),
        )
    )
    before = F.coalesce(F.from_json(p.literal("legacy_migrated_fields"), "array<string>"), F.array().cast("array<string>"))
    listed = F.array_sort(F.array_distinct(F.concat(before, derived)))
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    value: dict[str, Column] = {n: p.literal(n) for n in FIELDS}
    for name in ("id", "post_id", "user_id", "reply_to", "in_reply_to_comment_id", "status_id"):
        value[name] = F.when(legacy & (p.literal(name) != "null"), F.coalesce(quote(loose_id(_bare(p.literal(name)))), p.literal(name))).otherwise(p.literal(name))
    for name in (*POST_COUNTS, "post_reply_count"):
        value[name] = F.when(legacy, F.coalesce(count_from_literal(p.literal(name)).cast("string"), p.literal(name))).otherwise(p.literal(name))
    for name in ("target", "post_target"):
        value[name] = F.when(legacy & p.has(name), F.coalesce(quote(canonical_url(p.text(name), domain)), p.literal(name))).otherwise(p.literal(name))
    value |= {
        "schema_version": F.when(legacy, F.lit(str(SCHEMA_VERSION))).otherwise(p.literal("schema_version")),
        "record_contract": F.lit(f'"{STRICT}"'),
        "created_at_raw": raw,
        "created_at": F.when(legacy, time_literal).otherwise(p.literal("created_at")),
        "clean_text": F.when(stale & (clean != ""), clean).otherwise(p.literal("clean_text")),
        "legacy_migrated_fields": F.when(F.size(derived) > 0, F.to_json(listed)).otherwise(p.literal("legacy_migrated_fields")),
    }
    parts = F.array_compact(F.array(*(F.when(value[n].isNotNull(), F.concat(F.lit(f'"{n}":'), value[n])) for n in FIELDS)))
    dropped = F.when(p.has("record_contract"), F.lit(0)).otherwise(F.lit(1))  # an unstamped record may drop one nested field
    unknown = F.array_except(p.keys, F.array(*map(F.lit, FIELDS)))
    unknown = F.when(dropped == 1, F.array_remove(unknown, "retweeted_status")).otherwise(unknown)
    extra = F.transform(unknown, lambda k: F.concat(F.lit('"'), k, F.lit('":null')))
    return F.when(p.is_object() & ~foreign, F.concat(F.lit("{"), F.array_join(F.concat(parts, extra), ","), F.lit("}")))


def corpus_record(body: Column, domain: str, contract: str = STRICT) -> Column:
    """struct(record, violations): a record of a corpus in the normal form of `contract`, as JSON text; null where something is violated.

    Fields that are there are made normal: ids are texts of digits, counts numbers, links absolute, times have their raw
    value beside them. A date without a time of day is no time. A record in its normal form stays as it is.
    """

    def of(p: Payload) -> Column:
        value: dict[str, Column] = {"schema_version": F.lit(str(SCHEMA_VERSION)), "record_contract": F.lit(f'"{contract}"')}
        broken: dict[str, Column] = {
            "schema_version": p.has("schema_version") & ~p.literal("schema_version").eqNullSafe(str(SCHEMA_VERSION)),
            "record_contract": p.has("record_contract") & ~p.text("record_contract").eqNullSafe(contract),
            "unsupported_field": F.size(F.array_except(p.keys, F.array(*map(F.lit, FIELDS)))) > 0,
        }
        quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

        def put(name: str, normal: Column, nullable: bool = False, needed: bool = False) -> None:
            literal = p.literal(name)
            value[name] = F.when(literal == "null", literal).otherwise(normal) if nullable else normal
            broken[name] = F.coalesce(literal.isNotNull(), F.lit(False)) & value[name].isNull() if not needed else value[name].isNull()

        for name in ("id", "post_id", "user_id"):
            put(name, quote(loose_id(_bare(p.literal(name)))), needed=name == "id")
        for name in ("reply_to", "in_reply_to_comment_id", "status_id"):
            put(name, quote(loose_id(_bare(p.literal(name)))), nullable=True)
        for name in (*POST_COUNTS, "post_reply_count", "created_ms", "fetched_from_page"):
            put(name, count_from_literal(p.literal(name)).cast("string"))
        for name in ("target", "post_target"):
            put(name, quote(canonical_url(p.text(name), domain)))
        for name in (*STRINGS, "text", "clean_text"):
            put(name, F.when(p.kind(name) == "string", p.literal(name)))
        for name in ("post_link", "legacy_migrated_fields"):
            value[name] = p.literal(name)
        for name in ("created_at", "post_created_at"):
            raw = F.coalesce(p.literal(f"{name}_raw"), p.literal(name))
            normal = format_epoch_ms(epoch_ms_from_literal(raw))
            value[f"{name}_raw"], value[name] = raw, F.when(raw.isNotNull(), quote(normal))
            unknown = F.coalesce((normal == "unknown") & ~is_unknown_literal(raw), F.lit(False))
            broken[name] = unknown | raw.isNull() if name == "created_at" else unknown
        parts = F.array_compact(F.array(*(F.when(value[n].isNotNull(), F.concat(F.lit(f'"{n}":'), value[n])) for n in FIELDS)))
        codes = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in broken.items())))
        found = F.when(~p.is_object(), F.array(F.lit("not_an_object"))).otherwise(codes)
        made = F.struct(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("record"), found.alias("violations"))
        return let(made, lambda m: F.struct(F.when(F.size(m["violations"]) == 0, m["record"]).alias("record"), m["violations"].alias("violations")))

    return Payload.parsed(body, of)


def upgrade_predecessor_reply(body: Column) -> Column:
    """Gives a version-1 reply without a contract and without the post's raw time that raw time, and lists it; others stay."""
    p = Payload(body)
    known = p.literal("schema_version").eqNullSafe("1") & ~p.has("record_contract") & p.has("post_created_at") & ~p.has("post_created_at_raw")
    before = F.coalesce(F.from_json(p.literal("legacy_migrated_fields"), "array<string>"), F.array().cast("array<string>"))
    listed = F.to_json(F.array_sort(F.array_distinct(F.concat(before, F.array(F.lit("post_created_at_raw"))))))
    head = F.regexp_replace(F.btrim(body), r"\}\z", "")
    added = F.concat(head, F.lit(',"post_created_at_raw":'), p.literal("post_created_at"), F.lit(',"legacy_migrated_fields":'), listed, F.lit("}"))
    return F.when(known & ~p.has("legacy_migrated_fields"), added).otherwise(body)


def closed_fields(body: Column, allowed: list[str]) -> Column:
    """Keys that are not allowed, in order."""
    return F.array_sort(F.array_except(Payload(body).keys, F.array(*map(F.lit, allowed))))


def acquisition_markers_ok(body: Column | Payload) -> Column:
    """Raw rows carry both contract markers with their current values, or neither."""
    p = body if isinstance(body, Payload) else Payload(body)
    neither = ~p.has("schema_version") & ~p.has("record_contract")
    both = p.literal("schema_version").eqNullSafe(str(SCHEMA_VERSION)) & p.text("record_contract").eqNullSafe(STRICT)
    return neither | both


def report_violations(body: Column) -> Column:
    """Implications of a run report: running has no end, failed has an error, drift is detected where signals are."""
    p = Payload(body)
    status, ended = p.text("status"), p.has("finished_at") & (p.kind("finished_at") != "null")
    failed = p.has("error") & (p.kind("error") != "null")
    signals = F.coalesce(F.size(F.from_json(p.literal("interface_drift.signals"), "array<string>")), F.lit(0)) > 0
    broken = {
        "not_an_object": ~p.is_object(),
        "running_and_finished": (status == "running") == ended,
        "failed_without_error": (status == "failed") != failed,
        "drift_without_signals": p.has("interface_drift") & (p.literal("interface_drift.detected").eqNullSafe("true") != signals),
    }
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in broken.items())))


def assert_valid(df: DataFrame, body: str, domain: str) -> DataFrame:
    """The frame itself; ValueError names the codes of violations, counted over the whole corpus."""
    codes = df.select(F.explode(violations(F.col(body), domain)).alias("code")).groupBy("code").count().orderBy("code").collect()  # a fixed set of codes
    if codes:
        raise ValueError("invalid records: " + ", ".join(f"{r['code']} x {r['count']}" for r in codes))
    return df
