"""Registered queries over the driver's tables and their SQL twins.

The tables stand in for feed data (an order is a post, its line items are comments, and so on): a query tests an
operator, not the reference's data. Every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfeed.functions import ids, payload, times
from quillfeed.functions.text import clean_html, utf8_trimmed_length
from quillfeed.operators import classify, contracts, coverage, manifest, merge, normalize, pages, recovery, resume_scan, scans, select, snapshots, states, timeline_joins
from quillfeed.session import materialise, read_table
from quillfeed.sources import landed, sinks, versions
from quillfeed.sources.sinks import markdown_block
from quillfeed.streaming import checkpoints, merge_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DOMAIN = "example.com"
#: A limit of posts above any table: the queries judge all of them.
NO_LIMIT = 1 << 62


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def millis(column: str):
    """Epoch milliseconds of a zoneless timestamp, read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(column))


@query(r"""
SELECT page_id, trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '(?i)</p>', chr(10), 'g'), '<[^>]+>', '', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
  '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cleaned
FROM pages""")
def q_clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", clean_html("html").alias("cleaned"))


@query("SELECT doc_id, CAST(strlen(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS INTEGER) AS n_bytes FROM documents")
def q_ascii_trim_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", utf8_trimmed_length("text").alias("n_bytes"))


@query(r"""
SELECT page_id, split_part(url, '://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host,
  regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1) AS last_segment,
  regexp_extract(url, '://([^/?#]*)', 1) LIKE '%.example.com' AS allowed
FROM pages""")
def q_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = ids.url_parts(F.col("url"))
    return read_table(spark, sf_dir, "pages").select(
        "page_id", p["scheme"].alias("scheme"), p["host"].alias("host"), p["last_segment"].alias("last_segment"),
        ids.on_domain(p["host"], DOMAIN).alias("allowed"),
    )


@query(r"""
SELECT page_id, CASE WHEN regexp_extract(url, '://([^/?#]*)', 1) LIKE '%.example.com'
  THEN 'https' || substr(url, instr(url, '://')) END AS canonical
FROM pages""")
def q_url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", ids.canonical_url(F.col("url"), DOMAIN).alias("canonical"))


@query(r"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages)
SELECT page_id, CASE WHEN host LIKE '%.example.com' THEN 'https://' || host || CASE page_id % 8
  WHEN 0 THEN '/b/' WHEN 1 THEN '/a%20b/c?x%20%27#y%20''' WHEN 2 THEN '/%C3%A9/%zz' WHEN 3 THEN '/c' WHEN 4 THEN '/' || page_id || '/'
  WHEN 5 THEN '/a/c?../d' WHEN 6 THEN '/%7Bx%7D' END END AS canonical FROM p""")
def q_url_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with dot segments, backslashes and characters that may not stand: each host with one of eight forms."""
    rows = read_table(spark, sf_dir, "pages")
    i, head = F.col("page_id"), F.regexp_extract("url", "^(https?://[^/?#]*)", 1)
    forms = ["/a/../b/.", "/a b/c?x '#y '", "/é/%zz", "/a\\b/%2e%2E/.%2e\\c", None, "/a/b/../c?../d", "/{x}", ":8080/a"]
    form = F.concat(F.lit("/x/../"), i.cast("string"), F.lit("/y/.."))
    for k, text in enumerate(forms):
        form = form if text is None else F.when(i % 8 == k, F.lit(text)).otherwise(form)
    return rows.select("page_id", ids.canonical_url(F.concat(head, form), DOMAIN).alias("canonical"))


@query(r"""
SELECT item AS page_id, user_id, post_id FROM (
  SELECT page_id AS item, CASE WHEN url LIKE 'https://%' AND regexp_extract(url, '://([^/?#]*)', 1) LIKE '%.example.com'
      AND page_id % 2 = 0 THEN '42' WHEN page_id % 2 = 1 THEN '7' END AS user_id,
    CASE WHEN page_id % 2 = 1 THEN CAST(page_id AS VARCHAR)
      WHEN url LIKE 'https://%' AND regexp_extract(url, '://([^/?#]*)', 1) LIKE '%.example.com' THEN CAST(page_id AS VARCHAR) END AS post_id
  FROM pages)""")
def q_post_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "pages")
    link = F.concat(F.regexp_extract("url", "^(https?://[^/?#]*)", 1), F.lit("/42/"), F.col("page_id").cast("string"))
    ref = F.when(F.col("page_id") % 2 == 1, F.concat(F.lit(" "), F.col("page_id").cast("string"))).otherwise(link)
    user, post = ids.post_reference(ref, DOMAIN, "7")
    return rows.select("page_id", user.alias("user_id"), post.alias("post_id"))


@query(r"""
SELECT event_id, (epoch_us(ts) // 1000) AS epoch_ms, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS local_time,
  (epoch_us(ts) // 1000000) * 1000 AS parsed_ms
FROM events""")
def q_epoch_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("event_id", millis("ts").alias("epoch_ms"))
    rows = rows.withColumn("local_time", times.format_epoch_ms(F.col("epoch_ms")))
    return rows.withColumn("parsed_ms", times.epoch_ms_from_text(F.col("local_time")))


@query("""
SELECT event_id, props LIKE '%"k"%' AS has_k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  (props LIKE '%"absent"%') AS has_absent FROM events""")
def q_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = payload.Payload(F.col("props"))
    return read_table(spark, sf_dir, "events").select(
        "event_id", p.has("k").alias("has_k"), ids.count_from_literal(p.literal("k")).alias("k"), p.has("absent").alias("has_absent")
    )


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE json_extract_string(props, '$.k') END AS found FROM events""")
def q_alias_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).otherwise("null")
    body = F.concat(F.lit('{"first":'), extra, F.lit(',"second":'), F.get_json_object("props", "$.k"), F.lit("}"))
    return read_table(spark, sf_dir, "events").select("event_id", payload.Payload(body).first_present("missing", "first", "second").alias("found"))


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 8 HOUR")
def q_since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("epoch_ms", millis("ts"))
    return pages.since_filter(rows, "epoch_ms", times.since_cutoff_ms("2024-01-15")).select("event_id", "user_id")


@query("SELECT event_id, event_type FROM events WHERE user_id = 7")
def q_author_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("item", F.to_json(F.struct(F.struct(F.col("user_id").alias("id")).alias("user"))))
    return normalize.by_author(rows, "7").select("event_id", "event_type")


@query("""
SELECT conv_id, turn, text AS clean_text, CAST(CASE WHEN turn % 2 = 0 THEN conv_id ELSE turn END AS VARCHAR) AS post_id,
  CASE WHEN turn % 3 = 0 THEN ['like_count'] ELSE []::VARCHAR[] END AS violations FROM conversations WHERE role = 'assistant'""")
def q_self_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as comments: the assistant's are the user's own; even turns name no post and belong to their conversation."""
    likes = F.when(F.col("turn") % 3 == 0, F.lit(-1)).otherwise(F.lit(1))
    item = F.to_json(
        F.struct(
            F.col("turn").alias("id"), F.struct(F.when(F.col("role") == "assistant", 7).otherwise(8).alias("id")).alias("user"), F.col("text"),
            F.when(F.col("turn") % 2 == 1, F.col("turn")).alias("status_id"), F.lit(0).alias("created_at"), likes.alias("like_count"), F.lit(1).alias("reply_count"),
        )
    )
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", F.col("turn"), F.col("conv_id").alias("post_id"), F.lit("").alias("post_target"), item.alias("item"))
    return scans.self_replies(rows, "7", DOMAIN).select("conv_id", "turn", "clean_text", "post_id", "violations")


@query("""
WITH x AS (SELECT event_id, event_id // 12 AS stream, 1 + (event_id // 12) % 2 AS page, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS mark FROM events),
s AS (SELECT stream, page, count(*) AS n, count(*) FILTER (WHERE mark = 1) AS pins FROM x GROUP BY 1, 2)
SELECT event_id, CASE WHEN n > 10 AND (x.page <> 1 OR pins <> n - 10) THEN 'unexplained_overflow' END AS violation,
  CASE WHEN n > 10 AND (x.page <> 1 OR pins <> n - 10) THEN NULL ELSE n <= 10 OR mark <> 1 END AS pageable
FROM x JOIN s USING (stream, page)""")
def q_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = F.floor(F.col("event_id") / 12)
    rows = read_table(spark, sf_dir, "events").select(
        "event_id", stream.alias("stream"), (1 + stream % 2).alias("page"), F.lit(10).alias("count"), F.when(F.col("event_type") == "click", 1).otherwise(0).alias("mark")
    )
    return pages.pinned_rows(rows, ["stream"], "page", "count").select("event_id", "violation", "pageable")


def record_body():
    """Records from documents, some of which break a rule that follows from their id."""
    i = F.col("doc_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    number = i.cast("string")
    quoted = F.when(i % 7 == 0, number).otherwise(F.concat(F.lit('"'), number, F.lit('"')))
    literal = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)
    clean = F.when(i % 3 == 0, F.concat(clean_html(text), F.lit("!"))).otherwise(clean_html(text))
    likes = F.when(i % 5 == 0, F.lit("-1")).otherwise(F.lit("4.0"))
    host = F.when(i % 11 == 0, "http").otherwise("https")
    extra = F.when(i % 13 == 0, ',"surprise":1').otherwise("")
    return F.concat(
        F.lit('{"schema_version":1,"record_contract":"normalized_v1","id":'), quoted, F.lit(',"created_at_raw":1752381296000,"created_at":"2025-07-13T12:34:56+08:00","text":'),
        literal(text), F.lit(',"clean_text":'), literal(clean), F.lit(',"target":"'), host, F.lit("://example.com/7/"), number,
        F.lit('","reply_count":3,"like_count":'), likes, F.lit(',"retweet_count":0,"view_count":9'), extra, F.lit("}"),
    )


@query("""
SELECT code, count(*) AS n_records FROM (
  SELECT 'id' AS code FROM documents WHERE doc_id % 7 = 0
  UNION ALL SELECT 'clean_text_differs' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT 'like_count' FROM documents WHERE doc_id % 5 = 0
  UNION ALL SELECT 'target' FROM documents WHERE doc_id % 11 = 0
  UNION ALL SELECT 'unsupported_field' FROM documents WHERE doc_id % 13 = 0) GROUP BY code""")
def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_table(spark, sf_dir, "documents").select(F.explode(contracts.violations(record_body(), DOMAIN)).alias("code"))
    return found.groupBy("code").agg(F.count(F.lit(1)).alias("n_records"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'normalized_v1/post' WHEN 1 THEN 'normalized_v1/reply' WHEN 2 THEN 'legacy_normalized_v1/post' END AS shape FROM events""")
def q_shape_discriminator(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = '{"schema_version":1,"id":"1","created_at":"unknown","created_at_raw":null,"reply_count":1,"like_count":1,'
    bodies = (
        base + '"record_contract":"normalized_v1","target":"t","text":"a","clean_text":"a","retweet_count":1,"view_count":1}',
        base + '"record_contract":"normalized_v1","post_id":"2","post_target":"t","text":"a","clean_text":"a"}',
        base + '"record_contract":"legacy_normalized_v1","target":"t","text":"a","retweet_count":1,"view_count":1}',
        base + '"record_contract":"normalized_v1","target":"t","text":"a","retweet_count":1,"view_count":1}',
    )
    body = F.lit(bodies[3])
    for k in (2, 1, 0):
        body = F.when(F.col("event_id") % 4 == k, bodies[k]).otherwise(body)
    return read_table(spark, sf_dir, "events").select("event_id", contracts.shape(body).alias("shape"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '["clean_text","created_at"]' END AS migrated, true AS valid FROM documents""")
def q_upgrade_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy documents (even ids) and stamped ones become strict records, which then hold."""
    i = F.col("doc_id").cast("string")
    legacy = F.concat(F.lit('{"id":'), i, F.lit(',"created_at_raw":" 1752381296 ","text":"a<br>b","target":"/7/'), i, F.lit('","reply_count":"3","like_count":4,"retweet_count":0,"view_count":9}'))
    stamped = F.concat(
        F.lit('{"schema_version":1,"id":"'), i, F.lit('","created_at_raw":"0","created_at":"unknown","text":"a","clean_text":"a","target":"https://example.com/7/'), i,
        F.lit('","reply_count":3,"like_count":4,"retweet_count":0,"view_count":9}'),
    )
    stamped = F.replace(stamped, F.lit('"created_at_raw":"0"'), F.lit('"created_at_raw":0'))
    rows = read_table(spark, sf_dir, "documents").select("doc_id", contracts.upgrade(F.when(F.col("doc_id") % 2 == 0, legacy).otherwise(stamped), DOMAIN).alias("body"))
    return rows.select("doc_id", payload.Payload(F.col("body")).literal("legacy_migrated_fields").alias("migrated"), (F.size(contracts.violations(F.col("body"), DOMAIN)) == 0).alias("valid"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'legacy' ELSE 'declared' END AS route,
  CASE WHEN doc_id % 3 = 0 THEN ['like_count'] ELSE []::VARCHAR[] END AS violations FROM documents""")
def q_recover_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    likes = F.when(F.col("doc_id") % 3 == 0, "-1").otherwise("4")
    tail = F.concat(F.lit(',"target":"https://example.com/7/'), i, F.lit('","reply_count":3,"retweet_count":0,"view_count":9,"like_count":'), likes, F.lit("}"))
    legacy = F.concat(F.lit('{"id":'), i, F.lit(',"created_at":"2026-07-14 09:00:00","text":"a<br>b"'), tail)
    declared = F.concat(
        F.lit('{"schema_version":1,"record_contract":"legacy_normalized_v1","id":"'), i, F.lit('","created_at_raw":null,"created_at":"unknown","clean_text":"a"'), tail
    )
    rows = read_table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, legacy).otherwise(declared).alias("body"))
    return recovery.recovered(rows, "7", DOMAIN).select("doc_id", "route", "violations")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.duplicate_keys(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""
WITH v AS (
  SELECT doc_id, -1 AS seq, text, text AS clean_text, source AS title, n_chars AS like_count, CASE WHEN doc_id % 2 = 0 THEN 'unknown' ELSE lang END AS created_at, 'a' AS created_at_raw FROM documents
  UNION ALL SELECT doc_id, 0, text || '+', text, lang, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE n_chars - 1 END, lang, 'b' FROM documents WHERE doc_id % 3 <> 0
  UNION ALL SELECT doc_id, 1, left(text, 5), left(text, 5), source, n_chars + 1, 'unknown', 'c' FROM documents WHERE doc_id % 5 = 0)
SELECT doc_id, arg_max(text, (strlen(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) + strlen(trim(clean_text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) * 10 + seq) AS text,
  arg_max(title, strlen(title) * 10 + seq) AS title,
  arg_max(like_count, seq) FILTER (WHERE like_count IS NOT NULL) AS like_count,
  coalesce(min(created_at) FILTER (WHERE created_at <> 'unknown'), 'unknown') AS created_at,
  coalesce(arg_max(created_at_raw, seq) FILTER (WHERE created_at <> 'unknown'), arg_max(created_at_raw, seq)) AS created_at_raw
FROM v GROUP BY doc_id""")
def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    row = lambda seq, text, clean, title, likes, made, raw: (
        i.alias("doc_id"), F.lit(seq).cast("long").alias("seq"), text.alias("text"), clean.alias("clean_text"), title.alias("title"),
        likes.cast("long").alias("like_count"), made.alias("created_at"), F.lit(raw).alias("created_at_raw"),
    )
    t, lang, source, n = F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars")
    stored = docs.select(*row(-1, t, t, source, n, F.when(i % 2 == 0, "unknown").otherwise(lang), "a"))
    first = docs.filter(i % 3 != 0).select(*row(0, F.concat(t, F.lit("+")), t, lang, F.when(i % 4 != 0, n - 1), lang, "b"))
    second = docs.filter(i % 5 == 0).select(*row(1, F.left(t, F.lit(5)), F.left(t, F.lit(5)), source, n + 1, F.lit("unknown"), "c"))
    merged = merge.upsert(stored, first.unionByName(second), "doc_id", "seq", merge.RECORD_RULES)
    return merged.select("doc_id", "text", "title", "like_count", "created_at", "created_at_raw")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN ['post_id'] ELSE []::VARCHAR[] END AS conflicts FROM orders""")
def q_merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    base = orders.select("o_orderkey", F.lit(0).cast("long").alias("seq"), F.lit("post").alias("kind"), F.col("o_custkey").cast("string").alias("post_id"), F.lit(None).cast("string").alias("reply_to"))
    again = base.select(
        "o_orderkey", F.lit(1).cast("long").alias("seq"), "kind",
        F.when(F.col("o_orderkey") % 10 == 0, F.concat("post_id", F.lit("x"))).otherwise(F.col("post_id")).alias("post_id"), F.lit("9").alias("reply_to"),
    )
    return merge.merge_versions(base.unionByName(again), "o_orderkey", "seq", merge.RECORD_RULES).select("o_orderkey", "conflicts")


@query("""
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 9 = 0 THEN 0 ELSE (epoch_us(ts) // 1000) END DESC,
  length(CAST(event_id AS VARCHAR)) DESC, CAST(event_id AS VARCHAR) DESC) AS INTEGER) AS position FROM events""")
def q_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 9 != 0, millis("ts")).alias("epoch_ms"), F.col("event_id").cast("string").alias("id"))
    return merge.numbered(rows, ["user_id"], merge.total_order()).select("event_id", "user_id", "position")


@query("""
SELECT user_id, arg_max(value, event_id) AS reply_count, arg_max(event_type, strlen(event_type) * 1000000000 + event_id) AS title
FROM events GROUP BY user_id""")
def q_union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillfeed.sources.landed import union_streams

    rows = read_table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.col("value").alias("reply_count"), F.col("event_type").alias("title"))
    both = union_streams(rows.filter("title = 'click'"), rows.filter("title <> 'click' or title is null"))
    return merge.merge_versions(both, "user_id", "seq", merge.RECORD_RULES).select("user_id", "reply_count", "title")


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def q_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.col("event_id").alias("seq"))
    return merge.last_wins(rows, "user_id", "seq").select("user_id", "event_id", "value")


@query("SELECT doc_id, 'stored' AS origin FROM labels UNION ALL SELECT doc_id, 'fetched' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, sf_dir, "labels").select("doc_id", F.lit("stored").alias("origin"))
    return merge.first_wins(stored, read_table(spark, sf_dir, "documents").select("doc_id", F.lit("fetched").alias("origin")), "doc_id")


@query("SELECT event_id FROM (SELECT event_id, (epoch_us(ts) // 1000) AS e FROM events) ORDER BY e DESC, length(CAST(event_id AS VARCHAR)) DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1")
def q_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("event_id", millis("ts").alias("epoch_ms"), F.col("event_id").cast("string").alias("id"))
    return merge.latest(rows).select("event_id")


@query("""
WITH d AS (SELECT o_orderkey, o_orderkey % 5 AS kind, 1 + o_orderkey % 3 AS page, CASE WHEN o_orderkey % 2 = 0 THEN 10 ELSE 6 END AS n FROM orders)
SELECT o_orderkey,
  CASE kind WHEN 0 THEN n < 10 WHEN 1 THEN false WHEN 2 THEN page >= 2 AND (page <= 2 OR n = 0) WHEN 3 THEN NULL ELSE false END AS complete,
  CASE kind WHEN 0 THEN false WHEN 1 THEN false WHEN 2 THEN page >= 2 WHEN 3 THEN NULL ELSE false END AS explicit,
  CASE WHEN kind = 3 THEN 'conflicting_has_more' WHEN kind = 2 AND page > 2 THEN 'page_count_contradiction' END AS violation
FROM d WHERE NOT (kind = 2 AND page > 2)
UNION ALL SELECT o_orderkey, NULL, NULL, 'page_count_contradiction' FROM d WHERE kind = 2 AND page > 2""")
def q_pagination_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    body = (
        F.when(i % 5 == 0, "{}").when(i % 5 == 1, '{"meta":{"hasMore":"true"}}').when(i % 5 == 2, '{"maxPage":"2","meta":{"page_count":2}}')
        .when(i % 5 == 3, '{"has_more":true,"meta":{"hasMore":0}}').otherwise('{"has_more":false,"next_cursor":"c9"}')
    )
    n, page = F.when(i % 2 == 0, 10).otherwise(6), 1 + i % 3
    decision = pages.pagination_decision(body, page, F.lit(10), n, (page - 1) * 10 + n)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", decision.alias("d")).select("o_orderkey", "d.complete", "d.explicit", "d.violation")


@query("""
WITH d AS (SELECT o_orderkey, o_orderkey % 4 AS kind FROM orders)
SELECT o_orderkey, CASE kind WHEN 0 THEN true WHEN 1 THEN false END AS complete,
  CASE kind WHEN 2 THEN 'mixed_evidence' WHEN 3 THEN 'page_count_conflicts_with_total' END AS violation FROM d""")
def q_pagination_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("o_orderkey")
    body = (
        F.when(i % 4 == 0, '{"has_more":false,"max_page":1,"total":5,"next":"ignored"}').when(i % 4 == 1, '{"has_more":true,"max_page":2}')
        .when(i % 4 == 2, '{"has_more":true,"max_page":1}').otherwise('{"max_page":2,"total":5}')
    )
    decision = pages.pagination_decision(body, F.lit(1), F.lit(10), F.lit(5), F.lit(5), strict=True)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", decision.alias("d")).select("o_orderkey", "d.complete", "d.violation")


@query("""
WITH f AS (SELECT l_suppkey, l_partkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2),
n AS (SELECT l_suppkey, l_linenumber, count(*) AS fresh FROM f GROUP BY 1, 2), p AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem)
SELECT l_suppkey, l_linenumber, CAST(sum(coalesce(fresh, 0)) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) AS BIGINT) AS observed FROM p LEFT JOIN n USING (l_suppkey, l_linenumber)""")
def q_observed_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.running_observed(read_table(spark, sf_dir, "lineitem"), "l_suppkey", "l_linenumber", "l_partkey")


@query("""
WITH x AS (SELECT user_id, event_id // 100 AS page, value FROM events)
SELECT user_id, min(page) FILTER (WHERE value > 90) AS stop_page, min(page) FILTER (WHERE value > 90) IS NULL AS truncated FROM x GROUP BY user_id""")
def q_stop_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("user_id", F.floor(F.col("event_id") / 100).alias("page"), "value")
    return pages.stop_pages(rows, "user_id", "page", F.col("value") > 90)


@query("""
WITH x AS (SELECT user_id, event_id // 500 AS page, event_id AS pos, CASE WHEN event_id % 301 = 0 THEN NULL ELSE 1800000000000 - event_id * 1000 + CASE WHEN event_id % 97 = 0 THEN 9000000 ELSE 0 END END AS epoch FROM events),
l AS (SELECT *, last_value(epoch IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM x),
p AS (SELECT user_id, page, count(*) FILTER (WHERE epoch IS NULL OR epoch > prior) AS broken, count(*) FILTER (WHERE epoch < 1799999000000) AS older, count(*) AS n FROM l GROUP BY 1, 2),
o AS (SELECT *, sum(broken) OVER (PARTITION BY user_id ORDER BY page) = 0 AS ordered FROM p),
c AS (SELECT *, ordered AND older > 0 AS candidate FROM o)
SELECT user_id, page, candidate, coalesce(lag(candidate) OVER (PARTITION BY user_id ORDER BY page), false) AND ordered AND n = older AS confirmed FROM c""")
def q_since_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    epoch = F.when(i % 301 != 0, F.lit(1_800_000_000_000) - i * 1000 + F.when(i % 97 == 0, 9_000_000).otherwise(0))
    rows = read_table(spark, sf_dir, "events").select("user_id", F.floor(i / 500).alias("page"), i.alias("pos"), epoch.alias("epoch"))
    return pages.since_boundary(rows, "user_id", "page", "pos", "epoch", 1_799_999_000_000)


@query("SELECT o_orderkey, greatest(1, CAST(ceil((o_orderkey % 50) / 20.0) AS BIGINT) + 2) AS budget FROM orders")
def q_page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select("o_orderkey", pages.page_budget(F.col("o_orderkey") % 50, 20).cast("long").alias("budget"))


@query("""
SELECT event_id, user_id FROM events e WHERE event_id < coalesce((SELECT min(event_id) FROM events f WHERE f.user_id = e.user_id AND f.event_type = 'purchase'), 9223372036854775807)""")
def q_before_first_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return pages.before_first_error(rows, "user_id", "event_id", "event_type", ("purchase",)).select("event_id", "user_id")


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority AS code FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders WHERE o_orderpriority <> '5-LOW') WHERE r = 1""")
def q_first_valid_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("code"))
    return classify.first_valid_attempt(rows, "o_custkey", "o_orderkey", missing=("5-LOW",))


def posts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts: position in time order is the key itself."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("reply_count"))
    return lines.select(F.col("l_orderkey").alias("post_id"), F.col("l_orderkey").alias("position"), "reply_count")


def baselines_of(posts: DataFrame) -> DataFrame:
    changed = F.when(F.col("post_id") % 4 == 0, F.col("reply_count") + 1).when(F.col("post_id") % 4 == 1, F.col("reply_count") - 1).otherwise(F.col("reply_count"))
    return posts.filter("post_id % 3 <> 0").select("post_id", changed.alias("reply_count"))


@query("""
WITH p AS (SELECT l_orderkey AS post_id, count(*) AS reply_count FROM lineitem GROUP BY 1)
SELECT post_id, reply_count FROM p WHERE post_id % 3 = 0 OR post_id % 4 <= 1""")
def q_changed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = posts_of(spark, sf_dir)
    return select.changed_posts(posts, baselines_of(posts), "position", "reply_count", NO_LIMIT).select("post_id", "reply_count")


@query("""
WITH p AS (SELECT l_orderkey AS post_id, count(*) AS reply_count FROM lineitem GROUP BY 1),
b AS (SELECT post_id, reply_count + CASE post_id % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS reply_count FROM p WHERE post_id % 3 <> 0),
f AS (SELECT post_id, reply_count FROM p WHERE post_id % 5 <> 0 AND post_id % 7 <> 0)
SELECT post_id, coalesce(f.reply_count, b.reply_count) AS reply_count FROM b FULL JOIN f USING (post_id)""")
def q_checkpoint_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = posts_of(spark, sf_dir)
    confirmed = select.confirmed_ids(posts, posts.filter("post_id % 5 = 0"), posts.filter("post_id % 7 = 0"))
    return select.advance_checkpoint(baselines_of(posts), posts, confirmed, "position", "reply_count", NO_LIMIT)


@query("""
WITH t AS (SELECT o_orderkey, (epoch_us(o_orderdate) // 1000) AS e FROM orders ORDER BY e DESC, length(CAST(o_orderkey AS VARCHAR)) DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 80),
c AS (SELECT *, e >= (SELECT max((epoch_us(o_orderdate) // 1000)) FROM orders) - 21 * 86400000 AS recent FROM t)
SELECT o_orderkey FROM c WHERE recent OR NOT EXISTS (SELECT 1 FROM c WHERE recent)""")
def q_recent_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", millis("o_orderdate").alias("epoch_ms"), F.col("o_orderkey").cast("string").alias("post_id"))
    as_of = rows.agg(F.max("epoch_ms")).first()[0] or 0
    return select.recent_posts(rows, as_of, 21, 80).select("o_orderkey")


@query("SELECT conv_id, turn, role FROM conversations WHERE turn >= CASE WHEN conv_id % 3 = 0 THEN 0 ELSE 2 END")
def q_resume_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    then = F.when(F.col("conv_id") % 3 == 0, "old").otherwise("same")
    start, _ = select.resume_start(F.lit(2), F.lit("same"), then, F.lit("r"), F.lit("r"))
    return read_table(spark, sf_dir, "conversations").filter(F.col("turn") >= start).select("conv_id", "turn", "role")


@query("""
WITH r AS (SELECT conv_id, sha256(to_json({turn: turn, role: role, text: text})) AS d, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place FROM conversations),
b AS (SELECT conv_id, place // 65536 AS block, sha256(string_agg(d, '' ORDER BY place)) AS b FROM r GROUP BY 1, 2)
SELECT conv_id, sha256(string_agg(b, '' ORDER BY block)) AS digest FROM b GROUP BY 1""")
def q_ordered_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.ordered_digest(read_table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role", "text"], "turn", "role", "text")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.skip_existing(read_table(spark, sf_dir, "documents").select("doc_id"), read_table(spark, sf_dir, "labels"), "doc_id")


@query("""
SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN CAST(d.n_chars AS BIGINT) WHEN l.doc_id IS NULL THEN CAST(d.n_chars AS BIGINT) ELSE CAST(l.quality AS BIGINT) END AS reply_count,
  CASE WHEN d.doc_id % 2 = 0 OR l.doc_id IS NOT NULL THEN 5 END AS view_count,
  CASE WHEN d.doc_id % 2 = 1 AND l.doc_id IS NULL THEN 'detail_missing' END AS violation
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_hydrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    full = F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"reply_count":'), F.col("n_chars").cast("string"), F.lit(',"likeCount":1,"retweet_count":2,"viewCount":5}'))
    sparse = F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"reply_count":'), F.col("n_chars").cast("string"), F.lit("}"))
    rows = read_table(spark, sf_dir, "documents").select(i.alias("id"), F.when(i % 2 == 0, full).otherwise(sparse).alias("item"))
    detail = F.concat(F.lit('{"id":"'), i.cast("string"), F.lit('","reply_count":'), F.col("quality").cast("string"), F.lit(',"like_count":1,"retweet_count":2,"view_count":5}'))
    found = normalize.hydrate(rows, read_table(spark, sf_dir, "labels").select(i.alias("id"), detail.alias("detail")))
    p = payload.Payload(F.col("item"))
    number = lambda *names: ids.count_from_literal(normalize.hydrated_value(p, *names))
    return found.select(F.col("id").alias("doc_id"), number("reply_count", "replyCount").alias("reply_count"), number("view_count", "viewCount").cast("int").alias("view_count"), "violation")


@query("""
SELECT user_id || ':' || event_id AS item, event_id, 'https://example.com/7/' || CAST(event_id AS VARCHAR) AS target,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS created_at, CAST(floor(value) AS BIGINT) AS reply_count,
  CASE WHEN event_id % 6 = 0 THEN ['view_count'] ELSE []::VARCHAR[] END AS violations FROM events""")
def q_normalize_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda c: c.cast("string")
    views = F.when(F.col("event_id") % 6 == 0, ',"view_count":true').otherwise(',"viewCount":" 12 "')
    item = F.concat(
        F.lit('{"id":'), number(F.col("event_id")), F.lit(',"created_at":'), number(millis("ts")), F.lit(',"text":"<p>x</p>","reply_count":'), number(F.floor("value")),
        F.lit(',"like_count":1,"retweetCount":"2"'), views, F.lit("}"),
    )
    rows = read_table(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_id").alias("name"), "event_id", item.alias("item"))
    found = normalize.normalize_posts(rows, "7", DOMAIN)
    return found.select(F.col("name").alias("item"), "event_id", "target", "created_at", "reply_count", "violations")


@query("""
SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN ['post_reference'] ELSE []::VARCHAR[] END AS violations,
  CAST(conv_id AS VARCHAR) AS post_id, 'https://example.com/7/' || CAST(conv_id AS VARCHAR) AS post_target, 'post ' || CAST(conv_id AS VARCHAR) AS post_title FROM conversations""")
def q_normalize_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations")
    conv = F.col("conv_id").cast("string")
    other = F.when(F.col("turn") % 5 == 4, F.lit("999999999")).otherwise(conv)
    item = F.concat(
        F.lit('{"id":'), F.col("turn").cast("string"), F.lit(',"status_id":'), conv, F.lit(',"target_id":"'), other,
        F.lit('","created_at":0,"description":"d","user":{"id":5},"like_count":1,"replyCount":0}'),
    )
    posts = table.select(conv.alias("post_id")).distinct().select(
        "post_id", F.lit("null").alias("created_at_raw"), F.concat(F.lit("post "), "post_id").alias("title"), F.lit("t").alias("clean_text"),
        F.concat(F.lit("https://example.com/7/"), "post_id").alias("target"),
    )
    return normalize.normalize_replies(table.select("conv_id", "turn", item.alias("item")), posts, "7", DOMAIN, "post_comments").select("conv_id", "turn", "violations", "post_id", "post_target", "post_title")


@query("SELECT a.conv_id, a.turn, a.text, b.conv_id % 97 AS root_post_id FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = 0 WHERE a.turn > 0")
def q_thread_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First turns are comments, all later ones their second-level comments."""
    rows = read_table(spark, sf_dir, "conversations")
    roots = rows.filter("turn = 0").select(F.col("conv_id").alias("id"), (F.col("conv_id") % 97).alias("post_id"))
    nested = rows.filter("turn > 0").select("conv_id", "turn", "text", F.col("conv_id").alias("root_comment_id"))
    return normalize.threads(roots, nested).select("conv_id", "turn", "text", "root_post_id")


@query("SELECT c_custkey, n_regionkey AS root_post_id FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def q_nested_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as second-level comments of nations, which are comments of regions."""
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("post_id"))
    nested = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("root_comment_id"))
    return normalize.threads(nation, nested).select("c_custkey", "root_post_id")


def covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as comments of their order; the declared count is the order's key modulo 7."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("post_id"), F.col("l_linenumber").alias("page"), F.col("l_linenumber").alias("comment_id"),
        (F.col("l_orderkey") % 6 != 0).alias("complete"), (F.col("l_orderkey") % 2 == 0).alias("explicit"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_orderkey") % 5).alias("endpoint_count"),
    )
    posts = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), (F.col("o_orderkey") % 7).alias("reply_count"))
    return coverage.coverage(lines, posts)


_COVERED = """
WITH s AS (SELECT l_orderkey AS post_id, count(DISTINCT l_linenumber) AS observed, l_orderkey % 6 <> 0 AS complete, l_orderkey % 6 <> 0 AND l_orderkey % 2 = 0 AS explicit,
  CASE WHEN l_orderkey % 6 <> 0 AND l_orderkey % 3 = 0 THEN l_orderkey % 5 END AS endpoint FROM lineitem GROUP BY l_orderkey),
d AS (SELECT s.*, coalesce(endpoint, CASE WHEN o_orderkey IS NOT NULL THEN o_orderkey % 7 END) AS declared FROM s LEFT JOIN orders ON post_id = o_orderkey),
c AS (SELECT *, coalesce(observed > declared OR (observed < declared AND NOT explicit), false) AS unverified FROM d)"""


@query(_COVERED + """
SELECT post_id, declared, observed, NOT complete AS truncated, unverified,
  CASE WHEN observed < declared AND NOT unverified THEN declared - observed END AS unavailable_count FROM c""")
def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered(spark, sf_dir).select("post_id", "declared", "observed", "truncated", "unverified", F.col("gap.unavailable_count").alias("unavailable_count"))


@query(_COVERED + """
SELECT count(*) AS scanned, count(*) FILTER (WHERE NOT complete) AS truncated, count(*) FILTER (WHERE unverified) AS unverified,
  count(*) FILTER (WHERE observed < declared AND NOT unverified) AS gaps,
  CASE WHEN count(*) FILTER (WHERE NOT complete) > 0 THEN 'partial_page_limit' WHEN count(*) FILTER (WHERE unverified) > 0 THEN 'partial_incomplete_response'
    WHEN count(*) FILTER (WHERE observed < declared AND NOT unverified) > 0 THEN 'accessible_main_stream_complete_with_known_gaps' ELSE 'changed_posts_main_stream_complete' END AS coverage,
  CASE WHEN count(*) FILTER (WHERE NOT complete) > 0 OR count(*) FILTER (WHERE unverified) > 0 THEN 'needs_verification' ELSE 'complete' END AS status,
  CASE WHEN count(*) FILTER (WHERE NOT complete) > 0 OR count(*) FILTER (WHERE unverified) > 0 THEN 2 ELSE 0 END AS exit_code FROM c""")
def q_coverage_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.summary(covered(spark, sf_dir), F.col("scanned"))


@query("""
WITH u AS (SELECT user_id, count(*) AS attempted, count(*) FILTER (WHERE event_type = 'view') AS valid, count(*) FILTER (WHERE event_type = 'purchase') AS failures FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN valid = 0 AND failures > 0 AND user_id % 2 = 0 THEN 'failed' WHEN failures > 0 THEN 'needs_verification' ELSE 'complete' END AS status,
  CASE WHEN valid = 0 AND failures > 0 AND user_id % 2 = 0 THEN 1 WHEN failures > 0 THEN 2 ELSE 0 END AS exit_code FROM u""")
def q_status_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = read_table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("event_type") == "view").alias("valid"), F.count_if(F.col("event_type") == "purchase").alias("failures")
    )
    status = coverage.attempt_status(F.col("attempted"), F.col("valid"), F.col("failures"), F.col("user_id") % 2)
    return counted.select("user_id", status.alias("status")).withColumn("exit_code", coverage.exit_code(F.col("status")))


@query("""
SELECT DISTINCT event_type AS source, CASE event_id % 4 WHEN 0 THEN 'endpoint_missing' WHEN 1 THEN 'response_encoding' WHEN 2 THEN 'response_contract' END AS category,
  CASE event_id % 4 WHEN 0 THEN 'HTTP_404' WHEN 1 THEN 'INVALID_JSON' WHEN 2 THEN 'INVALID_RESPONSE_SHAPE' END AS code,
  CASE event_id % 4 WHEN 0 THEN 'HTTP_404' ELSE 'm' END AS message FROM events WHERE event_id % 4 < 3""")
def q_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id") % 4
    code = F.when(i == 0, "HTTP_404").when(i == 1, "INVALID_JSON").when(i == 2, "INVALID_RESPONSE_SHAPE").otherwise("WAF")
    rows = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), code.alias("code"), F.when(i == 0, "").otherwise("m").alias("message"))
    return classify.drift_signals(rows)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id") % 10
    body = (
        F.when(i == 0, '{"captcha":1}').when(i == 1, '{"error_code":"20101"}').when(i == 2, "oops 10020").when(i == 3, "not json").when(i == 4, "<i>renderData</i>")
        .when(i == 5, '{"a":1,"a":2}').when(i == 6, '{"error_code":0}').otherwise(F.col("props"))
    )
    status = F.when(i == 2, 400).when(i == 7, 503).otherwise(200)
    kind = F.when(i == 8, "text/html; charset=utf-8").when(i == 3, "application/json").when(i == 4, "").otherwise("application/json")
    return read_table(spark, sf_dir, "events").select("event_id", classify.json_code(status, kind, body).alias("code"))


_CODES = """CASE event_id % 10 WHEN 0 THEN 'WAF' WHEN 1 THEN 'API_20101' WHEN 2 THEN 'API_10020' WHEN 3 THEN 'INVALID_JSON' WHEN 4 THEN 'WAF'
  WHEN 5 THEN 'DUPLICATE_KEYS' WHEN 7 THEN 'HTTP_503' WHEN 8 THEN 'WAF' ELSE 'OK' END"""


@query(f"SELECT event_id, {_CODES} AS code FROM events")
def q_response_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir)


@query(f"SELECT count(*) AS requests, count(*) FILTER (WHERE c <> 'OK') AS errors, count(*) FILTER (WHERE c = 'WAF') AS waf FROM (SELECT {_CODES} AS c FROM events)")
def q_request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.request_metrics(responses(spark, sf_dir))


@query("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'OK' WHEN 1 THEN 'HTTP_500' WHEN 2 THEN 'INVALID_CONTENT_TYPE' ELSE 'INVALID_HTML' END AS code FROM pages""")
def q_html_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id") % 4
    code = classify.html_code(F.when(i == 1, 500).otherwise(200), F.when(i == 2, "image/png").otherwise("text/html"), F.when(i == 3, " \n").otherwise(F.col("html")))
    return read_table(spark, sf_dir, "pages").select("page_id", code.alias("code"))


@query("""
SELECT 'documents' AS segment, count(*) AS n_rows, count(DISTINCT doc_id) AS unique_ids, CAST(min(n_chars) AS VARCHAR) AS min_time, CAST(max(n_chars) AS VARCHAR) AS max_time FROM documents
UNION ALL SELECT 'events', count(*), count(DISTINCT event_id), CAST(min((epoch_us(ts) // 1000)) AS VARCHAR), CAST(max((epoch_us(ts) // 1000)) AS VARCHAR) FROM events
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), CAST(min((epoch_us(o_orderdate) // 1000)) AS VARCHAR), CAST(max((epoch_us(o_orderdate) // 1000)) AS VARCHAR) FROM orders""")
def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, events, orders = (read_table(spark, sf_dir, t) for t in ("documents", "events", "orders"))
    parts = [
        manifest.segments(docs.select("doc_id", "n_chars"), F.lit("documents"), "doc_id", "n_chars"),
        manifest.segments(events.select("event_id", millis("ts").alias("t")), F.lit("events"), "event_id", "t"),
        manifest.segments(orders.select("o_orderkey", millis("o_orderdate").alias("t")), F.lit("orders"), "o_orderkey", "t"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("segment", "n_rows", "unique_ids", F.col("min_time").cast("string").alias("min_time"), F.col("max_time").cast("string").alias("max_time"))


@query("""
WITH h AS (SELECT *, sha256(to_json({doc_id: doc_id, text: text, lang: lang, source: source, n_chars: n_chars})) AS d FROM documents)
SELECT source AS segment, count(*) AS n_rows, count(DISTINCT doc_id) AS unique_ids, min(n_chars) AS min_time, max(n_chars) AS max_time,
  sha256(CAST(sum(CAST(('0x' || substr(d, 1, 15)) AS HUGEINT)) AS VARCHAR) || ':' || CAST(sum(CAST(('0x' || substr(d, 17, 15)) AS HUGEINT)) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)) AS digest
FROM h GROUP BY source""")
def q_manifest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return manifest.segments(docs, F.col("source"), "doc_id", "n_chars")


@query("""
SELECT 2 * doc_id AS doc_id, 'missing' AS difference FROM labels WHERE 2 * doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT doc_id, 'undeclared' FROM documents WHERE doc_id NOT IN (SELECT 2 * doc_id FROM labels)""")
def q_inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = read_table(spark, sf_dir, "labels").select((2 * F.col("doc_id")).alias("doc_id"))
    return manifest.inventory_difference(declared, read_table(spark, sf_dir, "documents"), "doc_id")


@query("SELECT count(*) AS n_uncovered FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_overlap_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents").select("doc_id"), read_table(spark, sf_dir, "labels")
    return manifest.not_covered(docs, labels, "doc_id").agg(F.count(F.lit(1)).alias("n_uncovered"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ['auth_token'] ELSE []::VARCHAR[] END AS forbidden FROM events")
def q_forbidden_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("event_id") % 3 == 0, '{"id":1,"auth_token":"x"}').otherwise(F.col("props"))
    return read_table(spark, sf_dir, "events").select("event_id", manifest.forbidden_fields(body).alias("forbidden"))


@query("SELECT page_id FROM pages WHERE regexp_matches(url, '(^|[^0-9])2([^0-9]|$)') OR regexp_matches(html, '(^|[^0-9])7([^0-9]|$)')")
def q_exact_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.has_exact_number(F.col("url"), "2") | manifest.has_exact_number(F.col("html"), "7")
    return read_table(spark, sf_dir, "pages").filter(found).select("page_id")


@query("""
SELECT o_orderkey AS post_id, o_orderkey % 9 AS declared_count FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, 100 + o_orderkey % 9 FROM orders WHERE o_orderkey % 6 = 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0""")
def q_gap_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"))
    key = F.col("post_id")
    current = posts.filter(key % 4 == 0).select("post_id", (key % 9).alias("declared_count"))
    previous = posts.filter(key % 6 == 0).select("post_id", (100 + key % 9).alias("declared_count"))
    return merge.reconcile_gaps(previous, current, posts.filter(key % 4 == 0), posts.filter(key % 5 != 0))


@query("""
SELECT conv_id, turn, '## Reply ' || CAST(turn + 1 AS VARCHAR) || chr(10) || chr(10) || 'ID: ' || CAST(turn AS VARCHAR) || chr(10) || 'Time: unknown' || chr(10) || 'Origin: ' || role || chr(10)
  || 'Post ID: ' || CAST(conv_id AS VARCHAR) || chr(10) || 'Post Link: ' || chr(10) || chr(10) || coalesce(text, '') || chr(10) || chr(10) || '---' || chr(10) AS block FROM conversations""")
def q_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("turn").alias("id"), F.lit("unknown").alias("created_at"), F.col("role").alias("origin"), F.col("conv_id").alias("post_id"),
        F.lit(None).cast("string").alias("post_target"), F.col("text").alias("clean_text"),
    )
    return rows.select("conv_id", "turn", markdown_block("replies", F.col("turn") + 1).alias("block"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def q_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_stream.windowed_counts(read_table(spark, sf_dir, "events"), "ts", "event_type")


@query("""
SELECT user_id, arg_max(value, event_id) AS reply_count, arg_max(event_type, strlen(event_type) * 1000000000 + event_id) AS title FROM events GROUP BY user_id""")
def q_stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of files, merged batch by batch into a corpus, which is the result."""
    import uuid

    from quillfeed.session import ensure_checkpoint_dir, remember

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    remember(spark, base)
    schema = read_table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").select(
        "user_id", F.col("event_id").alias("seq"), F.col("value").alias("reply_count"), F.col("event_type").alias("title")
    )
    merge_stream.merge_stream(stream, f"{base}/corpus", f"{base}/state", "user_id", "seq", merge.RECORD_RULES).awaitTermination()
    return merge_stream.read_corpus(spark, f"{base}/corpus").select("user_id", "reply_count", "title")


@query("""
SELECT event_id, pos, CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(event_id + pos AS VARCHAR) END AS item,
  CASE event_id % 4 WHEN 2 THEN 'not_an_array' WHEN 3 THEN 'missing_array' END AS violation
FROM (SELECT event_id, unnest(CASE WHEN event_id % 4 <= 1 THEN [0, 1] ELSE [NULL] END) AS pos FROM events)""")
def q_array_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of each body, from the first alias that is present; a body without an array keeps its row."""
    i = F.col("event_id")
    pair = F.concat(F.lit("["), i.cast("string"), F.lit(","), (i + 1).cast("string"), F.lit("]"))
    body = (
        F.when(i % 4 == 0, F.concat(F.lit('{"list":'), pair, F.lit("}"))).when(i % 4 == 1, F.concat(F.lit('{"items":[9],"statuses":'), pair, F.lit("}")))
        .when(i % 4 == 2, F.concat(F.lit('{"statuses":{},"list":'), pair, F.lit("}"))).otherwise("{}")
    )
    return pages.explode_items(read_table(spark, sf_dir, "events").select("event_id", body.alias("body")), pages.TIMELINE_ITEMS).select("event_id", "pos", "item", "violation")


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN CAST(event_id AS VARCHAR) ELSE '"old"' END AS preferred FROM events""")
def q_primary_else_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new name wins where it is present, even with null; else the old name."""
    i = F.col("event_id")
    new = F.when(i % 3 == 0, '"new":null,').when(i % 3 == 1, F.concat(F.lit('"new":'), i.cast("string"), F.lit(","))).otherwise("")
    body = F.concat(F.lit("{"), new, F.lit('"old":"old"}'))
    return read_table(spark, sf_dir, "events").select("event_id", payload.Payload(body).preferred("new", "old").alias("preferred"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CAST(event_id AS VARCHAR) END AS raw, CASE WHEN event_id % 4 = 0 THEN '["post_created_at_raw"]' END AS migrated FROM events""")
def q_predecessor_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of version 1 without a contract get the raw time of their post; all others stay."""
    i = F.col("event_id")
    kind = F.when(i % 4 == 1, '"schema_version":1,"record_contract":"normalized_v1",').when(i % 4 == 2, "").otherwise('"schema_version":1,')
    time = F.when(i % 4 == 3, "").otherwise(F.concat(F.lit(',"post_created_at":'), i.cast("string")))
    body = contracts.upgrade_predecessor_reply(F.concat(F.lit("{"), kind, F.lit('"id":"1"'), time, F.lit("} ")))
    p = payload.Payload(F.col("body"))
    rows = read_table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return rows.select("event_id", p.literal("post_created_at_raw").alias("raw"), p.literal("legacy_migrated_fields").alias("migrated"))


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN ['created_at'] WHEN 2 THEN ['reply_count'] WHEN 3 THEN ['record_contract'] ELSE []::VARCHAR[] END AS violations,
  CASE WHEN doc_id % 5 IN (0, 4) THEN '2026-07-14T09:08:07+08:00' END AS created_at, doc_id % 5 IN (0, 4) AS same FROM documents""")
def q_corpus_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records in their normal form, which a second pass leaves as it is."""
    i = F.col("doc_id")
    made = F.when(i % 5 == 1, "2026-07-14").otherwise("2026-07-14 09:08:07")
    count = F.when(i % 5 == 2, "true").otherwise('"4"')
    stamp = F.when(i % 5 == 3, ',"record_contract":"legacy_normalized_v1"').otherwise("")
    body = F.concat(
        F.lit('{"id":'), i.cast("string"), F.lit(',"created_at":"'), made, F.lit('","target":"/7/'), i.cast("string"), F.lit('","reply_count":'), count,
        F.lit(',"post_id":456,"in_reply_to_comment_id":null'), stamp, F.lit("}"),
    )
    rows = read_table(spark, sf_dir, "documents").select("doc_id", contracts.corpus_record(body, DOMAIN).alias("r")).select("doc_id", "r.record", "r.violations")
    again = contracts.corpus_record(F.col("record"), DOMAIN)["record"]
    return rows.select("doc_id", "violations", F.get_json_object("record", "$.created_at").alias("created_at"), F.coalesce(again == F.col("record"), F.lit(False)).alias("same"))


@query("SELECT event_id, event_id % 5 <= 1 AS fine FROM events")
def q_acquisition_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows carry both markers with their current values or none."""
    i = F.col("event_id") % 5
    body = (
        F.when(i == 0, '{"id":1}').when(i == 1, '{"schema_version":1,"record_contract":"normalized_v1"}').when(i == 2, '{"schema_version":1}')
        .when(i == 3, '{"schema_version":2,"record_contract":"normalized_v1"}').otherwise('{"record_contract":"normalized_v1"}')
    )
    return read_table(spark, sf_dir, "events").select("event_id", contracts.acquisition_markers_ok(body).alias("fine"))


@query("""
SELECT event_id, CASE event_id % 5 WHEN 1 THEN ['running_and_finished'] WHEN 2 THEN ['failed_without_error'] WHEN 3 THEN ['drift_without_signals'] ELSE []::VARCHAR[] END AS violations FROM events""")
def q_report_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id") % 5
    body = (
        F.when(i == 0, '{"status":"complete","finished_at":"t"}').when(i == 1, '{"status":"running","finished_at":"t"}').when(i == 2, '{"status":"failed","finished_at":"t"}')
        .when(i == 3, '{"status":"complete","finished_at":"t","interface_drift":{"detected":true,"signals":[]}}').otherwise('{"status":"failed","finished_at":"t","error":{"code":"x"}}')
    )
    return read_table(spark, sf_dir, "events").select("event_id", contracts.report_violations(body).alias("violations"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ['a', 'z'] ELSE []::VARCHAR[] END AS unknown FROM events")
def q_closed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("event_id") % 3 == 0, '{"z":1,"id":2,"a":null}').otherwise('{"id":1}')
    return read_table(spark, sf_dir, "events").select("event_id", contracts.closed_fields(body, ["id", "text"]).alias("unknown"))


@query("SELECT event_type || ' of ' || user_id AS message, min(event_id) AS event_id FROM events GROUP BY 1")
def q_failure_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select(F.concat("event_type", F.lit(" of "), F.col("user_id").cast("string")).alias("message"), "event_id")
    return coverage.first_failures(rows, "message", "event_id")


@query("SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents) - (SELECT count(*) FROM labels) AS added")
def q_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.added(read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"), "doc_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1")
def q_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each kind and user, whichever; the smallest event names it."""
    rows = read_table(spark, sf_dir, "events").withColumn("key", F.concat_ws("/", "event_type", F.col("user_id")))
    first = rows.groupBy("key").agg(F.min("event_id").alias("event_id"))
    return merge_stream.deduplicated(rows, "key", "ts").select("key", "user_id").join(first, "key").select("user_id", "event_id")


SINCE = 1_705_248_000_000  # 2024-01-15 in the feed's zone


@query(f"""
WITH x AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS rn FROM events),
p AS (SELECT *, rn // 8 + 1 AS page FROM x),
s AS (SELECT user_id, page, count(*) AS n, count(*) FILTER (WHERE e < {SINCE}) AS older FROM p GROUP BY 1, 2),
b AS (SELECT *, page % 40 = 0 AS done, coalesce(lag(older > 0) OVER (PARTITION BY user_id ORDER BY page), false) AND n = older AS confirmed FROM s),
t AS (SELECT user_id, min(page) FILTER (WHERE done OR confirmed) AS stop_page FROM b GROUP BY 1)
SELECT event_id, user_id, event_type AS clean_text, 'https://example.com/7/' || event_id AS target, stop_page, stop_page IS NULL AS truncated
FROM p JOIN t USING (user_id) WHERE (stop_page IS NULL OR page <= stop_page) AND e >= {SINCE}""")
def q_timeline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events, latest first, in pages of 8: a page ends the walk by its metadata or by the date."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())) - 1
    rows = read_table(spark, sf_dir, "events").withColumn("rn", place).withColumn("page", (F.floor(F.col("rn") / 8) + 1).cast("int"))
    item = F.struct(
        F.col("event_id").alias("id"), millis("ts").alias("created_at"), F.concat(F.lit("<p>"), "event_type", F.lit("</p>")).alias("text"),
        *(F.lit(1).alias(c) for c in ("reply_count", "like_count", "retweet_count", "view_count")), F.lit(0).alias("mark"),
    )
    bodies = rows.groupBy("user_id", "page").agg(F.array_sort(F.collect_list(F.struct("rn", item.alias("item")))).alias("all"))
    body = F.to_json(F.struct((F.col("page") % 40 != 0).alias("has_more"), F.transform("all", lambda x: x["item"]).alias("statuses")))
    scan = scans.timeline_scan(bodies.select(F.col("user_id").alias("stream"), "page", F.lit(8).alias("count"), body.alias("body")), "7", DOMAIN, SINCE)
    return scan.records.join(scan.streams, "stream").select(
        F.col("id").cast("long").alias("event_id"), F.col("stream").alias("user_id"), "clean_text", F.concat(F.lit("https://example.com/7/"), "id").alias("target"), "stop_page", "truncated"
    )


def comment_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(posts, pages): orders with their line items as comments, three to a page; one order in eleven never says that it ends."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")) - 1
    lines = read_table(spark, sf_dir, "lineitem").withColumn("rn", place).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")))
    key = F.col("l_orderkey")
    item = F.struct(
        (key * 100 + F.col("rn")).alias("id"), key.alias("status_id"), F.struct((F.col("l_suppkey") % 5).alias("id")).alias("user"), F.lit("t").alias("text"),
        F.lit(0).alias("created_at"), F.lit(1).alias("like_count"), F.lit(0).alias("reply_count"),
    )
    page = (F.floor(F.col("rn") / 3) + 1).cast("int")
    bodies = lines.groupBy(key.alias("post_id"), page.alias("page"), "n").agg(F.array_sort(F.collect_list(F.struct("rn", item.alias("item")))).alias("all"))
    sizes = read_table(spark, sf_dir, "lineitem").groupBy(key.alias("post_id")).agg(F.count(F.lit(1)).alias("n"))
    more = (F.col("page") < F.ceil(F.col("n") / 3)) | (F.col("post_id") % 11 == 0)
    body = F.to_json(F.struct(more.alias("has_more"), F.transform("all", lambda x: x["item"]).alias("comments")))
    found = bodies.select("post_id", "page", F.lit(3).alias("count"), F.lit("OK").alias("code"), body.alias("body"))
    posts = sizes.select(
        "post_id", F.col("post_id").alias("position"), (F.col("n") + F.when(F.col("post_id") % 7 == 0, 1).otherwise(0)).alias("reply_count"),
        F.lit("0").alias("created_at_raw"), F.lit("").alias("title"), F.lit("p").alias("clean_text"), F.concat(F.lit("https://example.com/3/"), F.col("post_id")).alias("target"),
    )
    return posts, found


def changed_scan(spark: SparkSession, sf_dir: str) -> scans.Scan:
    posts, found = comment_pages(spark, sf_dir)
    return scans.changed_comment_scan(posts, posts.filter("post_id % 3 = 0").select("post_id", "reply_count"), found, "3", DOMAIN, NO_LIMIT)


_COMMENTS = """
WITH l AS (SELECT l_orderkey AS post_id, l_suppkey % 5 AS author, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS rn FROM lineitem),
n AS (SELECT post_id, count(*) AS n, count(*) + CASE WHEN post_id % 7 = 0 THEN 1 ELSE 0 END AS declared, post_id % 11 = 0 AS open FROM l GROUP BY post_id)"""


@query(_COMMENTS + """
SELECT post_id, declared, n AS observed, open AS truncated, open AND n < declared AS unverified,
  CASE WHEN n < declared AND NOT open THEN declared - n END AS unavailable_count, NOT open AS confirmed FROM n WHERE post_id % 3 <> 0""")
def q_changed_comment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changed_scan(spark, sf_dir).streams
    return rows.select("post_id", "declared", "observed", "truncated", "unverified", F.col("gap.unavailable_count").alias("unavailable_count"), "confirmed")


@query(_COMMENTS + """
SELECT CAST(post_id * 100 + rn AS VARCHAR) AS id, CAST(post_id AS VARCHAR) AS post_id FROM l WHERE author = 3 AND post_id % 3 <> 0""")
def q_changed_comment_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_scan(spark, sf_dir).records.select("id", "post_id")


@query(_COMMENTS + """
SELECT post_id, CASE WHEN open OR n > 6 THEN NULL ELSE CAST(ceil(n / 3.0) AS INTEGER) END AS stop_page, least(n, 6) AS observed,
  declared > 6 OR open OR n > 6 OR n < declared AS request_failed FROM n""")
def q_post_reply_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, found = comment_pages(spark, sf_dir)
    return scans.post_reply_scan(posts, found, "3", DOMAIN, 2, 3).streams.select("post_id", "stop_page", "observed", "request_failed")


@query("SELECT CAST(event_id AS VARCHAR) AS id, 1 AS endpoint, false AS advances FROM events WHERE user_id = 7")
def q_user_comment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as one stream of comments, which the first of two endpoints does not have."""
    rows = read_table(spark, sf_dir, "events")
    item = F.struct(
        F.col("event_id").alias("id"), (F.col("event_id") % 9).alias("status_id"), F.col("user_id"), F.lit("t").alias("text"), F.lit(0).alias("created_at"),
        F.lit(1).alias("like_count"), F.lit(0).alias("reply_count"),
    )
    page = (F.floor(F.col("event_id") / 100) + 1).cast("int")
    bodies = rows.groupBy(page.alias("page")).agg(F.collect_list(item).alias("comments"))
    body = F.to_json(F.struct(F.lit(True).alias("has_more"), "comments"))
    found = bodies.select(F.lit(1).alias("endpoint"), "page", F.lit(100).alias("count"), F.lit("OK").alias("code"), body.alias("body"))
    gone = spark.createDataFrame([(0, 1, 100, "HTTP_404", "")], "endpoint int, page int, count int, code string, body string")
    posts = spark.range(9).select(F.col("id").cast("string").alias("post_id"), F.lit("0").alias("created_at_raw"), F.lit("").alias("title"), F.lit("p").alias("clean_text"), F.lit("").alias("target"))
    scan = scans.user_comment_scan(found.unionByName(gone), posts, "7", DOMAIN)
    return scan.records.select("id").crossJoin(F.broadcast(scan.streams.select("endpoint", "advances")))  # one row


@query("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'api' WHEN 1 THEN 'page' WHEN 2 THEN 'api' END AS origin,
  CASE page_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'e' END AS clean_text, page_id % 4 <= 1 AS valid FROM pages""")
def q_single_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The API's answer, else what the page embeds; an answer that is no post is not asked for again."""
    i = F.col("page_id")
    post = lambda text: F.concat(F.lit('{"id":'), i.cast("string"), F.lit(f',"created_at":0,"text":"{text}","reply_count":1,"like_count":1,"retweet_count":1,"view_count":1}}'))
    rows = read_table(spark, sf_dir, "pages").select(
        "page_id", F.when(i % 2 == 0, "OK").otherwise("HTTP_500").alias("api_code"), F.when(i % 4 == 0, post("a")).when(i % 4 == 2, "[]").alias("api_body"),
        F.concat("html", F.when(i % 4 != 3, F.concat(F.lit("<script>window.STATUS = "), post("e"), F.lit(";\n</script>"))).otherwise("")).alias("html"),
    )
    found = scans.single_records(rows, "7", DOMAIN, r"window\.STATUS")
    return found.select("page_id", "origin", "clean_text", (F.size("violations") == 0).alias("valid"))


def recovery_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(posts, pages, nested pages): of an order's line items the first three are comments, the others replies to them.

    Some orders never say that they end, some threads neither, some declare one comment more, some refuse a thread.
    """
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    key, rn = F.col("post_id"), F.col("rn")
    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("post_id"), "l_suppkey", F.lead("l_suppkey").over(order).alias("next"), (F.row_number().over(order) - 1).alias("rn"), n.alias("n")
    )
    rows = materialise(rows)  # each order's line items are put in order once
    sizes = rows.filter(rn == 0).select("post_id", "n")

    def item(at: Column, supplier: str) -> Column:
        return F.struct(
            (key * 100 + at).alias("id"), key.alias("status_id"), F.struct((F.col(supplier) % 5).alias("id")).alias("user"), F.lit("t").alias("text"),
            F.lit(0).alias("created_at"), F.lit(1).alias("like_count"), F.floor((F.col("n") - 1 - at) / 3).alias("reply_count"),
        )

    m = F.least("n", F.lit(3))
    body = lambda more, items: F.to_json(F.struct(more.alias("has_more"), items.alias("comments")))
    # Two comments to a page: a page's first line item knows the next one, so that no page is gathered.
    two = F.when((rn == 0) & (F.col("n") > 1), F.array(item(rn, "l_suppkey"), item(rn + 1, "next"))).otherwise(F.array(item(rn, "l_suppkey")))
    top = rows.filter((rn == 0) | (rn == 2)).withColumn("page", (F.floor(rn / 2) + 1).cast("int"))
    more = (F.col("page") < F.ceil(m / 2)) | (key % 11 == 0)
    pages_of = top.select("post_id", "page", F.lit(2).alias("count"), F.lit("OK").alias("code"), body(more, two).alias("body"))
    root = (key * 100 + rn % 3).cast("string").alias("comment_id")
    more = (rn + 3 < F.col("n")) | (key % 13 == 0)
    refused = F.when((rn == 4) & (key % 17 == 0), "HTTP_500").otherwise("OK")
    nested = rows.filter(rn >= 3).select("post_id", root, F.floor(rn / 3).cast("int").alias("page"), F.lit(1).alias("count"), refused.alias("code"), body(more, F.array(item(rn, "l_suppkey"))).alias("body"))
    declared = m + F.when(key % 7 == 0, 1).otherwise(0)
    bad = (key % 11 == 0) | (key % 7 == 0) | ((key % 13 == 0) & (F.col("n") >= 4)) | ((key % 17 == 0) & (F.col("n") >= 5))
    posts = sizes.select(
        "post_id", (key + F.when(bad, 1 << 40).otherwise(0)).alias("position"), declared.alias("reply_count"), F.lit("0").alias("created_at_raw"), F.lit("").alias("title"),
        F.lit("p").alias("clean_text"), F.concat(F.lit("https://example.com/3/"), key).alias("target"),
    )
    return posts, pages_of, nested


_RECOVERY = """
WITH l AS (SELECT l_orderkey AS k, l_suppkey % 5 AS author, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS rn FROM lineitem),
n AS (SELECT k, count(*) AS n FROM l GROUP BY k),
w AS (SELECT k, n, least(n, 3) AS m, k % 17 = 0 AND n >= 5 AS failed, k % 13 = 0 AND n >= 4 AS threads, k % 11 = 0 OR k % 7 = 0 AS short FROM n),
bad AS (SELECT * FROM w WHERE failed OR threads OR short)"""


@query(_RECOVERY + """
SELECT k AS post_id, CASE WHEN k % 11 <> 0 THEN CAST(ceil(m / 2.0) AS INTEGER) END AS stop_page, m AS observed,
  CASE WHEN failed THEN 'nested:' || (k * 100 + 1) || ':HTTP_500' END AS failed,
  CASE WHEN failed THEN '' ELSE concat_ws(',', CASE WHEN threads THEN 'nested:' || (k * 100) END, CASE WHEN threads AND n >= 5 THEN 'nested:' || (k * 100 + 1) END,
    CASE WHEN threads AND n >= 6 THEN 'nested:' || (k * 100 + 2) END, CASE WHEN short THEN 'post:' || k END) END AS truncated FROM w""")
def q_recovery_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the strict walk of every order ends, with the walks of its threads."""
    walks = resume_scan.walk_posts(*recovery_pages(spark, sf_dir), "3", DOMAIN, nested_limit=NO_LIMIT)
    return walks.posts.select("post_id", "stop_page", "observed", "failed", F.array_join("truncated_streams", ",").alias("truncated"))


@query(_RECOVERY + """,
e AS (SELECT k, failed FROM bad ORDER BY k LIMIT 1)
SELECT CAST(l.k * 100 + rn AS VARCHAR) AS id, CAST(l.k AS VARCHAR) AS post_id, CASE WHEN rn >= 3 THEN CAST(l.k * 100 + rn % 3 AS VARCHAR) END AS root,
  (SELECT CAST(k AS VARCHAR) FROM e) AS last_failed_post_id
FROM l WHERE author = 3 AND (l.k NOT IN (SELECT k FROM bad) OR l.k IN (SELECT k FROM e WHERE NOT failed))""")
def q_recovery_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over all orders, those that cannot be proven last: it ends at the first of them."""
    stored = spark.createDataFrame([], "id string, post_id string")
    run = resume_scan.recovery_scan(*recovery_pages(spark, sf_dir), stored, "3", DOMAIN, nested_limit=NO_LIMIT)
    state = F.broadcast(run.state.select("last_failed_post_id"))  # one row
    return run.replies.select("id", "post_id", F.col("in_reply_to_comment_id").alias("root")).crossJoin(state)


@query(_RECOVERY + """
SELECT k AS post_id, CAST(k * 100 + rn % 3 AS VARCHAR) AS comment_id, count(*) FILTER (WHERE NOT (k % 17 = 0 AND rn = 4)) AS observed,
  k % 13 = 0 OR bool_or(k % 17 = 0 AND rn = 4) AS truncated FROM l WHERE rn >= 3 GROUP BY k, rn % 3""")
def q_nested_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thread of every order, walked by itself."""
    nested = materialise(recovery_pages(spark, sf_dir)[2])  # landed once
    roots = nested.groupBy("post_id", "comment_id").agg(F.count(F.lit(1)).alias("declared"))
    return resume_scan.nested_reply_scan(roots, nested, NO_LIMIT).streams.select("post_id", "comment_id", "observed", "truncated")


@query("""
WITH l AS (SELECT l_orderkey AS k, bool_or(l_quantity < 3) AS low, count(DISTINCT l_suppkey) < count(*) AS twice, count(DISTINCT l_partkey) < count(*) AS again,
  bool_or(l_quantity < l_linenumber OR l_partkey % 10 = 0 OR l_quantity = l_linenumber) AS broken FROM lineitem GROUP BY l_orderkey)
SELECT k AS o_orderkey, concat_ws(',', CASE WHEN low THEN 'post_reply_counts' END, CASE WHEN twice THEN 'scanned_post_ids' END,
  CASE WHEN broken OR again THEN 'comment_visibility_gaps' END, CASE WHEN k % 5 = 0 THEN 'user_id' END, CASE WHEN k % 7 = 0 THEN 'comment_method' END) AS violations,
  NOT low AND NOT twice AND NOT broken AND NOT again AND k % 5 = 1 AND k % 7 <> 0 AS starts_anew FROM l""")
def q_checkpoint_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state for each order, its counts, ids and gaps from the order's line items, all validated in one pass."""
    k, text = F.col("l_orderkey"), lambda c: F.col(c).cast("string")
    declared, visible = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    hidden = declared - visible + F.when(F.col("l_partkey") % 10 == 0, 1).otherwise(0)
    gap = F.struct(text("l_partkey").alias("post_id"), declared.alias("declared_count"), visible.alias("visible_count"), hidden.alias("unavailable_count"), F.lit("timeline").alias("count_source"))
    entry = F.concat(F.lit('"'), text("l_linenumber"), text("l_partkey"), text("l_suppkey"), declared.cast("string"), F.lit('":'), (declared - 3).cast("string"))
    rows = read_table(spark, sf_dir, "lineitem").groupBy(k).agg(
        F.array_join(F.array_distinct(F.collect_list(entry)), ",").alias("counts"), F.to_json(F.collect_list(text("l_suppkey"))).alias("ids"), F.to_json(F.collect_list(gap)).alias("gaps")
    )
    user = F.when(k % 5 == 0, '"user_id":"8",').when(k % 5 == 1, "").otherwise('"user_id":"7",')
    method = F.when(k % 7 == 0, '""').otherwise('"x"')
    state = F.concat(
        F.lit('{"schema_version":1,'), user, F.lit('"post_reply_counts":{'), "counts", F.lit('},"scanned_post_ids":'), "ids", F.lit(',"confirmed_post_ids":[],"latest_post_id":null,"comment_visibility_gaps":'),
        "gaps", F.lit(',"comment_method":'), method, F.lit(',"comment_coverage":"x","nested_reply_coverage":"x"}'),
    )
    judged = states.judged_states(rows.select(k.alias("o_orderkey"), state.alias("state"), F.lit("7").alias("user_id")))
    return judged.select("o_orderkey", F.array_join("violations", ",").alias("violations"), "starts_anew")


@query("""
WITH o AS (SELECT user_id, event_type AS post_id, epoch_us(ts) // 1000 AS time_ms, event_id AS seq, CAST(floor(value) AS BIGINT) % 2 AS reply_count FROM events),
l AS (SELECT *, lag(time_ms) OVER w AS t, lag(reply_count) OVER w AS c FROM o WINDOW w AS (PARTITION BY user_id, post_id ORDER BY time_ms, seq))
SELECT user_id, post_id, time_ms, seq, CASE WHEN time_ms - t <= 21600000 THEN c END AS previous_count, reply_count
FROM l WHERE t IS NULL OR time_ms - t > 21600000 OR c <> reply_count""")
def q_stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of a post of each kind and user, through keyed state with a lookback of six hours."""
    import uuid

    from quillfeed.session import ensure_checkpoint_dir, remember

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/changes-{uuid.uuid4().hex}"
    remember(spark, base)
    schema = read_table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    seen = checkpoints.observations(stream, F.col("user_id"), F.col("event_type"), F.col("ts"), F.col("event_id"), F.floor("value") % 2)
    with checkpoints.state_store(spark):
        changed = checkpoints.changes_on_stream(seen, 6 * 3_600_000)
        changed.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(changed.schema).parquet(f"{base}/out")


@query("""
WITH o AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS t FROM events WHERE event_type <> 'purchase'),
c AS (SELECT user_id, epoch_us(ts) // 1000 AS t, max(event_id) AS checkpoint FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT o.event_id, c.checkpoint, c.t AS checkpoint_time FROM o ASOF LEFT JOIN c ON o.user_id = c.user_id AND o.t >= c.t""")
def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the user's last purchase at or before it, in ranges of six hours."""
    rows = read_table(spark, sf_dir, "events").select("event_id", "user_id", millis("ts").alias("t"), "event_type")
    marks = rows.filter("event_type = 'purchase'").select("user_id", "t", F.col("event_id").alias("checkpoint"))
    seen = rows.filter("event_type <> 'purchase'").select("event_id", "user_id", "t")
    return timeline_joins.as_of(seen, marks, "user_id", "t", "checkpoint", 6 * 3_600_000).select("event_id", "checkpoint", "checkpoint_time")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 3 HOUR AS session_end, count(*) AS n_events FROM n GROUP BY user_id, s""")
def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events in sessions with pauses under three hours."""
    return timeline_joins.sessions(read_table(spark, sf_dir, "events"), "user_id", "ts", "3 hours")


@query("""
SELECT event_type, day, CAST(GROUPING(event_type, day) AS BIGINT) AS level, count(*) AS n_rows, count(DISTINCT user_id) AS n_distinct,
  count(*) FILTER (WHERE value < 50) AS n_low FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY GROUPING SETS ((event_type, day), (event_type), (day), ())""")
def q_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by kind and day, each alone, and in all, in one pass."""
    rows = read_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return timeline_joins.levels(rows, [["event_type", "day"], ["event_type"], ["day"], []], "user_id", n_low=F.count_if(F.col("value") < 50))


@query("""
SELECT source AS segment, count(*) AS n_rows, true AS within FROM documents GROUP BY source""")
def q_key_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch of each source's ids, and whether its estimate keeps to four standard errors (and one) of the exact count."""
    docs = read_table(spark, sf_dir, "documents")
    rough = timeline_joins.key_sketches(docs, F.col("source"), "doc_id")
    exact = docs.groupBy(F.col("source").alias("segment")).agg(F.count_distinct("doc_id").alias("exact"))
    off = F.abs(F.hll_sketch_estimate("keys") - F.col("exact"))
    return rough.join(exact, "segment").select("segment", "n_rows", (off <= 1 + 4 * timeline_joins.SKETCH_ERROR * F.col("exact")).alias("within"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as a file: its host, first path segment and number, with the digest of its HTML."""
    host, first = F.regexp_extract("url", "://([^/?#]*)", 1), F.regexp_extract("url", "://[^/?#]*/([^/?#]*)", 1)
    return read_table(spark, sf_dir, "pages").select("page_id", F.concat_ws("/", host, first, F.col("page_id").cast("string")).alias("path"), F.sha2("html", 256).alias("content"))


@query("""
WITH f AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) AS first, page_id, sha256(html) AS content FROM pages),
l AS (SELECT host, first, host || '/' || first || '/' || page_id AS path, sha256(host || '/' || first || '/' || page_id || chr(0) || content) AS h FROM f),
n AS (SELECT 0 AS depth, '' AS node, h FROM l UNION ALL SELECT 1, host, h FROM l UNION ALL SELECT 2, host || '/' || first, h FROM l UNION ALL SELECT 3, path, h FROM l)
SELECT depth, node, count(*) AS n_files, sha256(concat_ws(':', count(*), sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)),
  sum(CAST('0x' || substr(h, 31, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 46, 15) AS HUGEINT)))) AS digest FROM n GROUP BY depth, node""")
def q_snapshot_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash tree of all pages as files."""
    return snapshots.tree(page_lines(spark, sf_dir)).select("depth", "node", "n_files", "digest")


@query("""
WITH f AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) || '/' || regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) || '/' || page_id AS path FROM pages)
SELECT path, CASE page_id % 40 WHEN 0 THEN 'removed' WHEN 1 THEN 'added' ELSE 'changed' END AS change FROM f WHERE page_id % 40 <= 2""")
def q_snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two snapshots of the pages: some are in one only, some have other bytes."""
    pages_of, i = page_lines(spark, sf_dir), F.col("page_id") % 40
    old = pages_of.filter(i != 1)
    new = pages_of.filter(i != 0).withColumn("content", F.when(i == 2, F.concat("content", F.lit("x"))).otherwise(F.col("content")))
    return snapshots.difference(materialise(snapshots.tree(old)), materialise(snapshots.tree(new)))


@query("""
SELECT CAST(page_id AS VARCHAR) AS post_id, CASE page_id % 4 WHEN 0 THEN 'api' WHEN 1 THEN 'page' WHEN 2 THEN 'api' END AS origin, page_id % 4 >= 2 AS failed
FROM pages WHERE page_id % 5 <> 0""")
def q_ids_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages asked for by number and by link, both at once; every fifth is stored already."""
    i = F.col("page_id").cast("string")
    post = lambda text: F.concat(F.lit('{"id":'), i, F.lit(f',"created_at":0,"text":"{text}","reply_count":1,"like_count":1,"retweet_count":1,"view_count":1}}'))
    rows, k = read_table(spark, sf_dir, "pages"), F.col("page_id") % 4
    answers = rows.select(
        i.alias("post_id"), F.when(k % 2 == 0, "OK").otherwise("HTTP_500").alias("api_code"), F.when(k == 0, post("a")).when(k == 2, "[]").alias("api_body"),
        F.concat("html", F.when(k != 3, F.concat(F.lit("<script>window.STATUS = "), post("e"), F.lit(";\n</script>"))).otherwise("")).alias("html"),
    )
    refs = rows.select(i.alias("ref")).unionByName(rows.select(F.concat(F.lit(f"https://{DOMAIN}/7/"), i).alias("ref")))
    scan = scans.ids_scan(refs, rows.filter("page_id % 5 = 0").select(F.col("page_id").alias("id")), answers, "7", DOMAIN, r"window\.STATUS")
    return scan.streams.select("post_id", "origin", "failed")


@query("""
SELECT event_id, sha256('[{"key":"kind","value":"' || event_type || '"},{"key":"number","value":"' || event_id || '"},{"key":"user","value":"' || user_id || '"}]') AS digest FROM events""")
def q_semantic_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object's digest does not depend on the order of its fields, nor on what is left out."""
    rows = read_table(spark, sf_dir, "events")
    field = {"number": F.col("event_id"), "user": F.col("user_id"), "kind": F.concat(F.lit('"'), "event_type", F.lit('"')), "run": F.col("event_id") * 7}
    orders = [["number", "user", "kind", "run"], ["run", "kind", "number", "user"], ["user", "run", "number", "kind"]]
    body = F.lit(None).cast("string")
    for k, names in enumerate(orders):
        text = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{n}":'), field[n].cast("string")) for n in names)), F.lit("}"))
        body = F.when(F.col("event_id") % 3 == k, text).otherwise(body)
    return rows.select("event_id", manifest.semantic_digest(body, "run").alias("digest"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder, which goes with the process."""
    import uuid

    from quillfeed.session import ensure_checkpoint_dir, remember

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    remember(spark, base)
    return base


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE text END AS text, lang FROM documents")
def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a JSON corpus, written and read again strictly; nulls stay, ids are unique."""
    path = _scratch(spark, "json")
    rows = read_table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("text"), "lang")
    sinks.write_json(rows, path)
    return landed.read_json_strict(spark, path, "doc_id long, text string, lang string", unique="doc_id")


@query("""
SELECT 'orders' AS stream, o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'customers', c_custkey FROM customer""")
def q_promotion_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams promoted together, then one again while the other fails, which must leave both as they were; then one alone."""
    base, none = _scratch(spark, "store"), spark.createDataFrame([], "code string")
    orders, customers = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    sinks.promote(spark, base, {"orders": orders, "customers": customers}, none)
    refused = sinks.promote(spark, base, {"orders": orders.limit(1), "customers": customers}, spark.createDataFrame([("WAF",)], "code string"))
    if not all(refused.values()):
        raise AssertionError("a promotion with failures went through")
    sinks.promote(spark, base, {"orders": orders.filter("id % 2 = 0")}, none, all_or_nothing=False)
    parts = [versions.read(spark, base, name).select(F.lit(name).alias("stream"), "id") for name in ("orders", "customers")]
    return parts[0].unionByName(parts[1])
