"""Whole scans over landed pages, composed of the operators for pages, records, merges and coverage.

A scan reads pages as they were landed, decides for each where its walk ends, and takes what came up to there. Pages
have a stream (or post), page, count, code (of the response) and body. Every step is grouped by stream and page, so a
long stream spreads over all tasks. Items are parsed once and written to the checkpoint folder for the steps that
read them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.functions.binding import named
from quillfeed.functions.ids import canonical_url, count_from_literal, loose_id, post_reference
from quillfeed.functions.payload import AUTHOR, Payload, author_id, embedded_json, parsed_rows, value_rows
from quillfeed.functions.text import clean_html
from quillfeed.functions.times import epoch_ms_from_literal, format_epoch_ms, is_unknown_literal
from quillfeed.operators import pages as paging
from quillfeed.operators.contracts import acquisition_markers_ok
from quillfeed.operators.coverage import coverage
from quillfeed.operators.merge import RECORD_RULES, last_wins, merge_versions
from quillfeed.operators.normalize import COUNTS, bare, by_author, normalize_posts, normalize_replies, string
from quillfeed.operators.select import changed_posts, skip_existing
from quillfeed.session import materialise

#: Codes of responses after which another endpoint is asked, and after which a scan of posts ends.
ENDPOINT_MISSING = ("HTTP_404", "API_10020")
SCAN_ENDS = ("WAF", "CDP_TIMEOUT", "FETCH_FAILED")
OK = "OK"


@dataclass(frozen=True)
class Scan:
    """Records, one row for each stream or post with how its walk ended, and the codes of what was wrong."""

    records: DataFrame
    streams: DataFrame
    problems: DataFrame


def items_of(pages: DataFrame, aliases: tuple[str, ...], stream: str) -> DataFrame:
    """One row for each item: stream, page, count, pos and item; pages without items give none."""
    rows, item = paging.item_values(pages.select(stream, "page", "count", "body"), aliases)
    return rows.filter(item.isNotNull() & ~F.is_variant_null(item)).select(stream, "page", "count", "pos", F.to_json(item).alias("item"))


def judged(pages: DataFrame, counted: DataFrame, stream: str, strict: bool = False) -> DataFrame:
    """stream, page, complete, explicit, violation and observed (distinct ids so far) of each page, from its metadata and the items that count (with id)."""
    by = [stream, "page"]
    # An id counts on its first page. One grouped sum gives each page its items and its new ids; bodies are not shuffled.
    first = counted.filter("id is not null").groupBy(stream, "id").agg(F.min("page").alias("page"))
    marks = counted.select(*by, F.lit(1).alias("__n"), F.lit(0).alias("__new")).unionByName(first.select(*by, F.lit(0).alias("__n"), F.lit(1).alias("__new")))
    sizes = marks.groupBy(*by).agg(F.sum("__n").alias("__n"), F.sum("__new").alias("__new"))
    rows, facts = paging.page_facts(pages.select(*by, "count", "body"), "body", strict)
    rows = rows.join(sizes, by, "left")
    order = Window.partitionBy(stream).orderBy("page")  # pages alone; those landed twice are peers, and the first of them brings its new ids
    again = F.coalesce(F.lag("page").over(order) == F.col("page"), F.lit(False))
    rows = rows.withColumn("__new", F.when(again, 0).otherwise(F.coalesce("__new", F.lit(0))))
    rows = rows.withColumn("observed", F.sum("__new").over(order))
    rows = paging.decided(rows, facts, F.col("page"), F.col("count"), F.coalesce("__n", F.lit(0)), F.col("observed"), strict)
    return rows.select(*by, "complete", "explicit", "violation", "observed")


def walk_ends(asked: DataFrame, decided: DataFrame, stream: str) -> DataFrame:
    """(stream, stop_page, truncated, observed): where each walk ends, and the distinct ids that it saw.

    `asked` has a row for each stream at least, `decided` is of `judged`. What a walk saw is what its last page counts.
    """
    rows = asked.select(stream).withColumns({"page": F.lit(None).cast("int"), "complete": F.lit(None).cast("boolean"), "observed": F.lit(0).cast("long")})
    rows = rows.unionByName(decided.select(stream, "page", "complete", "observed"))
    at = F.when(F.col("complete"), F.col("page"))
    ends = rows.groupBy(stream).agg(F.min(at).alias("stop_page"), F.min_by("observed", at).alias("__stop"), F.max("observed").alias("__all"))
    truncated = F.col("stop_page").isNull()
    return ends.select(stream, "stop_page", truncated.alias("truncated"), F.when(truncated, F.col("__all")).otherwise(F.col("__stop")).alias("observed"))


def _sequence() -> Column:
    return (F.col("page").cast("long") * F.lit(1 << 32) + F.col("pos")).alias("seq")


def timeline_scan(pages: DataFrame, user_id: str, domain: str, since_ms: int | None = None, stream: str = "stream") -> Scan:
    """A timeline: items to posts, pinned rows apart, until a page is the last one or the date is passed for certain.

    Records are merged within their stream; those before the date go, those without a time stay. A stream whose walk
    meets no end is truncated.
    """
    by = [stream, "page"]
    pages = materialise(pages.select(*by, "count", "body"))
    posts = normalize_posts(items_of(pages, paging.TIMELINE_ITEMS, stream), user_id, domain, mark=lambda p: count_from_literal(p.literal("mark")))
    posts = materialise(paging.pinned_rows(posts, [stream], "page", "count"))  # parsed once, read by each step
    pageable = posts.filter("pageable")
    decided = judged(pages, pageable, stream)
    ends = F.coalesce("complete", F.lit(False))
    if since_ms is not None:
        boundary = paging.since_boundary(pageable, stream, "page", "pos", "epoch_ms", since_ms, pages)
        decided = decided.join(boundary.select(*by, "confirmed"), by)
        ends = ends | F.col("confirmed")
    decided = materialise(decided.withColumn("__ends", ends))  # a row for each page
    stops = paging.stop_pages(decided, stream, "page", F.col("__ends"))
    walked = paging.walked(posts, stops, stream, "page")
    versions = walked.withColumn("__key", F.struct(stream, "id")).withColumn("seq", _sequence())
    merged = merge_versions(versions, "__key", "seq", RECORD_RULES).select("__key.*", "*").drop("__key")
    merged = merged.withColumn("epoch_ms", epoch_ms_from_literal(F.col("created_at_raw")))
    records = merged if since_ms is None else paging.since_filter(merged, "epoch_ms", since_ms)
    wrong = paging.walked(decided, stops, stream, "page").select(*by, F.col("violation").alias("code"))
    wrong = wrong.unionByName(walked.select(*by, F.explode("violations").alias("code")))
    wrong = wrong.unionByName(walked.select(*by, F.col("violation").alias("code")))
    return Scan(records, stops, wrong.filter("code is not null").distinct())


def _comments(pages: DataFrame, stream: str, fields: Iterable[str] = (), **more: Column | Callable[[Payload], Column]) -> DataFrame:
    """Items of comment pages with their id and author, and what more is asked of the parsed item, most of it of `fields`."""
    items = items_of(pages, paging.COMMENT_ITEMS, stream)
    rows, p = parsed_rows(items, "item", fields=("id", *AUTHOR, *fields))
    asked = {n: c if isinstance(c, Column) else c(p) for n, c in more.items()}
    return rows.select(*items.columns, loose_id(bare(p.literal("id"))).alias("id"), author_id(p).alias("author"), *(c.alias(n) for n, c in asked.items()))


def comment_rows(pages: DataFrame, stream: str, fields: Iterable[str] = (), user_id: str | None = None, **more: Column | Callable[[Payload], Column]) -> DataFrame:
    """A row for each item of comment pages, and one for a page without items: both of one strict parse of each page.

    `first` marks one row of each page, which has its facts and `n_items`; `counts` rows with an item. Items have pos,
    id, author, `more` of the parsed item (most of it of its `fields`) and the text `item` - with `user_id`, the texts
    of this author's items alone. Bodies of refused pages are not read.
    """
    by = [stream, "page"]
    asked = pages.select(*by, "count", "code", F.when(F.col("code") == OK, F.col("body")).alias("body"))
    rows, item, facts = paging.pages_and_items(asked, paging.COMMENT_ITEMS, "body", strict=True)
    first, counts = F.coalesce(F.col("pos") == 0, F.lit(True)), F.coalesce(item.isNotNull() & ~F.is_variant_null(item), F.lit(False))
    rows = rows.select(*by, "count", "code", "pos", item, first.alias("first"), counts.alias("counts"), *(F.when(first, F.col(c)).alias(c) for c in ("n_items", *(f"__fact_{k}" for k in facts))))
    kept = [c for c in rows.columns if c != "__item"]
    rows, p = value_rows(rows.filter("first or counts"), "__item", ("id", *AUTHOR, *fields))
    rows, (author,) = named(rows, author_id(p))
    text = F.to_json(item) if user_id is None else F.when(author == user_id, F.to_json(item))
    return rows.select(*kept, loose_id(bare(p.literal("id"))).alias("id"), author.alias("author"), text.alias("item"), *((c if isinstance(c, Column) else c(p)).alias(n) for n, c in more.items()))


def judged_rows(rows: DataFrame, stream: str) -> DataFrame:
    """stream, page, code, place, complete, violation and observed (distinct ids so far) of each page of `comment_rows`.

    Pages are numbered by `place`. What is told of a refused page is null.
    """
    by = [stream, "page"]
    # An id counts on its first page. New ids are summed by pages before they meet the window, which sees pages alone.
    first = rows.filter("counts and id is not null").groupBy(stream, "id").agg(F.min("page").alias("page"))
    fresh = first.groupBy(*by).agg(F.count(F.lit(1)).alias("__new"))
    facts = [c for c in rows.columns if c.startswith("__fact_")]
    pages = rows.filter("first").select(*by, "count", "code", "n_items", *facts, F.lit(1).alias("__page")).unionByName(fresh, allowMissingColumns=True)
    order = Window.partitionBy(stream).orderBy("page")
    pages = pages.select(
        "*",
        F.sum("__page").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("place"),
        F.sum(F.coalesce("__new", F.lit(0))).over(order).alias("observed"),
        F.sum("n_items").over(order.rangeBetween(Window.currentRow, Window.currentRow)).alias("__n"),  # of a page that was landed twice, both
    ).filter("__page = 1")
    pages = paging.decided(pages, {c.removeprefix("__fact_"): F.col(c) for c in facts}, F.col("page"), F.col("count"), F.col("__n"), F.col("observed"), strict=True)
    good = F.col("code") == OK
    return pages.select(*by, "code", "place", *(F.when(good, F.col(c)).alias(c) for c in ("complete", "violation")), "observed")


def changed_comment_scan(
    posts: DataFrame, baselines: DataFrame, pages: DataFrame, user_id: str, domain: str, limit: int, ends: tuple[str, ...] = SCAN_ENDS
) -> Scan:
    """Comments of the posts that have changed, in the order of their position.

    A page of a code in `ends` that a post's walk meets ends the scan: that post and all later ones are not scanned.
    Streams has a row for each scanned post with its coverage and whether it is confirmed; `posts` needs post_id,
    position, reply_count, created_at_raw, title, clean_text and target.
    """
    key = "post_id"
    changed = materialise(changed_posts(posts, baselines, "position", "reply_count", limit).select(key, "position"))
    asked = materialise(pages.join(changed, key))  # read by each step
    good = asked.filter(F.col("code") == OK)
    comments = materialise(_comments(good, key))
    decided = materialise(judged(good, comments, key))
    stops = paging.stop_pages(decided, key, "page", F.coalesce("complete", F.lit(False)))
    met = asked.filter(F.col("code").isin(*ends)).join(stops, key, "left").filter(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page")))
    end = met.agg(F.min("position").alias("__end"))  # one row
    scanned = changed.crossJoin(F.broadcast(end)).filter(F.col("__end").isNull() | (F.col("position") < F.col("__end"))).select(key, "position")
    walked = paging.walked(decided.join(scanned, key), stops, key, "page")
    told, p = parsed_rows(good, "body")
    count = F.when(p.has("count"), count_from_literal(p.literal("count")))
    seen = walked.join(told.select(key, "page", count.alias("endpoint_count")), [key, "page"])
    seen = seen.join(comments.select(key, "page", F.col("id").alias("comment_id")), [key, "page"], "left")
    covered = coverage(seen, posts).withColumn("confirmed", ~F.col("truncated") & ~F.col("unverified"))
    own = comments.filter(F.col("author") == user_id).join(walked.select(key, "page"), [key, "page"], "left_semi")
    replies = normalize_replies(own.drop("id", key), posts, user_id, domain, "post_comments")
    merged = merge_versions(replies.withColumn("seq", _sequence()), "id", "seq", RECORD_RULES)
    wrong = walked.select(key, "page", F.col("violation").alias("code")).filter("code is not null")
    wrong = wrong.unionByName(replies.select(F.col(key), "page", F.explode("violations").alias("code")))
    return Scan(merged, covered, wrong.distinct())


def self_replies(items: DataFrame, user_id: str, domain: str, post: str = "post_id", target: str = "post_target", item: str = "item") -> DataFrame:
    """Comments that the user wrote as replies; a comment that names no post belongs to the post it was found under.

    All columns of `items` but those of the same names, the reply's fields, and `violations`.
    """
    rows, p = parsed_rows(by_author(items, user_id, item), item)
    post_id = F.coalesce(loose_id(bare(p.first_present("status_id"))), F.when(p.first_present("status_id").isNull(), F.col(post).cast("string")))
    rows, (literal, post_id, text, made, likes, replies) = named(
        rows, p.literal("id"), post_id, string(p.first_present("text", "description")), p.literal("created_at"), *(p.first_present(*names) for names in (COUNTS[1], COUNTS[0]))
    )
    link = canonical_url(F.coalesce(F.col(target), F.lit("")), domain, F.lit(user_id), post_id)
    rows, (identity, link, epoch, likes, replies) = named(
        rows, loose_id(bare(literal)), link, epoch_ms_from_literal(made), count_from_literal(likes), count_from_literal(replies)
    )
    fields = {
        "id": identity, "post_id": post_id, "text": text, "clean_text": clean_html(text),
        "post_target": link,
        "created_at_raw": made, "created_at": format_epoch_ms(epoch), "reply_to": loose_id(bare(p.first_present("reply_to_id"))),
        "like_count": likes, "reply_count": replies, "source": F.coalesce(p.text("source"), F.lit("")),
    }
    broken = {name: fields[name].isNull() for name in ("id", "post_id", "text", "post_target", "like_count", "reply_count")}
    broken["created_at"] = made.isNull() | (epoch.isNull() & ~is_unknown_literal(made))
    broken["source"] = p.has("source") & (p.kind("source") != "string")
    broken["markers"] = ~acquisition_markers_ok(p)
    codes = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in broken.items())))
    others = [c for c in items.columns if c not in fields]
    return rows.select(*others, *(c.alias(n) for n, c in fields.items()), codes.alias("violations"))


def post_reply_scan(posts: DataFrame, pages: DataFrame, user_id: str, domain: str, reply_pages: int, count: int) -> Scan:
    """The user's replies under given posts, and for each post whether its scan has failed.

    A post fails if it declares more comments than the pages hold, a page is missing or refused before the end, the
    end does not come, or fewer comments were seen than declared. Of a reply that comes again the last one stays.
    `posts` needs post_id, position, reply_count and target.
    """
    key = "post_id"
    place = F.row_number().over(Window.partitionBy(key).orderBy("page"))  # reply_pages rows of a post at most
    asked = materialise(pages.filter(F.col("page") <= reply_pages).join(posts.select(key, "position"), key))  # read by each step
    broken = asked.withColumn("__at", place).groupBy(key).agg(F.min(F.when((F.col("code") != OK) | (F.col("page") != F.col("__at")), F.col("page"))).alias("__broken"))
    good = asked.join(broken, key).filter(F.col("__broken").isNull() | (F.col("page") < F.col("__broken"))).drop("__broken")
    comments = materialise(_comments(good, key))
    decided = materialise(judged(good, comments, key))
    stops = walk_ends(decided, decided, key)
    walked = paging.walked(comments, stops.drop("observed"), key, "page")
    declared = F.coalesce(F.col("reply_count"), F.lit(0))
    ends = posts.join(stops, key, "left").withColumn("observed", F.coalesce("observed", F.lit(0).cast("long")))
    failed = (declared > reply_pages * count) | F.col("stop_page").isNull() | (F.col("observed") < declared)
    streams = ends.select(key, "stop_page", "observed", failed.alias("request_failed"))
    found = walked.filter(F.col("author") == user_id).drop("id", "author").join(posts.select(key, "position", F.col("target").alias("post_target")), key)
    replies = self_replies(found, user_id, domain)
    order = F.struct("position", "page", "pos")
    records = last_wins(replies.drop("item", "count").withColumn("__order", order), "id", "__order").drop("__order", "position", "page", "pos")
    wrong = paging.walked(decided.filter("violation is not null"), stops.drop("observed"), key, "page").select(key, "page", F.col("violation").alias("code"))
    return Scan(records, streams, wrong.unionByName(replies.select(key, "page", F.explode("violations").alias("code"))).distinct())


def user_comment_scan(pages: DataFrame, posts: DataFrame, user_id: str, domain: str, endpoint: str = "endpoint") -> Scan:
    """The user's own comment stream, from the first endpoint (by rank) that there is. A diagnostic: it never advances a checkpoint.

    Streams has one row: endpoint, stop_page, truncated, failed (its code, or null) and advances (false).
    """
    missing = F.col("code").isin(*ENDPOINT_MISSING)
    ranks = pages.groupBy(endpoint).agg(F.max(missing).alias("__missing"), F.min_by(F.when(F.col("code") != OK, F.col("code")), F.when(F.col("code") != OK, F.col("page"))).alias("failed"))
    chosen = ranks.agg(  # one row: the first endpoint that is there, else the last one asked
        F.coalesce(F.min(F.when(~F.col("__missing"), F.col(endpoint))), F.max(endpoint)).alias(endpoint)
    )
    asked = pages.join(F.broadcast(chosen), endpoint)
    good = asked.filter(F.col("code") == OK)
    comments = materialise(_comments(good, endpoint))
    decided = materialise(judged(good, comments, endpoint))
    stops = paging.stop_pages(decided, endpoint, "page", F.coalesce("complete", F.lit(False)))
    own = paging.walked(comments, stops, endpoint, "page").filter(F.col("author") == user_id)
    replies = normalize_replies(own.drop("id"), posts, user_id, domain, "user_comments")
    merged = merge_versions(replies.withColumn("seq", _sequence()), "id", "seq", RECORD_RULES)
    streams = ranks.join(F.broadcast(chosen), endpoint).join(stops, endpoint, "left").select(
        endpoint, "stop_page", F.coalesce("truncated", F.lit(True)).alias("truncated"), F.when(F.col("stop_page").isNull(), F.col("failed")).alias("failed"), F.lit(False).alias("advances")
    )
    wrong = paging.walked(decided, stops, endpoint, "page").select(endpoint, "page", F.col("violation").alias("code")).filter("code is not null")
    return Scan(merged, streams, wrong.unionByName(replies.select(endpoint, "page", F.explode("violations").alias("code"))).distinct())


def single_records(rows: DataFrame, user_id: str, domain: str, marker: str, code: str = "api_code", body: str = "api_body", html: str = "html") -> DataFrame:
    """Posts fetched one by one: the API's answer, and where that failed what the page embeds.

    An answer that came but is no valid post is not asked for again: it has its violations. Adds `origin` (api, page
    or null) to the fields of a post.
    """
    came = F.coalesce(F.col(code) == OK, F.lit(False))
    inside = embedded_json(F.col(html), marker)
    item = F.when(came, F.col(body)).otherwise(inside)
    origin = F.when(came, "api").when(inside.isNotNull(), "page")
    return normalize_posts(rows.withColumn("item", item).withColumn("origin", origin), user_id, domain)


def ids_scan(refs: DataFrame, existing: DataFrame, answers: DataFrame, user_id: str, domain: str, marker: str, ref: str = "ref") -> Scan:
    """Posts asked for by reference: ids and links, each post once, those that are stored already left out, the rest one by one.

    `existing` has id; `answers` post_id, api_code, api_body and html. Streams has a row for each post that is asked
    for: post_id, author, origin and failed (no valid post came). Problems are references that name no post, and broken
    answers. Records are valid posts alone.
    """
    user, post = post_reference(F.col(ref), domain, user_id)
    parsed = refs.select(F.col(ref).alias("ref"), user.alias("author"), post.alias("post_id"))
    # A post may be named with different users: the least counts, so that the choice is the same on every run.
    wanted = parsed.filter("post_id is not null").groupBy("post_id").agg(F.min("author").alias("author"))
    fresh = skip_existing(wanted, existing.select(F.col("id").cast("string").alias("post_id")), "post_id")
    asked = materialise(fresh.join(answers, "post_id", "left"))
    found = single_records(asked, user_id, domain, marker)
    other = found["id"].isNotNull() & (found["id"] != found["post_id"])
    found = materialise(found.withColumn("violations", F.when(other, F.concat("violations", F.array(F.lit("other_post")))).otherwise(F.col("violations"))))
    fine = F.size("violations") == 0
    streams = found.select("post_id", "author", "origin", (~fine | F.col("origin").isNull()).alias("failed"))
    wrong = parsed.filter("post_id is null").select(F.col("ref").alias("post_id"), F.lit("reference").alias("code"))
    wrong = wrong.unionByName(found.filter("origin is not null").select("post_id", F.explode("violations").alias("code")))
    return Scan(found.filter(fine & F.col("origin").isNotNull()).drop("item", "api_code", "api_body", "html"), streams, wrong.distinct())
