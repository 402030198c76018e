"""Raw feed rows to records: posts, replies, hydration of sparse rows, threads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.binding import named
from quillfeed.functions.ids import canonical_url, count_from_literal, loose_id
from quillfeed.functions.payload import PARSED, Payload, author_id, parsed_rows, references_agree
from quillfeed.functions.text import ascii_trim, clean_html
from quillfeed.functions.times import epoch_ms_from_literal, format_epoch_ms, is_unknown_literal
from quillfeed.operators.contracts import SCHEMA_VERSION, STRICT, acquisition_markers_ok

#: The four interaction counts and their second names.
COUNTS = (("reply_count", "replyCount"), ("like_count", "likeCount"), ("retweet_count", "retweetCount"), ("view_count", "viewCount"))
#: Where a comment may carry its post, and fields in which it may name it.
EMBEDDED_POSTS = ("status", "target_status", "original_status")
POST_REFERENCES = ("status_id", "target_id", "status.id", "target_status.id", "original_status.id")


def bare(literal: Column) -> Column:
    """The text of a JSON string, or the literal of anything else."""
    inner = F.get_json_object(F.concat(F.lit('{"x":'), literal, F.lit("}")), "$.x")
    return F.when(literal.startswith('"'), inner).otherwise(literal)


def string(literal: Column) -> Column:
    return F.when(literal.startswith('"'), bare(literal))


def _codes(conditions: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in conditions.items())))


def normalize_posts(raw: DataFrame, user_id: str, domain: str, item: str = "item", **more: Callable[[Payload], Column]) -> DataFrame:
    """All columns of `raw`, the fields of a strict post, `violations`, and what more is asked of the parsed item."""
    # What comes in several fields is a column of its own, so that Spark makes it once for each row.
    rows, p = parsed_rows(raw, item, fields=("id", "text", "description", "created_at", "target", *(n for pair in COUNTS for n in pair), "title", "rawTitle", "schema_version", "record_contract"))
    rows, (literal, text, made, given, *shown) = named(
        rows, p.literal("id"), string(p.first_present("text", "description")), p.literal("created_at"), F.when(p.kind("target") == "string", p.text("target")),
        *(p.first_present(name, other) for name, other in COUNTS),
    )
    rows, (identity, epoch, *numbers) = named(rows, loose_id(bare(literal)), epoch_ms_from_literal(made), *(count_from_literal(c) for c in shown))
    rows, (target,) = named(rows, canonical_url(given, domain, F.lit(user_id), identity))
    title = F.coalesce(F.nullif(string(p.literal("title")), F.lit("")), string(p.literal("rawTitle")), F.lit(""))
    counts = {name: c for (name, _), c in zip(COUNTS, numbers, strict=True)}
    broken = {
        "not_an_object": ~p.is_object(),
        "markers": ~acquisition_markers_ok(p),
        "id": identity.isNull(),
        "text": text.isNull(),
        "created_at": made.isNull() | (epoch.isNull() & ~is_unknown_literal(made)),
        "target": target.isNull(),
        **{name: c.isNull() for name, c in counts.items()},
    }
    return rows.select(
        *raw.columns,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(STRICT).alias("record_contract"),
        F.lit("post").alias("kind"),
        identity.alias("id"),
        made.alias("created_at_raw"),
        format_epoch_ms(epoch).alias("created_at"),
        epoch.alias("epoch_ms"),
        clean_html(title).alias("title"),
        text.alias("text"),
        clean_html(text).alias("clean_text"),
        target.alias("target"),
        *(c.alias(name) for name, c in counts.items()),
        _codes(broken).alias("violations"),
        *(use(p).alias(name) for name, use in more.items()),
    )


def normalize_replies(comments: DataFrame, posts: DataFrame, user_id: str, domain: str, origin: str, item: str = "item") -> DataFrame:
    """Comments as strict replies with the fields of their post, which is found by id with a left join.

    `posts` needs post_id, created_at_raw, title, clean_text and target. A post that is not among them is taken from
    the comment's embedded copy, if it has one. `violations` holds codes of broken rules.
    """
    rows, p = parsed_rows(comments, item)
    pick = lambda *names: loose_id(bare(p.first_present(*names)))
    rows, (post,) = named(rows, p.first_present("status_id", "status.id", "target_status.id", "original_status.id", "target_id"))
    rows = rows.select(*comments.columns, loose_id(bare(post)).alias("__post_id"))
    parent = posts.select(
        F.col("post_id").alias("__post_id"), F.col("created_at_raw").alias("__raw"), F.col("title").alias("__title"),
        F.col("clean_text").alias("__text"), F.col("target").alias("__target"),
    )
    inside = lambda *names: p.first_present(*(f"{e}.{n}" for e in EMBEDDED_POSTS for n in names))
    here = F.col("__target").isNull()
    joined, p = parsed_rows(rows.join(parent, "__post_id", "left"), item)
    joined = joined.select(
        *rows.columns,
        PARSED,
        F.when(here, F.coalesce("__raw", inside("created_at"))).otherwise(F.col("__raw")).alias("__raw"),
        F.when(here, clean_html(F.coalesce(string(inside("title", "rawTitle")), F.lit("")))).otherwise(F.col("__title")).alias("__title"),
        F.when(here, clean_html(string(inside("text", "description")))).otherwise(F.col("__text")).alias("__text"),
        F.coalesce(F.col("__target"), string(inside("target")), F.lit("")).alias("__target"),
    )
    joined, (literal, text, made, post_raw, likes, replies) = named(
        joined, p.first_present("id"), string(p.first_present("text", "description")), p.literal("created_at"), F.coalesce(F.col("__raw"), F.lit("null")),
        *(p.first_present(*names) for names in (COUNTS[1], COUNTS[0])),
    )
    joined, (identity, epoch, target, likes, replies) = named(
        joined, loose_id(bare(literal)), epoch_ms_from_literal(made), canonical_url(F.col("__target"), domain, F.lit(user_id), F.col("__post_id")),
        count_from_literal(likes), count_from_literal(replies),
    )
    broken = {
        "not_an_object": ~p.is_object(),
        "markers": ~acquisition_markers_ok(p),
        "id": identity.isNull(),
        "post_id": F.col("__post_id").isNull(),
        "post_reference": ~references_agree(p, F.col("__post_id"), *POST_REFERENCES),
        "text": text.isNull(),
        "created_at": made.isNull() | (epoch.isNull() & ~is_unknown_literal(made)),
        "post_target": target.isNull(),
        "like_count": likes.isNull(),
        "reply_count": replies.isNull(),
        "source": p.has("source") & ~p.kind("source").isin("string", "null"),
    }
    return joined.select(
        *comments.columns,
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(STRICT).alias("record_contract"),
        F.lit("reply").alias("kind"),
        identity.alias("id"),
        author_id(p).alias("author_id"),
        made.alias("created_at_raw"),
        format_epoch_ms(epoch).alias("created_at"),
        epoch.alias("epoch_ms"),
        text.alias("text"),
        clean_html(text).alias("clean_text"),
        pick("reply_to_id", "reply_to.id").alias("reply_to"),
        pick("root_comment_id", "in_reply_to_comment_id").alias("in_reply_to_comment_id"),
        F.col("__post_id").alias("post_id"),
        post_raw.alias("post_created_at_raw"),
        format_epoch_ms(epoch_ms_from_literal(post_raw)).alias("post_created_at"),
        F.coalesce("__title", F.lit("")).alias("post_title"),
        F.coalesce("__text", F.lit("")).alias("post_text"),
        target.alias("post_target"),
        likes.alias("like_count"),
        replies.alias("reply_count"),
        F.lit(origin).alias("origin"),
        F.coalesce(p.text("source"), F.lit("")).alias("source"),
        _codes(broken).alias("violations"),
    )


def by_author(rows: DataFrame, user_id: str, item: str = "item") -> DataFrame:
    """Rows that the user wrote."""
    parsed, p = parsed_rows(rows, item)
    return parsed.filter(author_id(p) == user_id).drop(PARSED)


def is_sparse(p: Payload) -> Column:
    """Whether a timeline row lacks one of its four counts under both names."""
    missing = [p.first_present(*names).isNull() for names in COUNTS]
    out = F.lit(False)
    for m in missing:
        out = out | m
    return out


def hydrate(rows: DataFrame, details: DataFrame, key: str = "id", item: str = "item", detail: str = "detail") -> DataFrame:
    """Adds fields of the detail to sparse rows: `item` with the detail's fields over it, `violation` where ids differ.

    A field that the detail has wins even with null; a view count of the list wins over the detail's. Only sparse rows
    meet the join; the others pass by.
    """
    p = Payload(F.col(item))
    marked = rows.withColumn("__sparse", is_sparse(p))
    full = marked.filter(~F.col("__sparse")).withColumn("violation", F.lit(None).cast("string"))
    sparse = marked.filter("__sparse").join(details.select(key, detail), key, "left")
    d = Payload(F.col(detail))
    views = p.first_present("view_count", "viewCount")
    head = F.regexp_replace(ascii_trim(F.col(detail)), r"\A\{|\}\z", "")
    merged = F.concat(
        F.lit("{"), head, F.when(head.rlike(r"\S"), ",").otherwise(""), F.lit('"__list":'), F.col(item),
        F.when(views.isNotNull(), F.concat(F.lit(',"__views":'), views)).otherwise(""), F.lit("}"),
    )
    differs = ~loose_id(bare(d.literal("id"))).eqNullSafe(loose_id(bare(p.literal("id"))))
    filled = sparse.withColumn("violation", F.when(F.col(detail).isNull(), "detail_missing").when(differs, "detail_id")).withColumn(
        item, F.when(F.col("violation").isNull(), merged).otherwise(F.col(item))
    )
    return full.drop("__sparse").unionByName(filled.drop("__sparse", detail))


def hydrated_value(p: Payload, name: str, other: str | None = None) -> Column:
    """Literal of a field of a hydrated row: the list's view count, else the detail's field if present, else the list's."""
    names = [name] + ([other] if other else [])
    detail = F.coalesce(*(F.when(p.has(n), p.literal(n)) for n in names))
    listed = F.coalesce(*(p.literal(f"__list.{n}") for n in names))
    found = F.coalesce(detail, listed)
    return F.coalesce(p.literal("__views"), found) if name == "view_count" else found


def threads(comments: DataFrame, nested: DataFrame, key: str = "id", root: str = "root_comment_id", post: str = "post_id") -> DataFrame:
    """Second-level comments with the post of their root; two levels at most, so one join does."""
    roots = comments.select(F.col(key).alias(root), F.col(post).alias("root_post_id"))
    return nested.join(roots, root, "left")
