"""The recovery scan of comments: a strict walk through each post's pages with a budget of its own, and through the
pages of replies under each comment, resumable from what an earlier run has stored.

A walk reads pages 1, 2, ... until one proves to be the last. What breaks it - a refused or missing page, page data that
contradict themselves, a comment of another post - has a place in the walk (page, then position), and the first such
place decides. A post that fails gives nothing; one whose walk, or a thread's walk, ends without proof gives what was
seen and is partial. The run ends at the first post that failed or is partial, and the next run starts there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.functions.ids import count_from_literal
from quillfeed.functions.payload import Payload, references_agree
from quillfeed.operators import pages as paging
from quillfeed.operators.merge import first_wins
from quillfeed.operators.normalize import COUNTS, POST_REFERENCES, normalize_replies
from quillfeed.operators.scans import OK, comment_rows, judged_rows
from quillfeed.operators.select import ordered_digest, resume_start
from quillfeed.session import materialise

#: Second names of a comment's references to its post, and the fields that may not be null where they stand.
CAMEL_REFERENCES = ("statusId", "targetId")
DIRECT_REFERENCES = ("status_id", "target_id", *CAMEL_REFERENCES)
REFERENCES = (*POST_REFERENCES, *DIRECT_REFERENCES)
#: Places in a page: before all of its items, and after them.
BEFORE, AFTER = -1, (1 << 31) - 1


@dataclass(frozen=True)
class Walk:
    """Items of the walked pages with the failure of their stream, and a row for each stream: stop_page, observed, failure (page, pos, code) or null."""

    items: DataFrame
    streams: DataFrame


def strict_walk(
    pages: DataFrame, stream: str, item_code: Column | Callable[[Payload], Column], fields: Iterable[str] = (), user_id: str | None = None, **more: Callable[[Payload], Column]
) -> Walk:
    """Walks the pages of each stream by the strict rules; `item_code` names what is wrong with an item, or is null.

    `pages` has the stream, page, count, code and body, only pages within the stream's budget. Items have the columns
    `more`. These and the code are made of the parsed item, most of them of its `fields`. With `user_id`, only items of
    this author have their text.
    """
    rows = materialise(comment_rows(pages, stream, fields, user_id, item_code=item_code, **more))  # each page is parsed once
    code = F.when(F.col("id").isNull(), "id").otherwise(F.col("item_code"))
    items = rows.filter("counts").select(stream, "page", "count", "pos", "id", "author", "item", code.alias("item_code"), *more)
    at = lambda pos, code: F.struct("page", F.lit(pos).alias("pos") if isinstance(pos, int) else pos, code.alias("code"))
    # The window has dealt and sorted pages by streams, so that what ends a walk and what breaks it is one pass over them.
    refused = F.when(F.col("page") != F.col("place"), F.lit("page_sequence")).when(F.col("code") != OK, F.col("code"))
    broken = F.when(refused.isNotNull(), at(BEFORE, refused)).when(F.col("violation").isNotNull(), at(AFTER, F.col("violation")))
    end = F.when(F.col("complete"), F.col("page"))
    ends = judged_rows(rows, stream).groupBy(stream).agg(
        F.min(end).alias("stop_page"), F.min_by("observed", end).alias("__stop"), F.max("observed").alias("__all"), F.min(broken).alias("__broken")
    )
    wrong = items.filter("item_code is not null").groupBy(stream).agg(F.min(at(F.col("pos"), F.col("item_code"))).alias("__wrong"))
    # The first failure counts if the walk comes by its page.
    first = F.least("__broken", "__wrong")
    met = F.col("stop_page").isNull() | (first["page"] <= F.col("stop_page"))
    observed = F.when(F.col("stop_page").isNull(), F.col("__all")).otherwise(F.col("__stop"))
    streams = materialise(ends.join(wrong, stream, "left").select(stream, "stop_page", F.when(met, first).alias("failure"), observed.alias("observed")))
    return Walk(paging.walked(items, streams.drop("observed"), stream, "page").drop("stop_page"), streams)


def _foreign(p: Payload, post: str) -> Column:
    """The code of a comment that names another post, or names one by null."""
    nulls = F.lit(False)
    for name in DIRECT_REFERENCES:
        nulls = nulls | (p.has(name) & (p.literal(name) == "null"))
    agree = references_agree(p, F.col(post).cast("string"), *POST_REFERENCES, *CAMEL_REFERENCES)
    return F.when(nulls | ~F.coalesce(agree, F.lit(False)), "post_reference")


def _declared_replies(p: Payload) -> Column:
    return count_from_literal(p.first_present(*COUNTS[0]))


def nested_reply_scan(roots: DataFrame, pages: DataFrame, page_limit: int, user_id: str | None = None) -> Walk:
    """Walks the replies under each root comment, `page_limit` pages at most.

    `roots` has post_id, comment_id and declared (replies, above 0); `pages` post_id, comment_id, page, count, code and
    body. Streams has a row for each root, also where no page was landed: complete, and truncated where the walk did
    not end or saw fewer replies than declared. Items have post_id, comment_id and what more `roots` has, which is one row
    for a thread then; with `user_id`, only this author's have their text.
    """
    by = ["post_id", "comment_id"]
    thread = F.struct(*by).alias("__thread")  # one key, so that what is dealt by threads once stays so
    wanted = roots.dropna(subset=by).select(thread)
    asked = pages.filter(F.col("page") <= page_limit).select(thread, "page", "count", "code", "body").join(wanted, "__thread", "left_semi")
    walk = strict_walk(asked, "__thread", lambda p: _foreign(p, "__thread.post_id"), REFERENCES, user_id)
    streams = roots.select("*", thread).join(walk.streams, "__thread", "left").drop("__thread")
    observed = F.coalesce("observed", F.lit(0).cast("long"))
    complete = F.col("stop_page").isNotNull() & F.col("failure").isNull()
    streams = streams.withColumn("observed", observed).withColumn("complete", complete).withColumn("truncated", ~complete | (observed < F.col("declared")))
    more = [c for c in roots.columns if c not in (*by, "declared")]
    items = walk.items.join(roots.select(thread, *more), "__thread") if more else walk.items
    return Walk(items.select("__thread.*", "*").drop("__thread"), streams)


@dataclass(frozen=True)
class PostWalks:
    """Own replies with their place, and a row for each post: failure, truncated_streams, observed, stop_page.

    `own` has what replies are made of: post_id, root, place, id and item.
    """

    own: DataFrame
    posts: DataFrame
    replies: DataFrame


def walk_posts(posts: DataFrame, pages: DataFrame, nested: DataFrame | None, user_id: str, domain: str, nested_limit: int = 3) -> PostWalks:
    """Walks every post by itself: a budget of pages from its own count, and its threads where `nested` is given.

    Posts without comments are not asked for. `posts` needs post_id, position, reply_count, created_at_raw, title,
    clean_text and target. A post is truncated by its own walk (`post:id`) and by each thread that is (`nested:id`).
    """
    key = "post_id"
    wanted = posts.filter(F.coalesce("reply_count", F.lit(0)) > 0).select(key, "position", "reply_count")
    budget = F.greatest(F.lit(1), F.ceil(F.col("reply_count") / F.col("count")) + F.lit(2))
    asked = pages.join(wanted.select(key, "reply_count"), key).filter(F.col("page") <= budget).select(key, "page", "count", "code", "body")
    foreign = lambda p: _foreign(p, key)
    if nested is None:
        main = strict_walk(asked, key, foreign, REFERENCES, user_id)
    else:
        item_code = lambda p: F.coalesce(foreign(p), F.when(_declared_replies(p).isNull(), "reply_count"))
        main = strict_walk(asked, key, item_code, (*REFERENCES, *COUNTS[0]), user_id, declared=_declared_replies)
    rows = wanted.join(main.streams, key, "left").withColumn("observed", F.coalesce("observed", F.lit(0).cast("long")))
    short = F.col("stop_page").isNull() | (F.col("observed") < F.col("reply_count"))
    rows = rows.withColumn("__own", F.when(short, F.array(F.concat(F.lit("post:"), F.col(key).cast("string")))).otherwise(F.array().cast("array<string>")))
    places = [F.struct("page", "pos", F.lit(0).alias("nested_page"), F.lit(0).alias("nested_pos")).alias("place")]
    own = main.items.filter(F.col("author") == user_id).select(key, F.lit(None).cast("string").alias("root"), *places, "id", "item")
    if nested is None:
        rows = rows.withColumn("truncated_streams", F.col("__own"))
    else:
        # Threads are walked where the walk of the post comes by: before its failure, if it has one.
        met = F.col("failure").isNull() | (F.struct("page", "pos") < F.struct("failure.page", "failure.pos"))
        roots = main.items.filter("declared > 0").filter(met).select(key, F.col("id").alias("comment_id"), "declared", (F.shiftleft(F.col("page").cast("long"), 32) + F.col("pos")).alias("at"))
        roots = materialise(roots.groupBy(key, "comment_id").agg(F.min("at").alias("at"), F.max("declared").alias("declared")))
        at = {"page": F.shiftright("at", 32).cast("int"), "pos": F.col("at").bitwiseAND((1 << 32) - 1).cast("int")}
        threads = nested_reply_scan(roots, nested, nested_limit, user_id)
        outcome = threads.streams.filter(F.col("failure").isNotNull() | F.col("truncated"))
        code = F.concat(F.lit("nested:"), F.col("comment_id"), F.lit(":"), F.col("failure.code"))
        inner = outcome.groupBy(key).agg(
            F.min(F.when(F.col("failure").isNotNull(), F.struct(*(c.alias(n) for n, c in at.items()), code.alias("code")))).alias("__inner"),
            F.array_sort(F.collect_list(F.when(F.col("truncated"), F.concat(F.lit("nested:"), "comment_id")))).alias("__threads"),  # one entry for each truncated thread of a post
        )
        rows = rows.join(inner, key, "left")
        rows = rows.withColumn("truncated_streams", F.concat(F.coalesce("__threads", F.array().cast("array<string>")), "__own"))
        rows = rows.withColumn("failure", F.least("failure", "__inner"))
        below = threads.items.filter(F.col("author") == user_id)
        place = F.struct(*(c.alias(n) for n, c in at.items()), F.col("page").alias("nested_page"), (F.col("pos") + 1).alias("nested_pos"))
        own = own.unionByName(below.select(key, F.col("comment_id").alias("root"), place.alias("place"), "id", "item"))
    failed = F.col("failure.code")
    judged_posts = rows.select(key, "position", "stop_page", "observed", failed.alias("failed"), F.when(failed.isNull(), F.col("truncated_streams")).otherwise(F.array().cast("array<string>")).alias("truncated_streams"))
    return PostWalks(own, judged_posts, _replies(own, posts, user_id, domain))


def _replies(own: DataFrame, posts: DataFrame, user_id: str, domain: str) -> DataFrame:
    """Own comments as replies to the post, and below the comment, where they were met."""
    replies = normalize_replies(own.drop("id").withColumnRenamed("post_id", "__post"), posts, user_id, domain, "post_comments")
    replies = replies.withColumn("post_id", F.col("__post").cast("string")).withColumn("in_reply_to_comment_id", F.coalesce("root", "in_reply_to_comment_id"))
    return replies.drop("__post", "root", "item")


@dataclass(frozen=True)
class Recovery:
    """The reply corpus after a run, the posts that it judged, and one row of state for the next run."""

    replies: DataFrame
    posts: DataFrame
    state: DataFrame


def recovery_scan(
    posts: DataFrame, pages: DataFrame, nested: DataFrame | None, stored: DataFrame, user_id: str, domain: str, start: int = 0, max_posts: int | None = None, nested_limit: int = 3
) -> Recovery:
    """One run over posts in the order of their position, from `start` on, `max_posts` at most.

    Posts before the first that failed or is partial are scanned; a partial one also gives its replies. Replies that
    are stored stay as they are, new ones come in the order of the walk. `stored` has the columns of replies.
    """
    key = "post_id"
    end = F.lit(True) if max_posts is None else F.col("position") < start + max_posts
    posts = materialise(posts)
    turn = posts.filter((F.col("position") >= start) & end)
    walks = walk_posts(turn, pages, nested, user_id, domain, nested_limit)
    outcome = materialise(walks.posts)
    stopped = outcome.filter(F.col("failed").isNotNull() | (F.size("truncated_streams") > 0))
    last = stopped.agg(F.min(F.struct("position", key, "failed", "truncated_streams")).alias("stop"))  # one row
    reach = turn.agg((F.max("position") + 1).alias("reach")).crossJoin(last)  # one row each
    total = posts.agg(F.coalesce(F.max("position") + 1, F.lit(0)).alias("total_posts"))
    state = reach.crossJoin(total).select(
        F.coalesce("stop.position", "reach", F.lit(start)).cast("long").alias("scanned"),
        "total_posts",
        F.col(f"stop.{key}").cast("string").alias("last_failed_post_id"),
        F.col("stop.failed").alias("failed"),
        F.coalesce("stop.truncated_streams", F.array().cast("array<string>")).alias("truncated_streams"),
    )
    state = materialise(state.withColumn("completed", F.col("last_failed_post_id").isNull() & (F.col("scanned") >= F.col("total_posts"))))
    bound = F.broadcast(state.select(F.col("scanned").alias("__end"), F.col("failed").isNull().alias("__partial")))
    taken = outcome.crossJoin(bound).filter((F.col("position") < F.col("__end")) | ((F.col("position") == F.col("__end")) & F.col("__partial"))).drop("__end", "__partial")
    order = F.struct(F.col("position"), F.col("place"))
    # Only what is taken, each id as it was met first, becomes a reply; a post that was walked is there once.
    met = walks.own.filter(F.col("id").isNotNull()).join(taken.select(key, "position"), key).withColumn("order", F.struct("position", "place"))
    met = met.groupBy("id").agg(F.min_by(F.struct(key, "root", "order", "item"), F.col("order")).alias("__row")).select("id", "__row.*")
    first = _replies(met, turn.filter("reply_count > 0"), user_id, domain)
    return Recovery(first_wins(stored, first, "id"), outcome.crossJoin(bound).filter(F.col("position") <= F.col("__end")).drop("__end", "__partial"), state)


def fingerprints(posts: DataFrame, replies: DataFrame) -> tuple[str | None, str | None]:
    """Digests of the timeline (ids and counts in order) and of the reply corpus (by id)."""
    timeline = ordered_digest(posts.withColumn("__all", F.lit(1)), "__all", ["position", "post_id"], "post_id", "reply_count")
    corpus = ordered_digest(replies.withColumn("__all", F.lit(1)), "__all", ["id"], "id", "post_id", "text")
    one = lambda df: next((r["digest"] for r in df.collect()), None)  # one row
    return one(timeline), one(corpus)


def resume_position(spark_row: dict | None, posts: DataFrame, replies: DataFrame) -> int:
    """Where the next run starts by a stored state (scanned, timeline and replies digests); ValueError where it does not fit.

    Without a state, or where the timeline has changed, runs start anew; a reply corpus that is not the one of the
    state, or a position beyond the timeline, is an error.
    """
    if not spark_row:
        return 0
    timeline, corpus = fingerprints(posts, replies)
    row = posts.sparkSession.createDataFrame(
        [(spark_row.get("scanned", 0), timeline, spark_row.get("timeline"), corpus, spark_row.get("replies"))],
        "scanned long, timeline string, timeline_then string, replies string, replies_then string",
    )
    start, violation = resume_start(F.col("scanned"), F.col("timeline"), F.col("timeline_then"), F.col("replies"), F.col("replies_then"))
    found = row.select(start.alias("start"), violation.alias("violation")).collect()[0]
    if found["violation"]:
        raise ValueError(found["violation"])
    if found["start"] > posts.count():
        raise ValueError("invalid_cursor")
    return found["start"]
