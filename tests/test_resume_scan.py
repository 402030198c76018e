"""The recovery scan by hand, against a plain walk, and resumed against unbroken."""

import json
import math
import random

import pytest

from quillfeed.operators import resume_scan
from tests.test_scans import comment, posts

PAGES = "post_id string, page int, count int, code string, body string"
NESTED = "post_id string, comment_id string, page int, count int, code string, body string"
STORED = "id string, post_id string, text string"


def main_pages(spark, rows):
    return spark.createDataFrame([(p, n, 2, code, json.dumps(b)) for p, n, code, b in rows], PAGES)


def nested_pages(spark, rows):
    return spark.createDataFrame([(p, c, n, 2, code, json.dumps(b)) for p, c, n, code, b in rows], NESTED)


def ok(*items, more=False, **meta):
    return {"comments": list(items), "has_more": more, **meta}


def outcome(walks):
    return {r["post_id"]: (r["stop_page"], r["observed"], r["failed"], list(r["truncated_streams"])) for r in walks.posts.collect()}


def test_each_post_has_a_budget_and_a_strict_paginator(spark):
    full = lambda a: ok(comment(a), comment(a + 1), more=True)
    found = main_pages(
        spark,
        [
            ("1", 1, "OK", full(10)), ("1", 2, "OK", ok(comment(12))),  # ends on page 2
            ("2", 1, "OK", full(20)), ("2", 2, "OK", full(22)), ("2", 3, "OK", full(24)), ("2", 4, "OK", ok(comment(26))),  # 1 comment: a budget of 3 pages
            ("3", 1, "OK", ok(comment(30), has_more="false")),  # a text is no evidence here
            ("4", 1, "OK", ok(comment(40), total=3)),  # ends by has_more, goes on by total: contradiction
            ("5", 1, "OK", full(50)), ("5", 2, "WAF", {}),
            ("6", 1, "OK", full(60)), ("6", 3, "OK", ok(comment(62))),  # page 2 is missing
            ("7", 1, "OK", ok(comment(70))),  # fewer than declared
            ("8", 1, "OK", ok(comment(80, status=9))),  # belongs to another post
            ("9", 1, "OK", ok(comment(90, status_id=None))),
            ("10", 1, "OK", ok(comment("x"))),
            ("11", 1, "OK", ok(comment(110), total=1, max_page=2, has_more=True)),
        ],
    )
    counts = {1: 3, 2: 1, 3: 1, 4: 1, 5: 3, 6: 3, 7: 2, 8: 1, 9: 1, 10: 1, 11: 1, 12: 4, 13: 0}
    walks = resume_scan.walk_posts(posts(spark, counts), found, None, "7", "example.com")
    got = outcome(walks)
    assert got["1"] == (2, 3, None, []) and got["2"] == (None, 6, None, ["post:2"]) and got["7"] == (1, 1, None, ["post:7"])
    assert got["3"][2] == "invalid_has_more" and got["4"][2] == "mixed_evidence" and got["5"][2] == "WAF" and got["6"][2] == "page_sequence"
    assert got["8"][2] == got["9"][2] == "post_reference" and got["10"][2] == "id" and got["11"][2] is not None
    assert got["12"] == (None, 0, None, ["post:12"]) and "13" not in got


def test_a_thread_that_is_short_makes_its_post_partial(spark):
    found = main_pages(
        spark,
        [
            ("1", 1, "OK", ok(comment(10, reply_count=3), comment(11, 8, reply_count=1), more=True)), ("1", 2, "OK", ok(comment(12))),
            ("2", 1, "OK", ok(comment(20, reply_count=2))), ("3", 1, "OK", ok(comment(30, reply_count=1), comment(31, reply_count=1), more=False)),
            ("4", 1, "OK", ok({k: v for k, v in comment(40).items() if k != "reply_count"})), ("5", 1, "OK", ok(comment(50, reply_count=1))),
        ],
    )
    inner = nested_pages(
        spark,
        [
            ("1", "10", 1, "OK", ok(comment(101), comment(102, 8), more=True)), ("1", "10", 2, "OK", ok(comment(103))), ("1", "11", 1, "OK", ok(comment(111))),
            ("2", "20", 1, "OK", ok(comment(201))),  # one of two
            ("3", "30", 1, "HTTP_500", {}), ("3", "31", 1, "OK", ok(comment(311))),
            ("9", "10", 1, "OK", ok(comment(999))),  # of a post that is not asked for
        ],
    )
    walks = resume_scan.walk_posts(posts(spark, {1: 3, 2: 1, 3: 2, 4: 1, 5: 1}), found, inner, "7", "example.com", nested_limit=2)
    got = outcome(walks)
    assert got["1"] == (2, 3, None, []) and got["2"] == (1, 1, None, ["nested:20"])
    assert got["3"][2] == "nested:30:HTTP_500" and got["4"][2] == "reply_count" and got["5"][3] == ["nested:50"]
    rows = {r["id"]: (r["post_id"], r["in_reply_to_comment_id"]) for r in walks.replies.collect()}
    assert rows["101"] == ("1", "10") and rows["103"] == ("1", "10") and rows["111"] == ("1", "11") and rows["12"] == ("1", None) and "102" not in rows


def feed(rng, n_posts, flawed):
    """A random feed: (counts, main pages, nested pages), as a transport would land them; `flawed` posts hold some defect."""
    counts, main, inner, serial = {}, [], [], iter(range(1000, 10**6))
    for i in range(1, n_posts + 1):
        size = rng.choice([0, 1, 2, 3, 5])
        defect = rng.choice(["refused", "open", "short", "nested_short", "nested_refused"]) if i in flawed and size else None
        counts[i] = size + (defect == "short")
        items = []
        for _ in range(size):
            replies = rng.choice([0, 0, 1, 3])
            c = comment(next(serial), rng.choice([7, 8]), reply_count=replies)
            items.append(c)
            pages = math.ceil(replies / 2)
            for page in range(1, pages + 1):
                more = [comment(next(serial), rng.choice([7, 8])) for _ in range(min(2, replies - 2 * (page - 1)))]
                if defect == "nested_refused":
                    inner.append((str(i), str(c["id"]), page, "WAF", {}))
                elif not (defect == "nested_short" and page == pages):
                    inner.append((str(i), str(c["id"]), page, "OK", ok(*more, more=page < pages)))
        for page in range(1, max(1, math.ceil(size / 2)) + 1):
            part = items[2 * (page - 1) : 2 * page]
            last = page >= math.ceil(size / 2)
            main.append((str(i), page, "WAF" if defect == "refused" and last else "OK", ok(*part, more=not last or defect == "open")))
    return counts, main, inner


def plain_run(counts, main, inner, stored, start, limit, user=7, budget_of=2, nested_limit=3):
    """The walk in plain Python over well-formed pages: (reply ids in order, next position, completed)."""
    main, inner = {(p, n): (c, b) for p, n, c, b in main}, {(p, k, n): (c, b) for p, k, n, c, b in inner}
    ids, order = list(stored), list(counts)
    for position in range(start, min(len(order), start + limit)):
        i = order[position]
        if not counts[i]:
            continue
        found, partial, done, seen = [], False, False, set()
        try:
            for page in range(1, max(1, math.ceil(counts[i] / budget_of) + 2) + 1):
                if (str(i), page) not in main:
                    break
                code, body = main[str(i), page]
                if code != "OK":
                    raise OSError
                for c in body["comments"]:
                    seen.add(c["id"])
                    if c["user"]["id"] == user:
                        found.append(str(c["id"]))
                    if c["reply_count"]:
                        under, ended = set(), False
                        for sub in range(1, nested_limit + 1):
                            if (str(i), str(c["id"]), sub) not in inner:
                                break
                            code, below = inner[str(i), str(c["id"]), sub]
                            if code != "OK":
                                raise OSError
                            under |= {x["id"] for x in below["comments"]}
                            found += [str(x["id"]) for x in below["comments"] if x["user"]["id"] == user]
                            if not below["has_more"]:
                                ended = True
                                break
                        partial |= not ended or len(under) < c["reply_count"]
                if not body["has_more"]:
                    done = True
                    break
        except OSError:
            return ids, position, False
        ids += [x for x in found if x not in ids]
        if partial or not done or len(seen) < counts[i]:
            return ids, position, False
    reach = min(len(order), start + limit)
    return ids, reach, reach >= len(order)


@pytest.mark.parametrize("seed", range(2))
def test_against_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    counts, main, inner = feed(rng, 10, {rng.randint(4, 10)} if seed else set())
    known = spark.createDataFrame([], STORED)
    run = resume_scan.recovery_scan(posts(spark, counts), main_pages(spark, main), nested_pages(spark, inner), known, "7", "example.com")
    want, position, completed = plain_run(counts, main, inner, [], 0, 99)
    assert [r["id"] for r in run.replies.orderBy("order").collect()] == want
    state = run.state.collect()[0]
    assert (state["scanned"], state["completed"]) == (position, completed)


def test_a_resumed_run_equals_an_unbroken_one(spark):
    rng = random.Random(11)
    counts, main, inner = feed(rng, 9, set())
    known, timeline = spark.createDataFrame([], STORED), posts(spark, counts)
    args = (main_pages(spark, main), nested_pages(spark, inner))
    whole = resume_scan.recovery_scan(timeline, *args, known, "7", "example.com")
    stored, start = known, 0
    for _ in range(3):
        part = resume_scan.recovery_scan(timeline, *args, stored, "7", "example.com", start=start, max_posts=4)
        start = part.state.collect()[0]["scanned"]
        stored = spark.createDataFrame(part.replies.collect(), part.replies.schema) if part.replies.count() else known
    key = lambda df: sorted((r["id"], r["post_id"], r["in_reply_to_comment_id"], r["text"]) for r in df.collect())
    assert key(stored) == key(whole.replies) and start == 9


def test_a_reply_is_made_once_of_what_is_taken(spark):
    """Only taken comments become replies, after equal ids are one; numbers of another form are the ids that they are."""
    second = json.dumps(ok(comment(20)))
    found = main_pages(spark, [("1", 1, "OK", ok(comment(10, like_count=5), comment(11, 8), more=True)), ("1", 2, "OK", ok(comment(10, like_count=6))), ("3", 1, "WAF", ok(comment(30)))])
    found = found.unionByName(spark.createDataFrame([("2", 1, 2, "OK", second.replace('"id": 20', '"id": 2e1'))], PAGES))
    run = resume_scan.recovery_scan(posts(spark, {1: 2, 2: 1, 3: 1}), found, None, spark.createDataFrame([], STORED), "7", "example.com")
    assert [(r["id"], r["post_id"], r["like_count"]) for r in run.replies.orderBy("order").collect()] == [("10", "1", 5), ("20", "2", 0)]
    assert run.state.collect()[0]["failed"] == "WAF"
    walks = resume_scan.walk_posts(posts(spark, {1: 2}), found, None, "7", "example.com")
    assert {r["id"] for r in walks.own.collect()} == {"10"} and set(walks.own.columns) == {"post_id", "root", "place", "id", "item"}


def test_pages_are_parsed_once(spark, monkeypatch):
    """A walk reads each page's text in one place alone, and keeps the texts of the user's own comments only."""
    written, materialise = [], resume_scan.materialise
    monkeypatch.setattr(resume_scan, "materialise", lambda df: written.append(materialise(df)) or written[-1])
    pages = main_pages(spark, [("1", 1, "OK", ok(comment(10), comment(11, 8), more=True)), ("1", 2, "HTTP_500", ok(comment(12))), ("2", 1, "OK", ok())])
    walk = resume_scan.strict_walk(pages, "post_id", lambda p: resume_scan._foreign(p, "post_id"), resume_scan.REFERENCES, "7")
    assert not any("body" in df.columns for df in written)
    assert {(r["id"], r["item"] is not None) for r in walk.items.collect()} == {("10", True), ("11", False)}
    rows = {r["post_id"]: (r["stop_page"], r["failure"] and r["failure"]["code"], r["observed"]) for r in walk.streams.collect()}
    assert rows == {"1": (None, "HTTP_500", 2), "2": (1, None, 0)}


def test_where_a_run_starts(spark):
    timeline, corpus = posts(spark, {1: 2, 2: 0, 3: 5}), spark.createDataFrame([("5", "1", "x"), ("6", "1", "y")], STORED)
    then, replies = resume_scan.fingerprints(timeline, corpus)
    state = {"scanned": 2, "timeline": then, "replies": replies}
    assert resume_scan.resume_position(None, timeline, corpus) == 0
    assert resume_scan.resume_position(state, timeline, corpus) == 2
    assert resume_scan.resume_position(state, posts(spark, {1: 2, 2: 1, 3: 5}), corpus) == 0  # the timeline has changed
    for wrong, other in ((state, corpus.limit(1)), (state | {"scanned": -1}, corpus), (state | {"scanned": 4}, corpus)):
        with pytest.raises(ValueError):
            resume_scan.resume_position(wrong, timeline, other)


def test_empty_tables(spark):
    run = resume_scan.recovery_scan(posts(spark, {1: 0}).limit(0), main_pages(spark, []), nested_pages(spark, []), spark.createDataFrame([], STORED), "7", "example.com")
    assert run.replies.collect() == [] and run.posts.collect() == [] and run.state.collect()[0]["completed"]
