"""Composed scans on landed pages by hand: where walks end, what fails, what is taken."""

import json
import re

from pyspark.sql import functions as F

from quillfeed.operators import normalize, resume_scan, scans, states

PAGES = "page int, count int, code string, body string"


def post(i, epoch=1_700_000_000, **more):
    return {"id": i, "created_at": epoch * 1000, "text": f"t{i}", "reply_count": 1, "like_count": 1, "retweet_count": 1, "view_count": 1, **more}


def comment(i, user=7, status=None, **more):
    return {"id": i, "user": {"id": user}, "text": f"c{i}", "created_at": 0, "like_count": 0, "reply_count": 0, **({} if status is None else {"status_id": status}), **more}


def timeline(spark, pages, since=None, count=2):
    rows = [(s, p, count, json.dumps(b)) for s, p, b in pages]
    return scans.timeline_scan(spark.createDataFrame(rows, "stream string, page int, count int, body string"), "7", "example.com", since)


def test_timeline_ends_and_truncation(spark):
    scan = timeline(
        spark,
        [
            ("a", 1, {"statuses": [post(1), post(2)], "has_more": True}), ("a", 2, {"statuses": [post(3)]}), ("a", 3, {"statuses": [post(9), post(8)], "has_more": True}),
            ("b", 1, {"list": [post(4), post(5)], "has_more": True}),
            ("c", 1, {"statuses": []}),
            ("d", 1, {"statuses": [post(6, mark=1), post(1), post(7)], "has_more": False}),
        ],
    )
    assert {r["stream"]: (r["stop_page"], r["truncated"]) for r in scan.streams.collect()} == {"a": (2, False), "b": (None, True), "c": (1, False), "d": (1, False)}
    assert sorted((r["stream"], r["id"]) for r in scan.records.collect()) == [("a", "1"), ("a", "2"), ("a", "3"), ("b", "4"), ("b", "5"), ("d", "1"), ("d", "6"), ("d", "7")]
    assert scan.problems.collect() == []


def test_timeline_stops_at_a_date_that_is_certain(spark):
    old, new = 1_600_000_000, 1_700_000_000
    pages = [
        ("a", 1, {"statuses": [post(1, new), post(2, new)], "has_more": True}), ("a", 2, {"statuses": [post(3, new), post(4, old)], "has_more": True}),
        ("a", 3, {"statuses": [post(5, old), post(6, old)], "has_more": True}), ("a", 4, {"statuses": [post(7, old), post(8, old)], "has_more": True}),
    ]
    scan = timeline(spark, pages, since=1_650_000_000_000)
    assert [(r["stop_page"], r["truncated"]) for r in scan.streams.collect()] == [(3, False)]
    assert sorted(r["id"] for r in scan.records.collect()) == ["1", "2", "3"]


def test_timeline_names_what_is_wrong(spark):
    scan = timeline(spark, [("a", 1, {"statuses": [post(1), post("x")], "has_more": True}), ("b", 1, {"statuses": [post(2), post(3), post(4)], "has_more": False}), ("c", 1, {"nothing": 1})])
    assert {(r["stream"], r["code"]) for r in scan.problems.collect()} >= {("a", "id"), ("b", "unexplained_overflow")}
    assert timeline(spark, [("a", 1, {"statuses": []})]).records.collect() == []


POSTS = "post_id string, position long, reply_count long, created_at_raw string, title string, clean_text string, target string"


def posts(spark, counts):
    return spark.createDataFrame([(str(i), n, c, "0", "T", "p", "") for n, (i, c) in enumerate(counts.items())], POSTS)


def pages(spark, rows, key="post_id"):
    return spark.createDataFrame([(k, p, 2, code, json.dumps(b)) for k, p, code, b in rows], f"{key} {'string' if key == 'post_id' else 'int'}, {PAGES}")


def test_changed_posts_are_scanned_in_order_until_a_refusal(spark):
    found = pages(
        spark,
        [
            ("10", 1, "OK", {"comments": [comment(1, status=10), comment(2, 8, 10)], "has_more": True}), ("10", 2, "OK", {"comments": [comment(3, status=10)], "has_more": False, "count": 4}),
            ("11", 1, "OK", {"comments": [comment(4, status=11)], "has_more": False}),
            ("12", 1, "OK", {"comments": [comment(5, status=12), comment(6, status=12)], "has_more": True}),
            ("13", 1, "WAF", {}), ("14", 1, "OK", {"comments": [comment(7, status=14)], "has_more": False}),
        ],
    )
    known = spark.createDataFrame([("11", 1), ("14", 5)], "post_id string, reply_count long")
    scan = scans.changed_comment_scan(posts(spark, {10: 9, 11: 1, 12: 2, 13: 1, 14: 1}), known, found, "7", "example.com", 100)
    got = {r["post_id"]: (r["observed"], r["truncated"], r["unverified"], r["confirmed"], r["gap"]["unavailable_count"] if r["gap"] else None) for r in scan.streams.collect()}
    assert got == {"10": (3, False, False, True, 1), "12": (2, True, False, False, None)}
    assert sorted((r["id"], r["post_id"]) for r in scan.records.collect()) == [("1", "10"), ("3", "10"), ("5", "12"), ("6", "12")]
    limited = scans.changed_comment_scan(posts(spark, {10: 9, 11: 1, 12: 2, 13: 1, 14: 1}), known, found, "7", "example.com", 1)
    assert [r["post_id"] for r in limited.streams.collect()] == ["10"]


def test_a_reply_scan_fails_where_it_may_have_missed_some(spark):
    ok = lambda *items, more=False: {"comments": list(items), "has_more": more}
    found = pages(
        spark,
        [
            ("1", 1, "OK", ok(comment(1), comment(2, 8))), ("2", 1, "OK", ok(comment(3), comment(4), more=True)), ("2", 2, "OK", ok(comment(5), comment(6), more=True)),
            ("3", 1, "OK", ok(comment(7), comment(8), more=True)), ("3", 2, "HTTP_500", {}), ("4", 1, "OK", ok(comment(9))), ("5", 1, "OK", ok(comment(1, text="again"))),
            ("6", 2, "OK", ok(comment(10))), ("8", 1, "OK", ok()),
        ],
    )
    scan = scans.post_reply_scan(posts(spark, {1: 2, 2: 4, 3: 2, 4: 2, 5: 1, 6: 1, 7: 0, 8: 0, 9: 99}), found, "7", "example.com", reply_pages=2, count=2)
    assert {r["post_id"]: r["request_failed"] for r in scan.streams.collect()} == {"1": False, "2": True, "3": True, "4": True, "5": False, "6": True, "7": True, "8": False, "9": True}
    got = {r["id"]: (r["post_id"], r["text"]) for r in scan.records.collect()}
    assert got == {"1": ("5", "again"), "3": ("2", "c3"), "4": ("2", "c4"), "5": ("2", "c5"), "6": ("2", "c6"), "7": ("3", "c7"), "8": ("3", "c8"), "9": ("4", "c9")}


def test_own_comments_come_from_the_first_endpoint_there_is(spark):
    body = {"comments": [comment(1, status=5), comment(2, 8, 5)], "has_more": False}
    rows = [(0, 1, "HTTP_404", {}), (1, 1, "OK", body), (2, 1, "OK", {"comments": [comment(9, status=5)], "has_more": False})]
    scan = scans.user_comment_scan(pages(spark, rows, "endpoint"), posts(spark, {5: 1}), "7", "example.com")
    assert [r["id"] for r in scan.records.collect()] == ["1"]
    assert [tuple(r) for r in scan.streams.select("endpoint", "truncated", "failed", "advances").collect()] == [(1, False, None, False)]
    broken = scans.user_comment_scan(pages(spark, [(0, 1, "WAF", {}), (1, 1, "OK", body)], "endpoint"), posts(spark, {5: 1}), "7", "example.com")
    assert [tuple(r) for r in broken.streams.select("endpoint", "failed").collect()] == [(0, "WAF")] and broken.records.collect() == []


def test_single_records(spark):
    page = "<script>window.STATUS = " + json.dumps(post(2)) + ";\n</script>"
    rows = [(1, "OK", json.dumps(post(1)), page), (2, "HTTP_500", None, page), (3, "OK", "[]", page), (4, "WAF", None, "<p>none</p>"), (5, None, None, None)]
    df = spark.createDataFrame(rows, "k int, api_code string, api_body string, html string")
    got = {r["k"]: (r["origin"], r["id"], not r["violations"]) for r in scans.single_records(df, "7", "example.com", r"window\.STATUS").collect()}
    assert got == {1: ("api", "1", True), 2: ("page", "2", True), 3: ("api", None, False), 4: (None, None, False), 5: (None, None, False)}


def test_posts_by_reference(spark):
    """Each post once, stored ones left out, links of the domain alone, then the API's answer or what the page embeds."""
    page = "<script>window.STATUS = " + json.dumps(post(2)) + ";\n</script>"
    refs = [("1",), (" 1 ",), ("https://example.com/7/1",), ("2",), ("https://www.example.com/9/3/",), ("4",), ("5",), ("6",), ("https://evil.com/7/8",), ("x",), (None,), ("7",)]
    answers = [("1", "OK", json.dumps(post(1)), None), ("2", "HTTP_500", None, page), ("3", "OK", json.dumps(post(3)), None), ("4", "WAF", None, None), ("5", "OK", "[]", page), ("6", "OK", json.dumps(post(66)), None), ("7", "OK", json.dumps(post(7)), None)]
    scan = scans.ids_scan(
        spark.createDataFrame(refs, "ref string"), spark.createDataFrame([(7,)], "id long"),
        spark.createDataFrame(answers, "post_id string, api_code string, api_body string, html string"), "7", "example.com", r"window\.STATUS",
    )
    assert {r["post_id"]: (r["author"], r["origin"], r["failed"]) for r in scan.streams.collect()} == {
        "1": ("7", "api", False), "2": ("7", "page", False), "3": ("9", "api", False), "4": ("7", None, True), "5": ("7", "api", True), "6": ("7", "api", True)
    }
    assert sorted(r["id"] for r in scan.records.collect()) == ["1", "2", "3"]
    wrong = {(r["post_id"], r["code"]) for r in scan.problems.collect()}
    assert {("https://evil.com/7/8", "reference"), ("x", "reference"), (None, "reference"), ("6", "other_post")} <= wrong and ("5", "id") in wrong


def parses(df):
    """How often the plan parses a JSON text."""
    return len(re.findall(r"(?i)parse_?json\(", df._jdf.queryExecution().optimizedPlan().toString()))


def test_each_text_is_parsed_once(spark):
    items = spark.createDataFrame([(1, "{}")], "post_id long, item string")
    posts = spark.createDataFrame([("1", "0", "", "", "")], "post_id string, created_at_raw string, title string, clean_text string, target string")
    pages = spark.createDataFrame([(1, 1, 1, "{}")], "post_id long, page int, count int, body string")
    assert parses(normalize.normalize_posts(items, "7", "example.com")) == 1
    assert parses(normalize.normalize_replies(items, posts, "7", "example.com", "x")) == 2  # for the post's id, and after the join
    assert parses(scans._comments(pages, "post_id")) == 2  # the page and the item
    states_of = spark.createDataFrame([("{}", "7")], "state string, user_id string")
    assert parses(states.judged_states(states_of)) == 2  # the state and, for each, a gap


def test_pages_are_made_once_for_a_walk(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(s, p, 1, "OK", '{"has_more":%s,"comments":[{"id":%d}]}' % (str(p < 3).lower(), s * 10 + p)) for s in range(4) for p in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "stream long, page int, count int, code string, body string")
    walk = resume_scan.strict_walk(frame.mapInArrow(count, frame.schema), "stream", F.lit(None).cast("string"))
    assert {(r["stream"], r["stop_page"], r["observed"]) for r in walk.streams.collect()} == {(s, 3, 3) for s in range(4)}
    assert made.value == len(rows)


def test_the_items_of_a_page_are_written_as_text_once(spark):
    pages = spark.createDataFrame([(1, 1, 1, '{"items":[1],"comments":[{"id":1},null,"x",2.50]}')], "post_id long, page int, count int, body string")
    items = scans.items_of(pages, ("comments", "items"), "post_id")
    plan = items._jdf.queryExecution().optimizedPlan().toString().lower()
    assert (len(re.findall("to_?json", plan)), len(re.findall("from_?json|jsontostructs|schema_?of_?variant", plan))) == (1, 0)
    assert [(r["pos"], r["item"]) for r in items.orderBy("pos").collect()] == [(0, '{"id":1}'), (2, '"x"'), (3, "2.5")]


def test_bodies_are_not_shuffled_to_judge_pages(spark):
    body = '{"has_more":%s,"comments":[]}'
    pages = spark.createDataFrame([(1, p, 2, body % more) for p, more in ((1, "true"), (1, "true"), (2, "false"), (3, "true"))], "post_id long, page int, count int, body string")
    counted = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "b"), (1, 2, "c"), (1, 3, None)], "post_id long, page int, id string")
    judged = scans.judged(pages, counted, "post_id")
    joins = [line for line in judged._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 1  # was three, with the bodies in two of them
    got = sorted((r["page"], r["complete"], r["violation"], r["observed"]) for r in judged.collect())
    assert got == [(1, False, None, 2), (1, False, None, 2), (2, True, None, 3), (3, False, None, 3)]
    ends = [tuple(r) for r in scans.walk_ends(judged, judged, "post_id").collect()]
    assert ends == [(1, 2, False, 3)]


def test_a_mark_is_read_from_the_parsed_item_and_short_numbers_need_no_lambda(spark):
    from quillfeed.functions import ids, times

    items = spark.createDataFrame([(1, "{}")], "post_id long, item string")
    assert parses(normalize.normalize_posts(items, "7", "example.com", mark=lambda p: p.literal("mark"))) == 1
    rows = ["0", "1", "99999999999", "100000000000", "999999999999999", "9007199254740991", "9007199254740992", "1700000000", "1700000000000", "-1", "4.0", '"12"', "null", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    got = df.select("i", ids.count_from_literal(F.col("x")).alias("n"), times.epoch_ms_from_literal(F.col("x")).alias("e")).orderBy("i").collect()
    assert [r["n"] for r in got] == [0, 1, 99999999999, 100000000000, 999999999999999, 9007199254740991, None, 1700000000, 1700000000000, None, 4, 12, None, None]
    assert [r["e"] for r in got] == [None, None, 99999999999000, None, None if 999999999999999 >= times.END_MS else 999999999999999, None, None, 1700000000000, 1700000000000, None, None, None, None, None]
    link = lambda u, p: ids.canonical_url(F.lit(" "), "example.com", F.lit(u).cast("string"), F.lit(p).cast("string"))
    assert tuple(df.limit(1).select(link("7", "1"), link("7", None), link("", "1"), ids.canonical_url(F.lit(""), "example.com")).collect()[0]) == ("https://example.com/7/1", None, None, None)


def test_the_pages_of_orders_are_made_without_a_join(spark):
    from quillfeed.plans import registry

    found = registry.comment_pages(spark, "/root/testdata/sf0.001")[1]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
