"""Operators on feed records: golden cases, mutations of a valid record, and random folds against closed forms."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillfeed.operators import classify, contracts, coverage, manifest, merge, normalize, pages, select

POST = {
    "schema_version": 1, "record_contract": "normalized_v1", "id": "101", "created_at_raw": None, "created_at": "unknown", "text": "<p>A&amp;B<br/>C&nbsp;D</p>",
    "clean_text": "A&B\nC D", "target": "https://example.com/7/101", "reply_count": 9, "like_count": 8, "retweet_count": 7, "view_count": 6,
}
REPLY = {
    "schema_version": 1, "record_contract": "normalized_v1", "id": "201", "created_at_raw": 0, "created_at": "unknown", "text": "reply &lt;body&gt;",
    "clean_text": "reply <body>", "post_id": "101", "post_target": "https://example.com/7/101", "reply_count": 3, "like_count": 4,
}


def bodies(spark, records):
    texts = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string").orderBy("i")


def violations(spark, records):
    return [r[0] for r in bodies(spark, records).select(contracts.violations(F.col("body"), "example.com")).collect()]


MUTATIONS = [
    ({"id": 101}, "id"), ({"id": "10x"}, "id"), ({"created_at": "2026-07-14T09:00:00+08:00"}, "created_at"), ({"created_at_raw": "soon"}, "created_at_raw_invalid"),
    ({"created_at_raw": True}, "created_at_raw_kind"), ({"text": 5}, "text_kind"), ({"clean_text": "other"}, "clean_text_differs"), ({"surprise": 1}, "unsupported_field"),
    ({"target": "http://example.com/7/101"}, "target"), ({"target": "https://example.com/7/102"}, "target_id"), ({"reply_count": -1}, "reply_count"),
    ({"like_count": "4"}, "like_count"), ({"view_count": 9007199254740992}, "view_count"), ({"retweet_count": None}, "retweet_count"), ({"schema_version": 2}, "schema_version"),
    ({"record_contract": "other"}, "record_contract"), ({"post_link": "x"}, "post_with_link"), ({"title": None}, "title_kind"), ({"created_ms": -1}, "created_ms"),
    ({"fetched_from_page": 0}, "fetched_from_page"), ({"legacy_migrated_fields": ["a", "a"]}, "legacy_migrated_fields"), ({"legacy_migrated_fields": [""]}, "legacy_migrated_fields"),
    ({"reply_to": 5}, "reply_to"), ({"user_id": None}, "user_id"), ({"post_created_at": "unknown"}, "post_time_pair"),
]


def test_valid_records(spark):
    more = POST | {"created_at_raw": 1752381296000, "created_at": "2025-07-13T12:34:56+08:00", "like_count": 4.0, "reply_to": None, "legacy_migrated_fields": ["a", "b"]}
    assert violations(spark, [POST, REPLY, more]) == [[], [], []]


def test_mutations(spark):
    found = violations(spark, [POST | change for change, _ in MUTATIONS])
    for (change, code), codes in zip(MUTATIONS, found, strict=True):
        assert code in codes, (change, codes)


def test_reply_mutations_and_non_objects(spark):
    found = violations(spark, [REPLY | {"target": "x"}, REPLY | {"post_id": "102"}, REPLY | {"status_id": "9"}, "[]", "nonsense", ""])
    assert "reply_with_target" in found[0]
    assert "post_target_id" in found[1]
    assert "status_id_differs" in found[2]
    assert found[3:] == [["not_an_object"]] * 3


def test_missing_fields(spark):
    for name, code in (("view_count", "view_count"), ("clean_text", "clean_text_kind"), ("created_at_raw", "created_at_raw_missing")):
        assert code in violations(spark, [{k: v for k, v in POST.items() if k != name}])[0]


def test_assert_valid(spark):
    contracts.assert_valid(bodies(spark, [POST, REPLY]), "body", "example.com")
    with pytest.raises(ValueError, match="id x 2"):
        contracts.assert_valid(bodies(spark, [POST | {"id": 1}, POST | {"id": 2}]), "body", "example.com")


def test_upgrade(spark):
    legacy = {"id": 5, "created_at": "2026-07-14 09:00:00", "text": "a<br>b", "target": "/7/5", "reply_count": " 3 ", "like_count": 1, "retweet_count": 0, "view_count": 2, "retweeted_status": {"x": 1}}
    foreign = POST | {"record_contract": "legacy_normalized_v1"}
    rows = bodies(spark, [legacy, {k: v for k, v in POST.items() if k != "record_contract"}, foreign]).select("i", contracts.upgrade(F.col("body"), "example.com").alias("body"))
    got = [json.loads(r["body"]) if r["body"] else None for r in rows.orderBy("i").collect()]
    assert got[0]["id"] == "5" and got[0]["clean_text"] == "a\nb" and got[0]["target"] == "https://example.com/7/5" and got[0]["reply_count"] == 3
    assert got[0]["created_at_raw"] == "2026-07-14 09:00:00" and got[0]["legacy_migrated_fields"] == ["clean_text", "created_at_raw"]
    assert got[1] == POST and got[2] is None


def test_predecessor_reply(spark):
    old = {k: v for k, v in REPLY.items() if k != "record_contract"} | {"post_created_at": "unknown"}
    got = [json.loads(r[0]) for r in bodies(spark, [old, REPLY]).select(contracts.upgrade_predecessor_reply(F.col("body"))).collect()]
    assert got[0]["post_created_at_raw"] == "unknown" and got[0]["legacy_migrated_fields"] == ["post_created_at_raw"]
    assert got[1] == REPLY


def test_report(spark):
    reports = [{"status": "running"}, {"status": "running", "finished_at": "t"}, {"status": "failed", "finished_at": "t"}, {"status": "complete", "finished_at": "t", "interface_drift": {"detected": True, "signals": []}}]
    got = [r[0] for r in bodies(spark, reports).select(contracts.report_violations(F.col("body"))).collect()]
    assert got == [[], ["running_and_finished"], ["failed_without_error"], ["drift_without_signals"]]


PAGES = [  # body, page, count, items, observed -> complete, explicit, violation
    ("{}", 1, 2, 1, 1, True, False, None),
    ("{}", 1, 2, 2, 2, False, False, None),
    ('{"has_more":false}', 1, 2, 2, 2, True, True, None),
    ('{"has_more":true}', 1, 2, 1, 1, False, False, None),
    ('{"next_cursor":"cursor-2"}', 1, 2, 1, 1, False, False, None),
    ('{"next_cursor":"0"}', 1, 2, 2, 2, True, True, None),
    ('{"page":2,"has_more":false,"max_page":"2","total_count":"2"}', 2, 2, 1, 2, True, True, None),
    ('{"has_more":false,"total":2}', 1, 2, 1, 1, False, False, None),
    ('{"has_more":true,"meta":{"hasMore":false}}', 1, 2, 1, 1, None, None, "conflicting_has_more"),
    ('{"page":1,"meta":{"page_no":2}}', 1, 2, 1, 1, None, None, "conflicting_current_page"),
    ('{"meta":[]}', 1, 2, 1, 1, None, None, "invalid_container"),
    ('{"page":{"has_more":0}}', 1, 2, 2, 2, True, True, None),
    ('{"max_page":0}', 1, 2, 1, 1, None, None, "page_count_contradiction"),
    ('{"total":-1}', 1, 2, 1, 1, None, None, "invalid_total"),
    ('{"has_more":"maybe"}', 1, 2, 1, 1, None, None, "invalid_has_more"),
    ('{"next":null}', 1, 2, 2, 2, True, True, None),
    ('{"page":3}', 1, 2, 1, 1, None, None, "wrong_page"),
    ("{}", 1, 2, 3, 3, None, None, "too_many_items"),
    ("[]", 1, 2, 1, 1, None, None, "not_an_object"),
]


def test_pagination(spark):
    rows = spark.createDataFrame([(i, *p[:5]) for i, p in enumerate(PAGES)], "i int, body string, page int, count int, items int, observed int")
    d = pages.pagination_decision(*(F.col(c) for c in ("body", "page", "count", "items", "observed")))
    got = [tuple(r["d"]) for r in rows.select("i", d.alias("d")).orderBy("i").collect()]
    assert got == [p[5:] for p in PAGES]


def test_pins(spark):
    rows = [(1, 1, i, 1 if i == 0 else 0) for i in range(3)] + [(1, 2, 10 + i, 0) for i in range(3)] + [(2, 1, 20 + i, 1) for i in range(2)]
    df = spark.createDataFrame(rows, "stream int, page int, id int, mark int").withColumn("count", F.lit(2))
    got = {(r["stream"], r["id"]): (r["pageable"], r["violation"]) for r in pages.pinned_rows(df, ["stream"], "page", "count").collect()}
    assert got[1, 0] == (False, None) and got[1, 1] == (True, None)
    assert got[1, 10] == (None, "unexplained_overflow") and got[2, 20] == (True, None)


def boundary_fold(feed, since):
    """The page-by-page rule, as a plain loop."""
    ordered, last, candidate, out = True, None, False, []
    for page in feed:
        for epoch in page:
            if epoch is None or (last is not None and epoch > last):
                ordered = False
            last = epoch if epoch is not None else last
        older = [e is not None and e < since for e in page]
        confirmed = candidate and ordered and bool(page) and all(older)
        candidate = ordered and any(older)
        out.append((candidate, confirmed))
    return out


def test_since_boundary_property(spark):
    rng = random.Random(5)
    feeds = []
    for _ in range(300):
        start, feed = 20, []
        for _ in range(rng.randint(1, 5)):
            page = []
            for _ in range(rng.randint(0, 3)):
                start -= rng.choice([0, 1, 2, 3, -1 if rng.random() < 0.1 else 1])
                page.append(None if rng.random() < 0.03 else start)
            feed.append(page)
        feeds.append(feed)
    rows = [(s, p, i, e) for s, feed in enumerate(feeds) for p, page in enumerate(feed) for i, e in enumerate(page)]
    spine = spark.createDataFrame([(s, p) for s, feed in enumerate(feeds) for p in range(len(feed))], "s int, p int")
    got = {(r["s"], r["p"]): (r["candidate"], r["confirmed"]) for r in pages.since_boundary(spark.createDataFrame(rows, "s int, p int, i int, e long"), "s", "p", "i", "e", 10, spine).collect()}
    want = {(s, p): x for s, feed in enumerate(feeds) for p, x in enumerate(boundary_fold(feed, 10))}
    assert got == want


def test_running_observed_with_empty_pages(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 3, "x"), ("a", 3, "z")], "s string, p int, id string")
    spine = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "s string, p int")
    got = sorted(tuple(r) for r in pages.running_observed(rows, "s", "p", "id", spine).collect())
    assert got == [("a", 1, 2), ("a", 2, 2), ("a", 3, 3)]


def test_explode_items_and_walk(spark):
    df = spark.createDataFrame([("s", 1, '{"list":[{"id":1},{"id":2}]}'), ("s", 2, '{"list":[]}'), ("s", 3, "oops")], "stream string, page int, body string")
    got = [(r["page"], r["pos"], r["item"], r["violation"]) for r in pages.explode_items(df, pages.TIMELINE_ITEMS).orderBy("page", "pos").collect()]
    assert got == [(1, 0, '{"id":1}', None), (1, 1, '{"id":2}', None), (2, None, None, None), (3, None, None, "not_an_object")]
    stops = pages.stop_pages(df, "stream", "page", F.col("page") == 2)
    assert sorted(r["page"] for r in pages.walked(df, stops, "stream", "page").collect()) == [1, 2]


def fold(versions):
    """The pairwise merge rule, as a plain loop; None where a version conflicts."""
    now = dict(versions[0])
    size = lambda s: len(s.strip(" \t\n\x0b\f\r").encode())
    for v in versions[1:]:
        if now["url"] != v["url"] or (now["reply_to"] and v["reply_to"] and now["reply_to"] != v["reply_to"]):
            return None
        if now["created_at"] != "unknown" and v["created_at"] != "unknown" and now["created_at"] != v["created_at"]:
            return None
        new = {k: now[k] if v[k] is None else v[k] for k in v}
        if now["created_at"] != "unknown" and v["created_at"] == "unknown":
            new |= {k: now[k] for k in ("created_at", "created_at_raw")}
        if size(v["text"]) + size(v["clean_text"]) < size(now["text"]) + size(now["clean_text"]):
            new |= {k: now[k] for k in ("text", "clean_text")}
        if now["title"] is not None and v["title"] is not None and size(v["title"]) < size(now["title"]):
            new["title"] = now["title"]
        now = new
    return now


def test_merge_property(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for key in range(400):
        versions = []
        for seq in range(rng.randint(1, 5)):
            known = rng.random() < 0.5
            versions.append({
                "id": key, "seq": seq, "url": "u" if rng.random() < 0.97 else "v", "reply_to": rng.choice([None, None, "1", "1", "2" if rng.random() < 0.1 else "1"]),
                "created_at": rng.choice(["t", "t", "t", "w" if rng.random() < 0.1 else "t"]) if known else "unknown", "created_at_raw": f"r{seq}" if known or rng.random() < 0.5 else None,
                "text": "x" * rng.randint(0, 3) + " " * rng.randint(0, 2), "clean_text": "é" * rng.randint(0, 2), "title": rng.choice([None, "a", "bb", "cc "]), "like_count": rng.choice([None, 1, 2, 3]),
            })
        merged = fold(versions)
        want[key] = None if merged is None else {k: v for k, v in merged.items() if k != "seq"}
        rows += versions
    rng.shuffle(rows)
    names = ["id", "seq", "url", "reply_to", "created_at", "created_at_raw", "text", "clean_text", "title", "like_count"]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], "id int, seq long, url string, reply_to string, created_at string, created_at_raw string, text string, clean_text string, title string, like_count long")
    out = merge.merge_versions(df, "id", "seq", merge.RECORD_RULES)
    for r in out.collect():
        got = None if r["conflicts"] else {n: r[n] for n in names if n != "seq"}
        assert got == want[r["id"]], r
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_total_order(spark):
    df = spark.createDataFrame([("9", 5), ("10", 5), ("2", 5), ("7", None), ("1", 9)], "id string, epoch_ms long")
    assert [r["id"] for r in df.orderBy(*merge.total_order()).collect()] == ["1", "10", "9", "2", "7"]
    assert [r["id"] for r in merge.latest(df).collect()] == ["1"]


def test_unique_and_sets(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(ValueError):
        merge.require_unique(df, "k")
    assert sorted((r["k"], r["v"]) for r in merge.first_wins(df.filter("k = 2"), df, "k").collect()) == [(1, "a"), (1, "b"), (2, "c")]


def test_gaps(spark):
    gaps = lambda rows: spark.createDataFrame(rows, "post_id string, n int")
    posts = lambda *x: spark.createDataFrame([(i,) for i in x], "post_id string")
    out = merge.reconcile_gaps(gaps([("1", 1), ("2", 1), ("3", 1)]), gaps([("2", 9)]), posts("2", "3"), posts("1", "2", "3"))
    assert sorted(tuple(r) for r in out.collect()) == [("1", 1), ("2", 9)]
    with pytest.raises(ValueError):
        merge.reconcile_gaps(gaps([]), gaps([("9", 1)]), posts("2"), posts("9"))


def test_selection(spark):
    posts = spark.createDataFrame([("1", 0, 5), ("2", 1, 5), ("3", 2, 5), ("4", 3, 5)], "post_id string, position int, reply_count long")
    state = spark.createDataFrame([("1", 5), ("2", 9)], "post_id string, reply_count long")
    assert sorted(r["post_id"] for r in select.changed_posts(posts, state, "position", "reply_count", 3).collect()) == ["2", "3"]
    assert len(select.changed_posts(posts, state, "position", "reply_count", 3, force=True).collect()) == 3
    after = select.advance_checkpoint(state, posts, posts.filter("post_id in ('2', '4')"), "position", "reply_count", 3)
    assert sorted(tuple(r) for r in after.collect()) == [("1", 5), ("2", 5)]


def test_recent_posts(spark):
    df = spark.createDataFrame([("1", 10 * 86_400_000), ("2", 30 * 86_400_000), ("3", None)], "post_id string, epoch_ms long")
    assert [r["post_id"] for r in select.recent_posts(df, 31 * 86_400_000, 5, 9).collect()] == ["2"]
    assert sorted(r["post_id"] for r in select.recent_posts(df, 99 * 86_400_000, 5, 2).collect()) == ["1", "2"]


def test_digest_depends_on_order_only(spark):
    df = spark.createDataFrame([("s", i, f"v{i}") for i in range(50)], "s string, i int, v string")
    digest = lambda d, block=7: select.ordered_digest(d, "s", ["i"], "i", "v", block=block).first()["digest"]
    assert digest(df) == digest(df.repartition(5)) and digest(df) != digest(df.filter("i <> 3"))


def test_checkpoint_state():
    state = select.initial_checkpoint("7")
    assert select.checkpoint_violations(state, "7") == []
    assert select.checkpoint_violations(state, "8") == ["user_id"]
    assert select.checkpoint_violations(state | {"post_reply_counts": {"x": 1}}, "7") == ["post_reply_counts"]
    assert select.checkpoint_for({k: v for k, v in state.items() if k != "user_id"}, "9")["user_id"] == "9"
    gap = {"post_id": "1", "declared_count": 2, "visible_count": 1, "unavailable_count": 1, "count_source": "timeline"}
    assert select.gap_is_valid(gap) and not select.gap_is_valid(gap | {"visible_count": 2}) and not select.gap_is_valid(gap | {"more": 1})


def test_coverage(spark):
    seen = [("1", 1, "a", True, True, 2), ("2", 1, None, True, False, None), ("3", 1, "a", True, True, None), ("4", 1, "a", False, False, None)]
    rows = spark.createDataFrame(seen, "post_id string, page int, comment_id string, complete boolean, explicit boolean, endpoint_count long")
    posts = spark.createDataFrame([("1", 5), ("2", 1), ("3", 1), ("4", 1)], "post_id string, reply_count long")
    got = {r["post_id"]: (r["declared"], r["observed"], r["truncated"], r["unverified"], r["gap"]) for r in coverage.coverage(rows, posts).collect()}
    assert got["1"][:4] == (2, 1, False, False) and tuple(got["1"][4]) == (2, 1, 1, "comment_endpoint_final_page")
    assert got["2"] == (1, 0, False, True, None) and got["3"] == (1, 1, False, False, None) and got["4"][2] is True
    summary = coverage.summary(coverage.coverage(rows, posts), 4).first()
    assert (summary["coverage"], summary["status"], summary["exit_code"]) == ("partial_page_limit", "needs_verification", 2)
    empty = coverage.summary(coverage.coverage(rows.limit(0), posts), 0).first()
    assert (empty["coverage"], empty["exit_code"]) == ("changed_posts_main_stream_complete", 0)


def test_classify(spark):
    cases = [
        (200, "application/json", '{"a":1}', "OK"), (200, "text/html", "{}", "WAF"), (200, "", '{"_waf_":1}', "WAF"), (400, "application/json", "10020", "API_10020"),
        (404, "", "x", "HTTP_404"), (500, "", '{"error_code":22}', "API_22"), (200, "", "captcha", "WAF"), (200, "application/json", "captcha", "INVALID_JSON"),
        (200, "application/json", '{"error_code":"9"}', "API_9"), (200, "application/json", '{"error_code":0}', "OK"), (None, "", "{}", "HTTP_undefined"), (200, None, None, "INVALID_JSON"),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, s int, k string, b string").orderBy("i")
    assert [r[0] for r in df.select(classify.json_code(F.col("s"), F.col("k"), F.col("b"))).collect()] == [c[3] for c in cases]


def test_normalize(spark):
    raw = {"id": 5, "created_at": 1752381296000, "description": "<p>hi</p>", "rawTitle": "T", "reply_count": "3", "likeCount": 4, "retweet_count": 0, "view_count": 1}
    rows = bodies(spark, [raw, raw | {"id": "x"}, raw | {"created_at": "soon"}, raw | {"schema_version": 1}]).withColumnRenamed("body", "item")
    got = normalize.normalize_posts(rows, "7", "example.com").orderBy("i").collect()
    assert (got[0]["id"], got[0]["clean_text"], got[0]["title"], got[0]["target"], got[0]["violations"]) == ("5", "hi", "T", "https://example.com/7/5", [])
    assert set(got[1]["violations"]) >= {"id"} and got[2]["violations"] == ["created_at"] and got[3]["violations"] == ["markers"]


def test_threads(spark):
    roots = spark.createDataFrame([("1", "p")], "id string, post_id string")
    nested = spark.createDataFrame([("2", "1"), ("3", "9")], "id string, root_comment_id string")
    assert sorted((r["id"], r["root_post_id"]) for r in normalize.threads(roots, nested).collect()) == [("2", "p"), ("3", None)]


def test_manifest(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 3, 1)], "s string, k int, t int")
    first = {r["segment"]: r["digest"] for r in manifest.segments(df, F.col("s"), "k", "t").collect()}
    again = {r["segment"]: r["digest"] for r in manifest.segments(df.orderBy(F.desc("k")).repartition(3), F.col("s"), "k", "t").collect()}
    assert first == again and first["a"] != first["b"]
    rows = bodies(spark, [{"a": 1, "generated_at": 5}, {"generated_at": 9, "a": 1}, {"a": 2}])
    digests = [r[0] for r in rows.select(manifest.semantic_digest(F.col("body"), "generated_at")).collect()]
    assert digests[0] == digests[1] != digests[2]
    text = bodies(spark, ["in 2840 ways", "in 12840", "2840.5"])
    assert [r[0] for r in text.select(manifest.has_exact_number(F.col("body"), "2840")).collect()] == [True, False, True]


def test_replies_take_an_embedded_post(spark):
    posts = spark.createDataFrame([("1", "null", "T", "body", "https://example.com/7/1")], "post_id string, created_at_raw string, title string, clean_text string, target string")
    base = {"id": 9, "created_at": 0, "text": "r", "like_count": 0, "reply_count": 0, "user_id": 7}
    rows = bodies(spark, [base | {"status_id": 1}, base | {"status": {"id": 2, "title": "<b>In</b>", "text": "side<br>", "created_at": 1752381296}}, base]).withColumnRenamed("body", "item")
    got = normalize.normalize_replies(rows, posts, "7", "example.com", "user_comments").orderBy("i").collect()
    assert (got[0]["post_title"], got[0]["post_text"], got[0]["violations"]) == ("T", "body", [])
    assert (got[1]["post_id"], got[1]["post_title"], got[1]["post_text"], got[1]["post_target"]) == ("2", "In", "side", "https://example.com/7/2")
    assert got[1]["post_created_at"] == "2025-07-13T12:34:56+08:00" and got[1]["violations"] == []
    assert "post_id" in got[2]["violations"]


LEGACY_POST = {"id": 5, "created_at": "2026-07-14 09:00:00", "text": "a<br>b", "target": "/7/5", "reply_count": " 3 ", "like_count": 1, "retweet_count": 0, "view_count": 2}
LEGACY_REPLY = {"id": "6", "created_at": None, "clean_text": "c", "post_id": 5, "post_link": "https://www.example.com/7/5", "like_count": "2", "status_id": None}


def recover(spark, records):
    from quillfeed.operators import recovery

    rows = bodies(spark, records).select("i", recovery.recover(F.col("body"), "7", "example.com").alias("r")).orderBy("i").collect()
    return [(r["r"]["route"], json.loads(r["r"]["record"]) if r["r"]["record"] else None, r["r"]["violations"]) for r in rows]


def test_recovery(spark):
    got = recover(spark, [LEGACY_POST, LEGACY_REPLY, POST])
    assert [g[0] for g in got] == ["legacy", "legacy", "strict"] and all(g[2] == [] for g in got), got
    assert got[0][1]["id"] == "5" and got[0][1]["reply_count"] == 3 and got[0][1]["created_at"] == "2026-07-14T09:00:00+08:00" and got[0][1]["created_at_raw"] == "2026-07-14 09:00:00"
    assert got[1][1]["post_target"] == "https://www.example.com/7/5" and got[1][1]["created_at"] == "unknown" and "post_link" not in got[1][1]
    again = recover(spark, [got[0][1], got[1][1]])
    assert [(g[0], g[1]) for g in again] == [("declared", got[0][1]), ("declared", got[1][1])]


def test_recovery_violations(spark):
    declared = recover(spark, [LEGACY_POST])[0][1]
    cases = [
        (LEGACY_POST | {"extra": 1}, "unsupported_field"), (LEGACY_POST | {"created_at": "later"}, "created_at"), (LEGACY_POST | {"target": "/7/6"}, "target"),
        (LEGACY_POST | {"clean_text": "other"}, "clean_text"), ({k: v for k, v in LEGACY_POST.items() if k != "view_count"}, "view_count"),
        (LEGACY_REPLY | {"post_target": "/7/5"}, "post_target"), (LEGACY_REPLY | {"status_id": "9"}, "status_id_differs"), (LEGACY_REPLY | {"fetched_from_page": 0}, "fetched_from_page"),
        (declared | {"id": 5}, "id"), (declared | {"like_count": "1"}, "like_count"), (declared | {"target": "/7/5"}, "target"), (POST | {"record_contract": "other"}, "record_contract"), ("[]", "not_an_object"),
    ]
    for (record, code), (_, out, found) in zip(cases, recover(spark, [c[0] for c in cases]), strict=True):
        assert code in found and out is None, (record, found)


def test_options():
    from quillfeed.functions import options

    assert options.integer(" 5 ", "n") == 5 and options.integer(None, "n", 3) == 3 and options.number("0.5", "x") == 0.5 and options.user(None, "7") == "7"
    for wrong in (lambda: options.integer("5.0", "n"), lambda: options.integer(True, "n"), lambda: options.integer(-1, "n"), lambda: options.number("nan", "x"), lambda: options.date("2024-02-30"), lambda: options.user("x7"), lambda: options.integer(None, "n")):
        with pytest.raises(ValueError):
            wrong()
    assert options.parse(["--a", "1", "--b", "--c=x=y"], ["a", "b", "c"], ["b"]) == {"a": "1", "b": True, "c": "x=y"}
    assert options.parse(["--b", "false"], ["b"], ["b"]) == {"b": False}
    for wrong in (["--z", "1"], ["--a", "1", "--a", "2"], ["stray"], ["--a"], ["--b=maybe"]):
        with pytest.raises(ValueError):
            options.parse(wrong, ["a", "b"], ["b"])


def test_corpus_record(spark):
    import json

    raw = {
        "id": 123, "created_at": "2026-07-14 09:08:07", "target": "/7/123", "reply_count": "4", "post_id": 456,
        "post_created_at": "2026-07-14 08:00:00", "in_reply_to_comment_id": None,
    }
    bodies = [
        raw, {"id": "124", "created_at": "unknown", "target": "/7/124"}, raw | {"record_contract": "legacy_normalized_v1"}, raw | {"reply_count": True},
        raw | {"reply_count": ""}, raw | {"created_at": "2026-07-14"}, {"created_at": 0}, [1], raw | {"surprise": 1},
    ]
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    got = [r["r"] for r in df.select(contracts.corpus_record(F.col("body"), "example.com").alias("r")).collect()]
    assert json.loads(got[0]["record"]) == {
        "schema_version": 1, "record_contract": "normalized_v1", "id": "123", "created_at_raw": "2026-07-14 09:08:07", "created_at": "2026-07-14T09:08:07+08:00",
        "target": "https://example.com/7/123", "reply_count": 4, "post_id": "456", "post_created_at_raw": "2026-07-14 08:00:00",
        "post_created_at": "2026-07-14T08:00:00+08:00", "in_reply_to_comment_id": None,
    }
    assert (json.loads(got[1]["record"])["created_at"], json.loads(got[1]["record"])["created_at_raw"]) == ("unknown", "unknown")
    assert [r["violations"] for r in got[2:]] == [["record_contract"], ["reply_count"], ["reply_count"], ["created_at"], ["id"], ["not_an_object"], ["unsupported_field"]]
    legacy = df.limit(3).select(contracts.corpus_record(F.col("body"), "example.com", "legacy_normalized_v1").alias("r")).collect()
    assert [json.loads(r["r"]["record"])["record_contract"] for r in legacy] == ["legacy_normalized_v1"] * 3
    again = spark.createDataFrame([(r["record"],) for r in got[:2]], "body string").select(contracts.corpus_record(F.col("body"), "example.com").alias("r"))
    assert [r["r"]["record"] for r in again.collect()] == [r["record"] for r in got[:2]]
