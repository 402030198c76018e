"""Scalar rules, with cases that are computed by hand or by an independent Python form."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillfeed.functions import ids, payload, text, times


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_clean_html(spark):
    cases = [
        ("<p>A&amp;B<br/>C&nbsp;D</p><p>&lt;x&gt; &quot;q&quot; &#39;s&#39;</p>", "A&B\nC D\n<x> \"q\" 's'"),
        ("one<br><br><br><br>two", "one\n\ntwo"),
        ("&amp;lt;", "&lt;"),
        ("", ""),
        ("  x\u0085 ", " x\u0085"),
        (None, None),
    ]
    assert values(spark, [c[0] for c in cases], text.clean_html) == [c[1] for c in cases]


def test_trimmed_length(spark):
    assert values(spark, [" é\t", None, "", "\x0bab\x0c"], text.utf8_trimmed_length) == [2, 0, 0, 2]


def ms(y, mo, d, h=0, mi=0, s=0, extra=0, offset=8):
    moment = datetime.datetime(y, mo, d, h, mi, s) - datetime.timedelta(hours=offset)
    return int((moment - datetime.datetime(1970, 1, 1)).total_seconds() * 1000) + extra


def test_epoch_from_text(spark):
    cases = [
        ("2026-07-14 09:00:00", ms(2026, 7, 14, 9)),
        ("2026-07-14T09:00:00.5Z", ms(2026, 7, 14, 9, extra=500, offset=0)),
        ("2026-07-14T09:00:00+23:59", ms(2026, 7, 14, 9, offset=0) - (23 * 60 + 59) * 60000),
        ("2026-07-14T09:00:00-01:30", ms(2026, 7, 14, 9, offset=0) + 90 * 60000),
        ("2026-07-14T09:00:00+24:00", None),
        ("2026-02-29 00:00:00", None),
        ("2028-02-29 00:00:00", ms(2028, 2, 29)),
        ("2026-07-14", None),
        ("2026-07-14 09:00", None),
        ("2026-07-14 09:00:60", None),
        ("2026-07-14 24:00:00", None),
        ("1999-12-31 23:59:59", None),
        ("2026-07-14T09:00:00.1234", None),
        (" 1752381296 ", 1752381296000),
        ("1752381296000", 1752381296000),
        ("0", None),
        ("unknown", None),
        ("", None),
        (None, None),
        ("２０２６-07-14 09:00:00", None),
        ("2026-07-14 09:00:00\n", ms(2026, 7, 14, 9)),
        ("1" * 400, None),
    ]
    assert values(spark, [c[0] for c in cases], times.epoch_ms_from_text) == [c[1] for c in cases]


def test_literals_and_format(spark):
    literals = ["1752381296000", "1752381296.5", '"2026-07-14 09:00:00"', "null", "0", "-5", '" Unknown "', '"未知时间"', '"later"', None]
    got = values(spark, literals, lambda x: times.format_epoch_ms(times.epoch_ms_from_literal(x)))
    assert got == ["2025-07-13T12:34:56+08:00", "2025-07-13T12:34:56+08:00", "2026-07-14T09:00:00+08:00", *["unknown"] * 7]
    unknown = values(spark, literals, times.is_unknown_literal)
    assert unknown == [False, False, False, True, True, False, True, True, False, None]


def test_format_does_not_use_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert values(spark, [1752381296000], times.format_epoch_ms, "long") == ["2025-07-13T12:34:56+08:00"]
            assert values(spark, ["2026-07-14 09:00:00"], times.epoch_ms_from_text) == [ms(2026, 7, 14, 9)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_since_cutoff():
    assert times.since_cutoff_ms("2024-01-15") == ms(2024, 1, 15)
    for wrong in ("2024-1-15", "2024-02-30", "15.01.2024", "2024-01-15\n"):
        with pytest.raises(ValueError):
            times.since_cutoff_ms(wrong)


def test_ids_and_counts(spark):
    assert values(spark, ["12", " 12", "", "1\n", "١", None], ids.strict_id) == ["12", None, None, None, None, None]
    assert values(spark, [" 12\t", "x"], ids.loose_id) == ["12", None]
    literals = ["4", "4.0", "4.5", "-1", '" 4 "', '"4.0"', '"+4"', '""', "true", "null", "9007199254740991", "9007199254740992", '"9007199254740992"', None]
    want = [4, 4, None, None, 4, None, None, None, None, None, 9007199254740991, None, None, None]
    assert values(spark, literals, ids.count_from_literal) == want


def test_canonical_url(spark):
    cases = [
        ("/7/101", "https://example.com/7/101"),
        ("7/101", "https://example.com/7/101"),
        ("//www.example.com/7/101", "https://www.example.com/7/101"),
        ("http://EXAMPLE.com/7/101?source=a#x", "https://example.com/7/101?source=a#x"),
        ("https://example.com:443/7/101", "https://example.com/7/101"),
        ("https://example.com:8443/7/101", None),
        ("https://user@example.com/7/101", None),
        ("https://example.com.evil.org/7/101", None),
        ("https://badexample.com/7/101", None),
        ("javascript:alert(1)", None),
        ("ftp://example.com/7", None),
        ("", None),
        (None, None),
    ]
    assert values(spark, [c[0] for c in cases], lambda x: ids.canonical_url(x, "example.com")) == [c[1] for c in cases]
    exact = values(spark, ["", "/7/101", "/7/102", "/7/101/"], lambda x: ids.canonical_url(x, "example.com", F.lit("7"), F.lit("101")))
    assert exact == ["https://example.com/7/101", "https://example.com/7/101", None, "https://example.com/7/101/"]


def test_payload_presence(spark):
    rows = ['{"a":null,"b":1}', '{"b":2}', "not json", '{"a":{"c":"x"}}', None]
    p = lambda x: payload.Payload(x)
    assert values(spark, rows, lambda x: p(x).has("a")) == [True, False, False, True, False]
    assert values(spark, rows, lambda x: p(x).literal("a")) == ["null", None, None, '{"c":"x"}', None]
    assert values(spark, rows, lambda x: p(x).kind("a")) == ["null", None, None, "object", None]
    assert values(spark, rows, lambda x: p(x).preferred("a", "b")) == ["null", "2", None, '{"c":"x"}', None]
    assert values(spark, rows, lambda x: p(x).first_present("a", "b")) == ["1", "2", None, '{"c":"x"}', None]
    assert values(spark, rows, lambda x: p(x).text("a.c")) == [None, None, None, "x", None]


def test_array_field(spark):
    rows = ['{"list":[1,2]}', '{"statuses":5,"list":[1]}', "{}", "[]", "x", '{"items":[]}']
    items = values(spark, rows, lambda x: payload.array_field(x, "statuses", "list", "items")[0])
    wrong = values(spark, rows, lambda x: payload.array_field(x, "statuses", "list", "items")[1])
    assert items == ["[1,2]", None, None, None, None, "[]"]
    assert wrong == [None, "not_an_array", "missing_array", "not_an_object", "not_an_object", None]


def test_embedded_json(spark):
    rows = ['<script>window.STATE = {"a":{"b":1}};\n</script>', "<p>none</p>", "window.STATE = {broken};"]
    assert values(spark, rows, lambda x: payload.embedded_json(x, "window.STATE")) == ['{"a":{"b":1}}', None, None]
