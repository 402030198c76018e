"""Periodic runs: every run of small texts against a plain search, the query's digests, long texts and odd tables."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np

from quillfeed.llm import registry, repeats

SF = "/root/testdata/sf0.001"


def plain_runs(words, min_words=6, min_exponent=4):
    out, n = [], len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = (all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(min_words, min_exponent * q) and not any(smaller):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(250):
        docs = []
        for _ in range(rng.randint(1, 6)):
            letters, n = rng.choice([1, 2, 2, 3, 5, 30]), rng.choice([0, 1, 3, 6, 10, 30, 80])
            words = [rng.randrange(letters) for _ in range(n)]
            if rng.random() < 0.5 and n > 5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 8)
                words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            docs.append(words)
        for bounds in ((6, 4), (2, 2), (4, 3)):
            got = repeats.runs_of([np.array(d, np.int64) for d in docs], *bounds)
            assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(d, *bounds) for d in docs]


def test_words_part_at_ascii_white_space_only():
    text = "a\x0ba\x0ca\ra\ta\na a a a a"
    (runs,), (left,) = repeats.scan_texts([text.encode()])
    assert runs.tolist() == [[0, 6, 1]] and left.decode() == "a a a a a"


def test_overlapping_runs_drop_a_word_once():
    words = b"x x x x x x y x x x x x x y x x x x x x y x x x x x x y".split()
    (runs,), (left,) = repeats.scan_texts([b" ".join(words)])
    assert [tuple(r) for r in runs.tolist()] == plain_runs(words)
    gone = {i for s, n, q in plain_runs(words) for i in range(s + q, s + n)}
    assert left == b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_long_texts_stay_near_linear():
    seconds = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        (runs,), _ = repeats.scan_texts([b"word " * n])
        seconds.append(time.perf_counter() - began)
        assert runs.tolist() == [[0, n, 1]]
    assert seconds[1] < 16 * seconds[0] + 1
    half = b" ".join(b"%d" % i for i in range(30_000))
    assert [len(r) for r in repeats.scan_texts([half + b" " + half])[0]] == [0]
    four = b" ".join([b"%d" % i for i in range(5_000)] * 4)
    assert repeats.scan_texts([four])[0][0].tolist() == [[0, 20_000, 5_000]]


def expected(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    # A plain search that skips periods without any match.
    runs = []
    for q in range(1, n // 4 + 1):
        hits = [i for i in range(n - q) if words[i] == words[i + q]]
        for k, i in enumerate(hits):
            if k and hits[k - 1] == i - 1:
                continue
            j = k
            while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
                j += 1
            length = hits[j] - i + 1 + q
            if length >= max(6, 4 * q) and not any(s <= i and s + m >= i + length and q % r == 0 for s, m, r in runs):
                runs.append((i, length, q))
    runs.sort(key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (
        doc_id, len(runs), *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_query_against_a_plain_search(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 6000]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in registry.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t in short:
        assert got[i] == expected(i, t)
    assert sum(v[1] > 0 for v in got.values()) > 5


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(40))) for i in range(60)]
    rows += [(None, "b b b b b b b"), (None, None), (60, None), (61, ""), (62, " \n"), (63, "a a a a a a"), (63, "a a a a a a"), (64, "einé " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in registry.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [expected(i, t) if i is not None else (None, *expected(3, t)[1:]) for i, t in rows]  # the checksum of 3 leaves a text as it is
    assert zlib.crc32(b"3") % 10 != 0 and sorted(got, key=repr) == sorted(want, key=repr)


def test_operator_on_odd_tables(spark):
    df = spark.createDataFrame([("x", 1, "a b a b a b a b", "r")], "runs string, doc_id int, text string, collapsed string")
    out = repeats.periodic_runs(df)
    assert out.dtypes == [("doc_id", "int"), ("runs", "array<struct<start:bigint,length:bigint,period:bigint>>"), ("collapsed", "string")]
    assert [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()] == [(1, [(0, 8, 2)], "a b")]
    assert repeats.periodic_runs(df.limit(0)).collect() == []


def test_greatest_compares_exactly(spark):
    big = 10**9
    df = spark.createDataFrame([([(0, 4 * big, big), (5, 4 * big + 1, big), (7, 4 * big + 1, big)],), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    assert [r[0] and r[0]["start"] for r in df.select(repeats.greatest(df["runs"])).collect()] == [5, None]
