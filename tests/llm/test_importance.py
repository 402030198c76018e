"""Importance resampling against a plain computation; the matrix; long texts in pieces; odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from quillfeed.llm import importance, registry

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id n_features weight score rank".split()


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, longest=2):
    w = words_of(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, buckets=10_000, min_words=20, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    have = {k: [bucket(f) for f in features(t)] for k, (_, t) in enumerate(docs)}
    s, t = Counter(b for v in have.values() for b in v), Counter(bucket(f) for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for k, (doc_id, text) in enumerate(docs):
        weight = sum(gain[b] for b in have[k]) // len(have[k]) if have[k] else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(have[k]), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    asked = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(asked[: percent * len(asked) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in rows]


def test_query_against_a_plain_computation(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in registry.op12_importance(spark, SF).collect()]
    assert sorted(got) == sorted(plain(docs, target)) and sum(r[4] is not None for r in got) > 20


def odd_rows(rng):
    word = lambda: "".join(rng.choice("abcÄéß漢0-9.,Z ") for _ in range(rng.randint(1, 6)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 60])))) for i in range(120)]
    return [*rows, (None, None), (120, None), (121, ""), (122, "?!"), (-5, "x " * 30), (10**12, "YES no " * 40)]


def test_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    rows, target = odd_rows(rng), ["yes no maybe", None, "", "abc 0 9 é"]
    spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, weight double").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(t,) for t in target], "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in registry.op12_importance(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, target), key=repr)


def test_empty_tables(spark):
    docs, target = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert importance.resample(docs, target).documents.collect() == []
    some = spark.createDataFrame([(1, "a b c " * 10), (2, "a b c " * 10)], "doc_id long, text string")
    got = importance.resample(some, target, percent=50).documents.orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_words"], r["n_features"]) for r in got] == [(1, 30, 59), (2, 30, 59)]
    assert sorted(r["rank"] for r in got if r["rank"]) == [1]


def test_repeated_rows_share_ranks(spark):
    """A third of all rows are the same row: each has a rank of its own, and they stand side by side."""
    rows = [(7, "same words here " * 8)] * 100 + [(i, f"word{i} " * 25) for i in range(1000, 1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = importance.resample(df, spark.createDataFrame([("same words",)], "text string"), percent=100).documents.collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 301))
    ordered = sorted(got, key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in ordered] == sorted((-r["score"], r["doc_id"]) for r in got)
    own = [r["rank"] for r in ordered if r["doc_id"] == 7]
    assert own == list(range(own[0], own[0] + 100))


def test_long_texts_are_counted_in_pieces():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 40))) for _ in range(3000)).encode()
    for longest in (1, 2, 3, 4):
        whole = importance.count_text(text, 1000, longest)
        for limit in (10, 64, 1000, 50_000):
            part = importance.count_text(text, 1000, longest, limit)
            assert part[0] == whole[0] and np.array_equal(part[1], whole[1]) and np.array_equal(part[2], whole[2])
        want = Counter(zlib.crc32(f.encode()) % 1000 for f in features(text.decode(), longest))
        assert dict(zip(whole[1].tolist(), whole[2].tolist(), strict=True)) == want


def test_matrix_is_sparse_rows_in_blocks(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, "c")], "doc_id long, text string").coalesce(1)
    (block,) = importance.count_matrix(docs, buckets=50).collect()
    assert block["ids"] == [1, 2, 3] and block["words"] == [3, 0, 1]
    rows = [dict(zip(block["buckets"][a:b], block["counts"][a:b], strict=True)) for a, b in zip(block["starts"], block["starts"][1:], strict=False)]
    assert rows == [dict(Counter(zlib.crc32(f.encode()) % 50 for f in features(t))) for t in ("a b a", "", "c")]
    sums = importance.column_sums(importance.count_matrix(docs.repartition(3), buckets=50), 50)
    assert sums.sum() == 6 and sums[zlib.crc32(b"c") % 50] >= 1
