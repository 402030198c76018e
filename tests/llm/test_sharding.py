"""Sharding against its law: exact sizes, gapless slots, uniformity, stability."""

import zlib
from collections import Counter

import numpy as np

from quillfeed.llm import sharding

SCHEMA = "doc_id long, text string, shard string"


def table(spark, n, parts=5):
    rows = [(i, None if i % 50 == 0 else "" if i % 51 == 0 else f"tëxt {i % 97}", "clash") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_matrix_margins_and_law():
    sizes = sharding.shard_sizes(1003, 24)
    matrix = sharding.communication_matrix([500, 3, 0, 500], sizes, seed=1)
    assert matrix.sum(axis=0).tolist() == sizes.tolist() and matrix.sum(axis=1).tolist() == [500, 3, 0, 500]
    draws = np.array([sharding.communication_matrix([40, 60], np.array([50, 50]), seed=s)[0, 0] for s in range(3000)])
    # Hypergeometric: mean 20, variance 40 * 60 * 50 * 50 / (100^2 * 99)
    assert abs(draws.mean() - 20) < 0.25 and abs(draws.var() - 40 * 60 * 2500 / (10_000 * 99)) < 0.6


def test_draws_beyond_the_range_of_numpy():
    rng = np.random.default_rng(2)
    # Where numpy draws too, both follow the same law: all four foldings, and the short loop.
    for good, bad, draws in ((300, 700, 200), (700, 300, 200), (300, 700, 850), (700, 300, 850), (60, 20_000, 9000), (5, 900, 300)):
        own = np.array([sharding._large_hypergeometric(rng, good, bad, draws) for _ in range(4000)])
        theirs = rng.hypergeometric(good, bad, draws, 4000)
        edges = np.unique(np.quantile(theirs, np.linspace(0, 1, 12)))
        a, b = (np.histogram(x, [-1, *edges, good + 1])[0].astype(float) for x in (own, theirs))
        chi = ((a - b) ** 2 / np.maximum(a + b, 1)).sum()
        assert chi < 3 * len(a) + 12, (good, bad, draws, chi)
        assert own.min() >= max(0, draws - bad) and own.max() <= min(good, draws)
    good, bad, draws = 3_000_000_000, 47_000_000_000, 2_000_000_000
    own = np.array([sharding._large_hypergeometric(rng, good, bad, draws) for _ in range(2000)], dtype=float)
    total = good + bad
    variance = draws * (good / total) * (bad / total) * (total - draws) / (total - 1)
    assert abs(own.mean() - draws * good / total) < 5 * (variance / 2000) ** 0.5 and 0.85 < own.var() / variance < 1.15
    got = sharding._multivariate(rng, np.full(24, 4_000_000_000), 30_000_000_000)
    assert got.sum() == 30_000_000_000 and np.abs(got - 1_250_000_000).max() < 300_000


def test_rows_of_the_matrix_add_up_on_many_partitions():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 400, 1000).tolist()
    sizes = sharding.shard_sizes(sum(counts), 24)
    matrix = sharding.communication_matrix(counts, sizes, seed=4)
    assert (matrix >= 0).all() and matrix.sum(axis=0).tolist() == sizes.tolist() and matrix.sum(axis=1).tolist() == counts
    expected = np.outer(counts, sizes) / sum(counts)
    assert ((matrix - expected) ** 2 / np.maximum(expected, 1e-9)).sum() < 1.1 * 999 * 23


def test_rows_law(spark):
    df = table(spark, 1000)
    rows = sharding.shard(df, shards=24).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 1000 and set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "rows" and r["grown_shard"] is None


def test_uniform(spark):
    """Over seeds, a row reaches every shard and slot alike."""
    df = table(spark, 48).cache()
    hits = Counter((r["shard"], r["slot"]) for seed in range(40) for r in sharding.shard(df, shards=4, seed=seed).filter("doc_id = 7").collect())
    shards = Counter(s for s, _ in hits.elements())
    assert set(shards) == {0, 1, 2, 3} and max(shards.values()) < 22 and len({slot for _, slot in hits}) > 8


def test_many_partitions(spark):
    rows = sharding.shard(table(spark, 2000, parts=150), shards=24).select("shard", "slot").collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sum(sizes.values()) == 2000 and max(sizes.values()) - min(sizes.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, k) for s, n in sizes.items() for k in range(n)}


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.shard(empty).collect() == []
    same = spark.createDataFrame([(1, "a", "x")] * 10 + [(None, None, None)], SCHEMA)
    rows = sharding.shard(same, shards=3).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [3, 4, 4]
