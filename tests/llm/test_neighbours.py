"""Nearest neighbours: recall and exact scores against brute force, equal vectors, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillfeed.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault((i, tuple(v)), None)
    out = {}
    for q, v in ok:
        if q % every:
            continue
        a = np.array(v, dtype=np.float32).astype(float)
        hits = sorted((-float((a * np.array(w, dtype=np.float32).astype(float)).sum()), i) for i, w in ok if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in hits[:k]]
    return out


def search(spark, rows):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)
    out = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


def vectors(kind, n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    if kind == "clustered":
        x = rng.standard_normal((60, dim))[rng.integers(0, 60, n)] + 0.4 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "log-normal":
        x *= rng.lognormal(0, 1, (n, 1))
    return x.astype(np.float32)


@pytest.mark.parametrize(("kind", "n", "dim", "most"), [("unit", 12_000, 64, 0.6), ("log-normal", 12_000, 64, 0.8), ("unit", 5000, 256, 1.0), ("clustered", 12_000, 64, 0.2)])
def test_recall(spark, kind, n, dim, most):
    """Recall, exact scores and the share of vectors that were scored."""
    x = vectors(kind, n, dim)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got, scored = {}, []
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
        scored.append(r["scored"])
    scores = x[::20].astype(float) @ x.T.astype(float)
    hit = 0
    for m, q in enumerate(range(0, n, 20)):
        order = [i for i in np.argsort(-scores[m], kind="stable")[:21] if i != q][:20]
        hit += len(set(order) & {i for i, _, _ in got[q]})
        assert [r for _, _, r in got[q]] == list(range(1, 21))
        assert all(abs(s - scores[m][i]) < 1e-9 * max(1, abs(s)) for i, s, _ in got[q])
    print(kind, n, dim, "recall", hit / n, "share", np.mean(scored) / n)
    assert hit / n >= 0.9 and np.mean(scored) / n <= most


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one vector that a third of the rows share
    rows += [(400, None), (420, []), (440, [0.0] * 6), (460, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (480, [float("nan")] * 6), (500, [float("inf")] * 6), (None, rows[0][1])]
    rows += [(520, [1.0, 2.0]), (540, [3.0, 1.0]), rows[20]]
    got, want = search(spark, rows), brute(rows)
    assert set(got) == set(want)
    for q, hits in want.items():
        assert [i for i, _, _ in got[q]] == [i for i, _ in hits], q
        assert np.allclose([s for _, s, _ in got[q]], [s for _, s in hits])


def test_forest_ascends_until_enough():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 16))
    forest = neighbours.Forest(x, seed=1, trees=8)
    own = forest.hashed(x[:10])
    for enough in (1, 50, 1000, 10**9):
        counts = forest.met(own, enough)
        for j in range(10):  # the longest shared prefix that holds enough entries, in all trees at once
            for level in range(forest.bits, -1, -1):
                alike = (forest.keys >> (forest.bits - level)) == (own[:, j] >> (forest.bits - level))[:, None]
                if alike.sum() >= enough or level == 0:
                    break
            want = np.zeros(500, int)
            for t in range(8):
                want[forest.order[t, alike[t]]] += 1
            assert (counts[j] == want).all()
    forest.settle(x[:32], 20)
    assert all(np.allclose(s, x[f] @ q) for q, (f, s) in zip(x[:10], forest.answers(x[:10]), strict=True))


def test_very_large_and_small_numbers(spark):
    rows = [(i, [1e300 * (i - 30), 1e-300 * i, 1.0]) for i in range(60)] + [(100, [1e-320, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.nearest(df, F.col("vec_id") == 40).collect()}
    assert got[40, 1] == (31, float("inf")) and got[40, 20] == (51, float("inf")) and len(got) == 20


def test_empty(spark):
    assert search(spark, [(0, None)]) == {}
