"""Approximate nearest neighbours by a hash-prefix forest.

The index is cut into shards of like norms; a shard holds, for every tree, the sorted array of its vectors' long hash
strings (signs of random projections). Before it is hashed, a vector is completed by one component to the largest norm
of its shard, so that angles order inner products. A query descends each tree to its longest-prefix match, then all
trees ascend together, one bit at a time, until the ranges that share the prefix hold enough entries; the vectors met
in enough of the trees are scored in double precision. How many entries and trees are enough, a shard finds out by
itself: on the first queries it holds the answers against those of all its vectors, and takes the cheapest setting that
reaches the stated recall, or all vectors where none does. Every shard answers every query of the stated query set,
block by block, and the shards' best are merged.

Equal vectors are one entry that keeps its smallest ids, as many as an answer can hold, so a vector that a third of
all rows share costs one entry, and no answer is lost by it.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as queries or as
candidates; inner products beyond the range of doubles are infinite, and one that is no number counts as minus
infinity; vectors are held against those of the same length only; ties go to the smaller id; rows that repeat an id
with an equal vector count once; a null id takes no part; with fewer candidates than asked for, all are returned; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.llm.skew import join_dealt
from quillfeed.session import materialise, ship_package

TREES, BITS = 256, 20
#: Share of a shard's true nearest that its setting finds on the first queries, and the number of these queries.
RECALL, PROBES = 0.93, 32
#: Trees that a vector may have to be met in.
MET_IN = (16, 12, 9, 7, 6, 5, 4, 3, 2, 1)
#: Ranges of norms that shards are cut from, by quantiles.
NORM_RANGES = 64
ROWS_PER_SHARD = 16_384
MIN_SHARDS = 8
#: Queries that a shard answers at once.
QUERY_BLOCK = 128
#: Parts into which the ids of one vector are dealt before the smallest are picked.
SALTS = 256


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector over its largest component, so that no square overflows."""
    return vectors / np.abs(vectors).max(axis=1, keepdims=True)


class Forest:
    """Sorted hash strings of one shard's vectors, for each tree."""

    def __init__(self, vectors: np.ndarray, seed: int, trees: int = TREES, bits: int = BITS):
        rng = np.random.Generator(np.random.PCG64([6, seed, vectors.shape[1]]))
        self.exact, self.trees, self.bits = vectors, trees, bits
        small = vectors / np.abs(vectors).max()
        squares = (small**2).sum(axis=1)
        completed = np.column_stack([small, np.sqrt(np.maximum(0.0, squares.max() - squares))]).astype(np.float32)
        self.planes = rng.standard_normal((completed.shape[1], trees * bits)).astype(np.float32)
        keys = self._keys(completed)
        self.order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        self.keys = np.take_along_axis(keys, self.order, axis=1)
        self.enough, self.met_in = np.inf, 0

    def _keys(self, vectors: np.ndarray) -> np.ndarray:
        weights = (1 << np.arange(self.bits, dtype=np.int64))[::-1]
        out = np.empty((self.trees, len(vectors)), np.int64)
        for a in range(0, len(vectors), 1024):
            signs = (vectors[a : a + 1024] @ self.planes > 0).reshape(-1, self.trees, self.bits)
            out[:, a : a + 1024] = (signs @ weights).T
        return out

    def hashed(self, queries: np.ndarray) -> np.ndarray:
        return self._keys(np.column_stack([_scaled(queries), np.zeros(len(queries))]).astype(np.float32))

    def _ranges(self, own: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query, where the entries that share the first `level` bits begin and end."""
        cut = self.bits - level
        low = (own >> cut) << cut
        pairs = [(np.searchsorted(k, q), np.searchsorted(k, q + (1 << cut))) for k, q in zip(self.keys, low, strict=True)]
        return np.stack([a for a, _ in pairs]), np.stack([b for _, b in pairs])

    def met(self, own: np.ndarray, enough: float) -> np.ndarray:
        """queries x vectors: the number of trees that meet a vector when the synchronous ascent of a query stops."""
        n, at = self.keys.shape[1], np.zeros(own.shape[1], np.int64)
        # Where the ascent stops, found by halving: the longest shared prefix at which all ranges hold enough entries.
        high = np.full(own.shape[1], self.bits)
        while (at < high).any():
            middle = (at + high + 1) // 2
            left, right = self._ranges(own, middle)
            full = (right - left).sum(axis=0) >= enough
            at, high = np.where(full, middle, at), np.where(full, high, middle - 1)
        left, right = self._ranges(own, at)
        counts = np.zeros((own.shape[1], n), np.uint16)
        for t in range(self.trees):
            lengths = right[t] - left[t]
            rows = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths - left[t], lengths)
            counts[np.repeat(np.arange(own.shape[1]), lengths), self.order[t, rows]] += 1
        return counts

    def settle(self, queries: np.ndarray, k: int, recall: float = RECALL) -> None:
        """Chooses how many entries end an ascent, and in how many trees a vector must be met, by the recall on some queries."""
        n, own = len(self.exact), self.hashed(queries)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.nan_to_num(queries @ self.exact.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        self.enough, self.met_in, cost = np.inf, 0, float(n)
        for level in range(self.bits, 0, -1):
            enough = n * self.trees / 2**level
            if enough < k:
                continue
            counts = self.met(own, enough)
            true = np.take_along_axis(counts, best, axis=1)
            for met_in in MET_IN:
                if (true >= met_in).mean() >= recall:
                    # Reading an entry costs about a sixteenth of scoring a vector.
                    now = (counts >= met_in).sum() / len(queries) + counts.sum(dtype=np.int64) / len(queries) / 16
                    if now < cost:
                        self.enough, self.met_in, cost = enough, met_in, now
                    break
            if counts.sum(dtype=np.int64) / len(queries) / 16 > cost:
                break

    def answers(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query, the vectors scored and their inner products in double precision."""
        if self.met_in == 0:
            found = [np.arange(len(self.exact))] * len(queries)
        else:
            found = [np.flatnonzero(c >= self.met_in) for c in self.met(self.hashed(queries), self.enough)]
        for q, f in zip(queries, found, strict=True):
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (self.exact[f] * q).sum(axis=1)
            scores[np.isnan(scores)] = -np.inf
            yield f, scores


def _best(forest: Forest, ids: list, queries: np.ndarray, k: int) -> list:
    """For each query, up to k + 1 (score, id), best first, and the number of vectors scored; ids are expanded from their vectors."""
    out = []
    for found, scores in forest.answers(queries):
        if len(found) > k + 1:
            least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            top = np.flatnonzero(scores >= least)  # all ties of the last one too
        else:
            top = np.arange(len(found))
        pairs = sorted((-s, i) for s, r in zip(scores[top].tolist(), found[top].tolist(), strict=True) for i in ids[r])
        out.append(([(-s, i) for s, i in pairs[: k + 1]], len(found)))
    return out


def _shards(entries: DataFrame) -> tuple[DataFrame, int]:
    """Entries with the number of their shard: like norms together, a bounded number of rows each; and the number of shards."""
    total = entries.count()
    wanted = max(MIN_SHARDS, -(-total // ROWS_PER_SHARD))
    ranges = min(NORM_RANGES, wanted)
    cuts = entries.agg(F.percentile_approx("norm", [j / ranges for j in range(1, ranges)], 10_000)).first()[0] or []
    at = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda x: x < F.col("norm")))
    placed = entries.withColumn("range", at)
    held = {r["range"]: r["count"] for r in placed.groupBy("range").count().collect()}  # 64 numbers at most
    per = min(ROWS_PER_SHARD, -(-total // MIN_SHARDS)) or 1
    first, count, used = [], [], 0
    for j in range(ranges):
        count.append(max(1, -(-held.get(j, 0) // per)))
        first.append(used)
        used += count[-1]
    pick = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), F.col("range") + 1)
    return placed.withColumn("shard", (pick(first) + F.pmod("c1", pick(count))).cast("int")).drop("range"), used


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score, scored) of the k largest inner products found for each query row.

    `scored` is the number of vectors whose inner product with the query was computed.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.withColumn("c1", F.xxhash64("vector")).withColumn("c2", F.xxhash64(F.lit(6), "vector"))
    rows = materialise(rows)

    # Equal vectors: the k + 1 smallest ids. Two ranks, the first over a part of the ids, so no task meets a whole group.
    lots = rows.select("c1", "c2", "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    part = F.row_number().over(Window.partitionBy("c1", "c2", "salt").orderBy("vec_id"))
    whole = F.row_number().over(Window.partitionBy("c1", "c2").orderBy("vec_id"))
    few = lots.withColumn("r", part).filter(F.col("r") <= k + 1).withColumn("r", whole).filter(F.col("r") <= k + 1)
    ids = few.groupBy("c1", "c2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    vectors = rows.groupBy("c1", "c2").agg(F.first("vector").alias("vector"), F.max("asks").alias("asks"))
    peak = F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    norm = F.col("peak") * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("peak")) * (x / F.col("peak"))))
    entries = materialise(vectors.join(ids, ["c1", "c2"]).withColumn("peak", peak).withColumn("norm", norm).drop("peak"))
    placed, shards = _shards(entries)
    held = placed.select("shard", F.lit(0).alias("turn"), "c1", "c2", "vector", "ids")
    asked = entries.filter("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("turn"), "c1", "c2", "vector",
        F.array().cast("array<long>").alias("ids"),
    )
    # One partition holds whole shards: first a shard's entries (a bounded number), then the queries, block by block.
    dealt = held.unionByName(asked).withColumn("dim", F.size("vector")).repartition(shards, "shard").sortWithinPartitions("shard", "dim", "turn", "c1", "c2")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, forest, names = None, [], None, []
        for frame in frames:
            for (shard, dim, turn), group in frame.groupby(["shard", "dim", "turn"], sort=True):
                if at != (shard, dim):
                    at, parts, forest = (shard, dim), [], None
                if turn == 0:
                    parts.append(group[["vector", "ids"]])
                    continue
                if forest is None and parts:
                    vectors = np.stack([v for p in parts for v in p["vector"]]).astype(np.float64)
                    names = [list(i) for p in parts for i in p["ids"]]
                    forest, parts = Forest(vectors, int(shard)), []
                    forest.settle(np.stack(list(group["vector"].iloc[:PROBES])).astype(np.float64), k)
                if forest is None:
                    continue
                for a in range(0, len(group), QUERY_BLOCK):
                    block = group.iloc[a : a + QUERY_BLOCK]
                    q = np.stack(list(block["vector"])).astype(np.float64)
                    found = _best(forest, names, q, k)
                    yield pd.DataFrame(
                        {
                            "c1": block["c1"].to_numpy(),
                            "c2": block["c2"].to_numpy(),
                            "scores": [[s for s, _ in f] for f, _ in found],
                            "ids": [[i for _, i in f] for f, _ in found],
                            "scored": [n for _, n in found],
                        }
                    )

    answers = materialise(dealt.mapInPandas(run, "c1 long, c2 long, scores array<double>, ids array<long>, scored long"))
    pair = F.explode(F.arrays_zip("scores", "ids")).alias("p")
    single = answers.select("c1", "c2", pair).select("c1", "c2", (-F.col("p.scores")).alias("cost"), F.col("p.ids").alias("id"))
    # Merged per vector that asks: shards x (k + 1) pairs, then k + 1. A query drops itself and takes the first k.
    place = F.row_number().over(Window.partitionBy("c1", "c2").orderBy("cost", "id"))
    merged = single.withColumn("r", place).filter(F.col("r") <= k + 1).groupBy("c1", "c2").agg(F.array_sort(F.collect_list(F.struct("cost", "id"))).alias("best"))
    merged = merged.join(answers.groupBy("c1", "c2").agg(F.sum("scored").alias("scored")), ["c1", "c2"])
    asking = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "c1", "c2").distinct()
    own = join_dealt(asking, merged, ["c1", "c2"], "query_id").select(
        "query_id", "scored", F.posexplode(F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("pos", "hit")
    )
    return own.select("query_id", (F.col("pos") + F.lit(1)).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.cost")).alias("score"), "scored")
