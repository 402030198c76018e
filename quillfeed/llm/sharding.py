"""Uniform sharding by a hypergeometric communication matrix.

Every source partition draws, without replacement, how many of its rows go to each shard (one row of the
communication matrix), permutes its rows locally, sends them, and each shard permutes what it receives. The result
is a uniform shuffle whose shard sizes are fixed before any row moves: they differ by one row at most. No one holds the
whole matrix: a task draws its row from the row counts of the partitions, one number each.

Cases: null text counts no bytes (size 8, CRC of the empty string); empty and very long texts are whole; repeated
rows are sharded one by one; a null id is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.session import cut_lineage, ship_package

#: Rows of a shard that one task orders at most, on average.
ROWS_PER_CELL = 262_144
#: Cells of a shard at least, so that ordering runs on many tasks even for small shards.
MIN_CELLS = 8
#: Cells up to which the rows before each are broadcast (24 bytes each); beyond it, the join shuffles.
BROADCAST_CELLS = 1_000_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Exact sizes: the first `rows % shards` shards hold one row more."""
    return np.full(shards, rows // shards, dtype=np.int64) + (np.arange(shards) < rows % shards)


def _log_factorials(x: int, d: int) -> float:
    """log((x + d)!) - log(x!), precise where both are huge and d is not."""
    if min(x, x + d) < 100:
        return math.lgamma(x + d + 1) - math.lgamma(x + 1)
    series = lambda v: 1 / (12 * v) - 1 / (360 * v**3)
    return math.fsum([d * math.log(x), (x + d + 0.5) * math.log1p(d / x), -d, series(x + d), -series(x)])


def _large_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """An exact hypergeometric draw for any population, in time that does not depend on it.

    Ratio of uniforms with Stadlober's hat (1989) around the mode; log-ratios of probabilities keep their precision.
    """
    total, m = good + bad, min(draws, good + bad - draws)
    small, large = min(good, bad), max(good, bad)
    few, most = min(small, m), max(small, m)  # the law is the same when draws and good items change places
    if few <= 16:
        found = 0
        for i in range(few):
            found += int(rng.integers(0, total - i)) < most - found
    else:
        middle = m * (small / total) + 0.5
        spread = math.sqrt((total - m) * (m / (total - 1)) * (small / total) * (large / total) + 0.5)
        width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
        end = min(few + 1, math.floor(middle + 16 * spread))
        mode = (m + 1) * (small + 1) // (total + 2)
        while True:
            u, v = rng.random(), rng.random()
            if u == 0:
                continue
            x = middle + width * (v - 0.5) / u
            if x < 0 or x >= end:
                continue
            found = math.floor(x)
            d = found - mode
            ratio = -math.fsum(
                [_log_factorials(mode, d), _log_factorials(small - mode, -d), _log_factorials(m - mode, -d), _log_factorials(large - m + mode, d)]
            )
            if 2 * math.log(u) <= ratio:
                break
    if good > bad:
        found = m - found
    return found if m == draws else good - found


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` items, taken without replacement, are good."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0 or draws == good + bad:
        return min(draws, good)
    return int(rng.hypergeometric(good, bad, draws)) if good + bad < 1_000_000_000 else _large_hypergeometric(rng, good, bad, draws)


def _multivariate(rng: np.random.Generator, left: np.ndarray, need: int) -> np.ndarray:
    """How many of `need` rows, drawn without replacement from all open places, fall in each shard: halves of the shards, and halves of these."""
    if len(left) == 1:
        return np.array([need], dtype=np.int64)
    half = len(left) // 2
    first = hypergeometric(rng, int(left[:half].sum()), int(left[half:].sum()), need)
    return np.concatenate([_multivariate(rng, left[:half], first), _multivariate(rng, left[half:], need - first)])


def matrix_row(before: np.ndarray, sizes: np.ndarray, place: int, seed: int) -> np.ndarray:
    """A partition's row of the communication matrix. before[i] counts the rows of the partitions in front of place i.

    The partitions are halved again and again; each half draws its counts from those of the whole. Every task that
    walks through a node of this tree draws the same there, so each makes its own row, and all rows and columns add up.
    """
    low, high, left = 0, len(before) - 1, sizes.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.Generator(np.random.PCG64([seed, low, high]))
        first = _multivariate(rng, left, int(before[middle] - before[low]))
        if place < middle:
            high, left = middle, first
        else:
            low, left = middle, left - first
    return left


def communication_matrix(partition_rows: list[int], sizes: np.ndarray, seed: int) -> np.ndarray:
    """Counts of rows from each partition to each shard; its row and column sums are exact."""
    before = np.cumsum([0, *partition_rows])
    return np.stack([matrix_row(before, sizes, p, seed) for p in range(len(partition_rows))])


def shard(
    df: DataFrame, shards: int = 24, seed: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shards `df` uniformly into `shards` shards of equal row counts (at most one apart).

    Returns the id, size, text_crc32, law, shard, slot (0 up to the shard's size, without gaps) and grown_shard.
    The text itself never moves: one narrow checkpoint fixes the source partitions, so a retried task draws the
    same permutation again.
    """
    spark = df.sparkSession
    ship_package(spark)
    narrow = cut_lineage(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + F.lit(8)).alias("size"),
            F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("text_crc32"),
        )
    )
    counted = narrow.groupBy(F.spark_partition_id().alias("p")).count().collect()  # one number a partition
    rows_of = {r["p"]: r["count"] for r in counted}
    total = sum(rows_of.values())
    sizes = shard_sizes(total, shards)
    # 16 bytes a partition that has rows, whatever the number of rows is.
    held = spark.sparkContext.broadcast((sorted(rows_of), np.cumsum([0, *(rows_of[p] for p in sorted(rows_of))])))

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        partitions, before = held.value
        place = int(np.searchsorted(partitions, p))
        if place == len(partitions) or partitions[place] != p:
            return
        counts = matrix_row(before, sizes, place, seed)
        rng = np.random.Generator(np.random.PCG64([seed, p, 1]))
        targets = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), counts))
        at = 0
        for batch in batches:
            n = batch.num_rows
            order = rng.integers(0, 1 << 62, size=n, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(targets[at : at + n]), pa.array(order)],
                names=[*batch.schema.names, "shard", "draw"],
            )
            at += n

    id_type = narrow.schema["doc_id"].dataType.simpleString()
    dealt = narrow.mapInArrow(permute, f"doc_id {id_type}, size long, text_crc32 long, shard int, draw long")
    cells = max(MIN_CELLS, -(-total // (shards * ROWS_PER_CELL)))
    dealt = dealt.withColumn("cell", F.floor(F.col("draw") / F.lit((1 << 62) / cells)).cast("int"))
    # Slots: rows of earlier cells of the shard, then the rank inside the cell. Both are exact, and no task holds a shard.
    in_cell = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    ahead = in_cell.select(
        "shard",
        "cell",
        (F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")).alias("before"),
    )
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("draw", "doc_id", "text_crc32"))
    ahead = F.broadcast(ahead) if shards * cells <= BROADCAST_CELLS else ahead  # one for 262,144 rows of input
    return (
        dealt.withColumn("rank", rank)
        .join(ahead, ["shard", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("before") + F.col("rank") - F.lit(1)).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
