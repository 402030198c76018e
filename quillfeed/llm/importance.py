"""Target-distribution importance resampling over hashed word n-grams.

Documents are counted into buckets once. The sparse document-by-bucket matrix is kept as blocks of compressed rows, one
block for some thousand documents, in Parquet. The sums of its columns give the distribution of all documents; against
that of the target texts they give each bucket's gain; the product of the matrix with the gains gives each document's
weight. Gumbel noise from a seeded digest of the id is added, and the highest scores are drawn: a sample without
replacement in proportion to the importance, the same on every run.

Cases: a null or wordless text has no features, weight 0 and is not drawn; texts of fewer than `min_words` words get
weight and score but are not drawn; very long texts are counted whole, piece by piece; repeated rows are judged one by
one, and rows alike in all figures share their ranks in any order; a null id is scored as if it were empty and stands
before all others; an empty target or table gives gains from the counts that there are; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillfeed.llm.arrow import SLICE_BYTES, slices
from quillfeed.session import materialise, ship_package

BUCKETS = 10_000
LONGEST = 2
MIN_WORDS = 20
PERCENT = 25
SEED = "7"

#: Bytes of text that make one block of the matrix; one longer text is still a block.
BLOCK_BYTES = 1 << 18
#: Readers take a row group of blocks at once, so row groups are kept small, and checked for their size after few blocks.
ROW_GROUPS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 4, "parquet.block.size.row.check.min": 4}

#: Bytes of words, A-Z lowered: digits, a-z and everything beyond ASCII; all others part words.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """A plain text in pieces of about `limit` bytes, cut between words; a longer word stays whole."""
    at = 0
    while len(text) - at > limit:
        end = text.rfind(b" ", at, at + limit)
        end = end if end > at else text.find(b" ", at + limit)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def hashed_features(words: list[bytes], longest: int, new: int = 0) -> list[int]:
    """CRC-32 of all runs of 1 to `longest` words, joined by a space, that end at or after place `new`.

    The checksum of a longer run goes on from that of the run without its last word.
    """
    spaced = [b" " + w for w in words[1:]]
    level = [crc32(w) for w in words]
    out = level[new:]
    for k in range(1, min(longest, len(words))):
        level = [crc32(s, c) for s, c in zip(spaced[k - 1 :], level)]  # the last run has no word after it
        out += level[max(new - k, 0) :]
    return out


def count_text(text: bytes, buckets: int, longest: int, limit: int = SLICE_BYTES) -> tuple[int, np.ndarray, np.ndarray]:
    """(words, buckets met in order, counts) of a UTF-8 text."""
    plain = text.translate(_PLAIN)
    if len(plain) <= limit:
        words = plain.split()
        met, counts = np.unique(np.array(hashed_features(words, longest), np.uint32) % np.uint32(buckets), return_counts=True)
        return len(words), met.astype(np.int32), counts
    total, n, tail = np.zeros(buckets, np.int64), 0, []
    for piece in _pieces(plain, limit):
        fresh = piece.split()
        words = [*tail, *fresh]
        total += np.bincount(np.array(hashed_features(words, longest, len(tail)), np.uint32) % np.uint32(buckets), minlength=buckets)
        n, tail = n + len(fresh), words[max(len(words) - longest + 1, 0) :] if longest > 1 else []
    met = np.flatnonzero(total)
    return n, met.astype(np.int32), total[met]


MATRIX = "words array<long>, starts array<long>, buckets array<int>, counts array<int>"


def count_matrix(df: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document-by-bucket matrix as blocks of compressed rows.

    A block has `ids` and `words` of its documents, `starts` (a row's first entry; one more than documents), and the
    `buckets` and `counts` of all entries.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, BLOCK_BYTES):
                rows = [count_text(t or b"", buckets, longest) for t in batch.column(1).cast(pa.binary()).to_pylist()]
                flat = (
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array(np.cumsum([0, *(len(m) for _, m, _ in rows)])),
                    pa.array(np.concatenate([m for _, m, _ in rows])),
                    pa.array(np.concatenate([c for _, _, c in rows]).astype(np.int32)),
                )
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([one(batch.column(0)), *map(one, flat)], names=["ids", "words", "starts", "buckets", "counts"])

    return df.select(id_col, text_col).mapInArrow(run, f"ids array<{df.schema[id_col].dataType.simpleString()}>, {MATRIX}")


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all blocks of a batch, where each block starts)."""
    column = batch.column(name)
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def column_sums(matrix: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs over all documents. Each task adds up its blocks; `buckets` numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, counts = _flat(batch, "buckets")[0], _flat(batch, "counts")[0]
            met, place = np.unique(at, return_inverse=True)
            sums = np.zeros(len(met), np.int64)
            np.add.at(sums, place, counts)
            total[met] += sums
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    parts = matrix.select("buckets", "counts").mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # `buckets` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousandth of the log ratio of the smoothed shares of each bucket, floored to whole numbers."""
    buckets, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = ((target + 1.0) * (s + buckets)) / ((corpus + 1.0) * (t + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(matrix: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight (the floored mean gain of the features) of each document."""
    shared = matrix.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, counts = _flat(batch, "buckets")[0], _flat(batch, "counts")[0].astype(np.int64)
            starts, bounds = _flat(batch, "starts")
            entries = _flat(batch, "buckets")[1]
            # Starts are counted inside a block: each block's are moved to its place in the batch, its last one is the next row's.
            place = starts + np.repeat(entries[:-1], np.diff(bounds))
            first = np.ones(len(starts), bool)
            first[bounds[1:] - 1] = False
            begin, end = place[first], place[np.flatnonzero(first) + 1]
            total = lambda values: (lambda c: c[end] - c[begin])(np.concatenate([[0], np.cumsum(values)]))
            n = total(counts)
            weight = total(counts * shared.value[at]) // np.maximum(n, 1)
            ids = batch.column("ids")
            yield pa.RecordBatch.from_arrays(
                [ids.flatten(), batch.column("words").flatten(), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    id_type = matrix.schema["ids"].dataType.elementType.simpleString()
    return matrix.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: str = SEED) -> Column:
    """A thousandth of Gumbel noise, floored: the same for an id at every run."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(scored: DataFrame, asked: Column, percent: int = PERCENT) -> DataFrame:
    """Adds `rank`, by falling score and rising doc_id, to the first `percent` of a hundred of the rows that are `asked`.

    Ranks are places in ranges of the order, whose sizes are added up: no task holds all rows. `scored` is a written
    table; a number for each row ends the order, so that rows of one score and id spread too.
    """
    rows = materialise(scored.withColumn("__row", F.monotonically_increasing_id()))
    order = [F.col("score").desc(), F.col("doc_id"), F.col("__row")]
    ranged = rows.filter(asked).select("score", "doc_id", "__row").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ranged.select("__row", F.monotonically_increasing_id().alias("__at")))
    split = placed.select("__row", F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__in"))
    sizes = split.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy())
    offsets = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"), total.alias("__all"))  # a row for each range
    place = F.col("__before") + F.col("__in") + 1
    drawn = split.join(F.broadcast(offsets), "__part").filter(place <= F.floor(F.lit(percent) * F.col("__all") / 100)).select("__row", place.alias("rank"))
    return rows.join(drawn, "__row", "left").drop("__row")


@dataclass(frozen=True)
class Drawn:
    """The written matrix of the documents, the gains, and one row for each document."""

    matrix: DataFrame
    gain: np.ndarray
    documents: DataFrame


def resample(
    df: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> Drawn:
    """Draws documents towards the distribution of the target's texts: doc_id, n_words, n_features, weight, score, rank."""
    matrix = materialise(count_matrix(df, buckets, longest, id_col, text_col), **ROW_GROUPS)
    wanted = count_matrix(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")), buckets, longest)
    gain = gains(column_sums(matrix, buckets), column_sums(wanted, buckets))
    scored = weights(matrix, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return Drawn(matrix, gain, ranked(scored, F.col("n_words") >= min_words, percent))
