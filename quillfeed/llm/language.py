"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else is a space; runs of 1 to 3 characters are hashed into a fixed number of
buckets. Training counts buckets per language; scoring gathers rows of the broadcast log-probability matrix for the
n-grams that a batch holds and sums them per document, all in numpy over whole texts.

A very long text is cut into parts that share their edges, so memory is bounded by the text itself and no n-gram is lost.

Cases: a null text or one without a letter is `und` with score 0; empty training data makes every text `und`; very
long texts are whole; equal posteriors go to the first language in order; repeated rows are scored one by one; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed.llm.arrow import annotate, rows_where, slices, with_outputs
from quillfeed.session import ship_package

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
#: Training rows of a language at most: a uniform sample by hash of the id, documented as the fit's bound.
ROWS_PER_LANGUAGE = 5_000
UNKNOWN = "und"

#: Bytes of text that are scored at once; arrays take some 60 times as much.
SLICE = 512 << 10
#: Characters of one long text that are hashed at once.
PART = 256 << 10

_letter_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letter_table:
        _letter_table.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter_table[0]


def ngram_buckets(texts: list[str], buckets: int = BUCKETS, part: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of every n-gram that holds a letter, its document), for each length of n-grams and part of the texts.

    Two spaces part documents, so an n-gram with a letter touches one document only.
    """
    if len(texts) > 1 or len(texts[0]) <= part:
        joined = "  ".join(["", *texts, ""])
        lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
        owner = np.concatenate([np.zeros(2, np.int32), np.repeat(np.arange(len(texts), dtype=np.int32), lengths)])
        yield from _hashed(joined, owner, buckets, len(joined))
        return
    # One long text: parts hold the characters that an n-gram which starts in them reaches, and no more n-grams start.
    reach = max(SIZES) - 1
    for at in range(-2, len(texts[0]) + 2, part):
        end = at + part + reach
        piece = " " * max(0, -at) + texts[0][max(0, at) : end] + " " * max(0, min(end, len(texts[0]) + 2) - len(texts[0]))
        yield from _hashed(piece, np.zeros(len(piece), np.int32), buckets, part)


def _hashed(joined: str, owner: np.ndarray, buckets: int, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and documents of the n-grams that start within the first `starts` characters."""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, np.uint32(32))
    for n in SIZES:
        end = min(len(codes) - n + 1, starts)
        if end <= 0:
            continue
        h = np.full(end, n, dtype=np.uint32)
        keep = np.zeros(end, bool)
        for k in range(n):
            h ^= codes[k : k + end]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            keep |= is_letter[k : k + end]
        keep = np.flatnonzero(keep)
        # Across the two spaces, the letter of a run is at its start or at its end.
        whose = owner[keep + np.where(is_letter[keep], 0, n - 1)]
        yield (h[keep] & np.uint32(buckets - 1)).astype(np.int32), whose


def train_rows(id_col: Column, modulus: int, held_out: int) -> Column:
    """Whether a row may be learned from: crc32 of the id as text, modulo `modulus`, is not `held_out`."""
    return F.pmod(F.crc32(F.encode(id_col.cast("string"), "UTF-8")), F.lit(modulus)) != F.lit(held_out)


class Model:
    """Languages in order, and log-probabilities (languages x buckets) with log priors."""

    def __init__(self, languages: list[str], log_probability: np.ndarray, log_prior: np.ndarray):
        self.languages, self.log_probability, self.log_prior = languages, log_probability, log_prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        counts, scores = np.zeros(len(texts)), np.zeros((len(self.languages), len(texts)))
        for bucket, owner in ngram_buckets([(t or "").lower() for t in texts]):
            counts += np.bincount(owner, minlength=len(texts))
            for total, row in zip(scores, self.log_probability, strict=True):
                total += np.bincount(owner, weights=row[bucket], minlength=len(texts))
        has = counts > 0
        # Tempered: evidence counts as 64 n-grams at most, as neighbouring n-grams repeat one another.
        scores = scores * (64 / np.maximum(counts, 64))[None, :] + self.log_prior[:, None]
        best = scores.argmax(axis=0)
        top = 1 / np.exp(scores - scores.max(axis=0)).sum(axis=0)
        return (
            [self.languages[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)],
            [float(s) if h else 0.0 for s, h in zip(top, has, strict=True)],
        )


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fits the model on rows whose language is not null: up to ROWS_PER_LANGUAGE of each, a sample by hash of the id."""
    ship_package(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull())
    per = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row for each language
    if not per:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, min(1.0, ROWS_PER_LANGUAGE / n))])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < share[F.col(lang_col)]).select(lang_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                langs = np.array(batch.column(0).to_pylist(), dtype=object)
                for bucket, owner in ngram_buckets([(t or "").lower() for t in batch.column(1).to_pylist()]):
                    for lang in set(langs):
                        part = np.bincount(bucket[(langs == lang)[owner]], minlength=BUCKETS)
                        totals[lang] = totals.get(lang, 0) + part
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    counted = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(per)
    at = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((len(languages), BUCKETS))
    for r in counted.collect():  # languages x buckets numbers, whatever the input
        table[at[r["lang"]], r["bucket"]] = r["n"]
    smooth = table + 0.5
    prior = np.array([per[lang] for lang in languages], dtype=float)
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)), np.log(prior / prior.sum()))


def _scored(df: DataFrame, model: Model, text_col: str) -> tuple[DataFrame, list[str]]:
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(texts: list[str | None]) -> list[pa.Array]:
        langs, scores = shared.value.predict(texts)
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return annotate(df, text_col, "string, double", work, SLICE)


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The columns of `df`, with lang_pred and score of every whole text; input columns of these names give way."""
    return with_outputs(_scored(df, model, text_col), "lang_pred", "score")


def keep(df: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """Rows of `df`, as they are, whose language is known with a score of at least `least`."""
    return rows_where(_scored(df, model, text_col), (F.col("o0") != UNKNOWN) & (F.col("o1") >= least))
