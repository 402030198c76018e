"""The corpus pipeline: documents in, packed training sequences out.

STAGES are applied in order. Each stage takes what its predecessor kept, written as Parquet and read again, and all
but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.llm import decontaminate as decontamination
from quillfeed.llm import language, neardup, packing
from quillfeed.llm import toxicity as toxic
from quillfeed.session import materialise, read_table

#: Documents stay where their toxicity score is below this.
MAX_TOXICITY = 0.5
#: Documents stay where some language is at least this likely; texts without a letter have none.
MIN_LANGUAGE_SCORE = 0.5
#: Rejected rows up to which their list is broadcast; beyond it, the join shuffles.
BROADCAST_IDS = 1_000_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar does not find toxic."""
    labels = read_table(spark, sf_dir, "labels").filter(language.train_rows(F.col("doc_id"), 5, 0)).select("doc_id", "toxic")
    return toxic.keep(docs, toxic.train(docs, labels), MAX_TOXICITY)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some learned language; with no labelled row to learn from, nothing is rejected."""
    model = language.train(docs.filter(language.train_rows(F.col("doc_id"), 3, 1)))
    if not model.languages:
        return docs
    return language.keep(docs, model, MIN_LANGUAGE_SCORE)


def by_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for each row, written so that it stays the same, and the number's column.

    Stages that drop rows decide by it: an id may be null, or stand for several texts.
    """
    name = "__row"
    while name in docs.columns:
        name += "_"
    return materialise(docs.withColumn(name, F.monotonically_increasing_id())), name


def without(rows: DataFrame, name: str, rejected: DataFrame) -> DataFrame:
    """The rows whose number is not rejected, as they were."""
    rejected = F.broadcast(rejected) if rejected.count() <= BROADCAST_IDS else rejected
    return rows.join(rejected, name, "left_anti").drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: its first row."""
    rows, name = by_row(docs)
    judged = neardup.near_duplicates(rows, words=5, percent=80, id_col=name)
    return without(rows, name, materialise(judged.filter(~F.col("kept")).select(F.col("doc_id").alias(name))))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    rows, name = by_row(docs)
    found = decontamination.matches(rows, read_table(spark, sf_dir, "benchmark"), id_col=name)
    return without(rows, name, materialise(found.select(F.col("doc_id").alias(name)).distinct()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", pack),
]

#: Learned models, MinHash and the packing order have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
