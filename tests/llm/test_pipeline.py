"""The pipeline's stages against plain forms on planted documents."""

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_order_and_columns(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "language_id", "near_dedup", "decontaminate", "packing"]
    for _, stage in pipeline.STAGES[:4]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_near_dedup_keeps_one_of_each_group(spark, docs):
    extra = docs.limit(3)
    kept = sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs.unionByName(extra), SF).collect())
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert kept == sorted(i for i, (_, root) in want.items() if i == root)


def test_decontaminate_drops_passages(spark, docs):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in pipeline.decontaminate(spark, docs, SF).collect()}
    whole = {r["doc_id"] for r in docs.collect() if any(t in r["text"] for t in items)}
    assert not kept & whole and len(kept) >= docs.count() - len(whole) - 3


def test_stages_keep_odd_rows_and_columns(spark):
    rows = [(1, None, None, None, None, "a"), (2, "", "en", "s", 0, "b"), (None, "the and of it is", "en", "s", 5, "c"), (3, "the and of it is", "en", "s", 5, "c")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for _, stage in pipeline.STAGES[:4]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd.limit(0), SF).count() == 0
    more = odd.unionByName(spark.createDataFrame([(i, "the and of it is", "en", "s", 5, "c") for i in range(4, 9)], odd.schema))
    assert sorted(r["doc_id"] or 0 for r in pipeline.language_id(spark, more, SF).collect()) == [0, *range(3, 9)]
    assert pipeline.language_id(spark, odd.filter("lang is null"), SF).count() == 1
    assert sorted(r["doc_id"] or 0 for r in pipeline.near_dedup(spark, odd, SF).collect()) == [0, 1, 2]  # of two equal texts the first row
    assert pipeline.pack(spark, odd, SF).count() == 4


def test_stages_decide_by_row(spark, docs):
    """Ids that repeat over different texts, or are null, neither save nor lose a row."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean, other = " ".join(f"word{i}" for i in range(60)), " ".join(f"else{i}" for i in range(60))
    rows = [(1, clean), (1, other), (2, clean), (None, item), (3, f"before it {item}"), (3, other + " more"), (None, "short and fine")]
    made = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], docs.schema).coalesce(1)
    texts = lambda df: sorted(r["text"] for r in df.collect())
    left = texts(pipeline.near_dedup(spark, made, SF))
    assert {clean, other, "short and fine", item} <= set(left) and len(left) == len(set(left)) and other + " more" not in left
    assert texts(pipeline.decontaminate(spark, made, SF)) == sorted([clean, other, clean, other + " more", "short and fine"])


def test_run_packs_what_is_left(spark):
    out = pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert 0 < out.select("doc_id").distinct().count() < spark.read.parquet(f"{SF}/documents.parquet").count()
