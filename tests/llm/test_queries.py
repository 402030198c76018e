"""The registered queries on the smallest tables: columns, types, whole tables, and the SQL twin."""

import duckdb
import pytest

from quillfeed.llm import registry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_quality": "doc_id bigint, score double, kept boolean",
    "op3_decontamination": "doc_id bigint, contaminated boolean",
    "op4_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6_nearest": "query_id bigint, rank int, vec_id bigint, score double",
    "op7_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op8_neardup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_importance": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op13_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
}


def test_all_are_registered():
    assert set(registry.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    have = dict(df.dtypes)
    for part in COLUMNS[name].split(", "):
        column, kind = part.split(" ")
        assert have[column] == kind, (column, have[column])
    table, key = ("pages", "page_id") if name == "op10_url_filter" else ("documents", "doc_id")
    rows = df.collect()
    if name == "op6_nearest":
        asked = [r["vec_id"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 20 = 0").collect()]
        assert len(rows) == 20 * len(asked)
        return
    ids = [r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").collect()]
    got = [r[key] for r in rows]
    assert sorted(set(got)) == sorted(ids) and (name == "op5_packing" or len(got) == len(ids))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    cursor = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = sorted(map(repr, (tuple(r) for r in cursor.fetchall())))
    assert sorted(repr(tuple(r[n] for n in names)) for r in registry.QUERIES[name](spark, SF).collect()) == want
