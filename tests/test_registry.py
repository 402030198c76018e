"""Every registered query against its SQL twin on the smallest tables."""

import math

import duckdb
import pytest

from quillfeed.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, (int, float)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 6)
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got
    if name in registry.ORACLES:
        cursor = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)


def test_entry_runs_without_the_optional_subpackage(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["page_id", "cleaned"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
