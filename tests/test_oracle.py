"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import pytest

from surveyspark.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else round(float(v), 6)
    if isinstance(v, bool) or not isinstance(v, int):
        return v
    return float(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    rel = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0
