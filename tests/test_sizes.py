"""Queries and their SQL on tables that differ in size from the small ones: tiles of fewer rows, keys of more digits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surveyspark.plans import registry
from tests.test_oracle import DATA, rows


def compared(spark, folder, name, **tables):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df, rel = registry.QUERIES[name](spark, str(folder)), con.execute(registry.ORACLE[name])
    got, want = rows(df.columns, df.collect()), rows([c[0] for c in rel.description], rel.fetchall())
    assert got == want
    return got


def embeddings(spark):
    return spark.read.parquet(f"{DATA}/embeddings.parquet")


@pytest.mark.parametrize("name", ["classify_groups", "group_metrics", "nodata_diagnosis"])
@pytest.mark.parametrize("n", [151, 156])
def test_last_tile_has_fewer_rows(spark, tmp_path, name, n):
    # the last tile's values are high, so that one area fills its rows
    e = embeddings(spark).filter(F.col("vec_id") < n)
    full = F.when(F.col("vec_id") >= 150, F.transform("embedding", lambda v: F.lit(0.5).cast("float"))).otherwise(F.col("embedding"))
    assert compared(spark, tmp_path, name, embeddings=e.withColumn("embedding", full))


@pytest.mark.parametrize("name", ["percentile_stretch", "overview"])
def test_percentiles_of_equal_neighbours(spark, tmp_path, name):
    # previews of many equal values: the 98th percentile lies between two of them; and means with odd fractions
    high = F.transform("embedding", lambda v, i: F.when((F.pmod("vec_id", F.lit(7)) < 5) & (i % 13 != 1), 0.5).otherwise(v * 0.3).cast("float"))
    e = embeddings(spark).unionByName(embeddings(spark).select((F.col("vec_id") + 500).alias("vec_id"), *[c for c in embeddings(spark).columns if c != "vec_id"]))
    compared(spark, tmp_path, name, embeddings=e.withColumn("embedding", high))


def test_cells_with_names_of_five_digits(spark, tmp_path):
    cells = spark.range(40).select((F.col("id") * 1301 % 9000 + 1).alias("l_suppkey"), (F.col("id") * 17000).alias("l_partkey"))
    assert any("name" in r[-1] for r in compared(spark, tmp_path, "grid_check", lineitem=cells) if r)


def test_tiles_far_out_have_no_overflow(spark, tmp_path):
    spark.createDataFrame([(90_000, 2_000_000), (90_001, 2_000_000)], "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert len(registry.QUERIES["grid_check"](spark, str(tmp_path)).collect()) == 1
