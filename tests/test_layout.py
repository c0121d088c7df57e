"""Points along a Morton curve: bounded files on a dense cell, boxes that open only their files."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from surveyspark.sources import layout

SCHEMA = "id long, x double, y double"


def test_morton_interleaves(spark):
    rng = random.Random(1)
    pairs = [(0, 0), (1, 0), (0, 1), (2**31 - 1, 0), (0, 2**31 - 1), *((rng.randrange(2**31), rng.randrange(2**31)) for _ in range(200))]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", layout.morton(F.col("a"), F.col("b")).alias("m")).collect()
    for r in rows:
        assert r.m == sum((r.a >> k & 1) << 2 * k | (r.b >> k & 1) << 2 * k + 1 for k in range(31))


def test_a_dense_cell_takes_many_files(spark, tmp_path):
    rng = random.Random(2)
    dense = [(k, rng.uniform(500, 510), rng.uniform(500, 510)) for k in range(3000)]  # half of all points in one spot
    wide = [(k, rng.uniform(-10_000, 10_000), rng.uniform(-10_000, 10_000)) for k in range(3000, 6000)]
    points = [*dense, *wide]
    path = str(tmp_path / "points")
    df = spark.createDataFrame([*points, (9, None, 1.0)], SCHEMA)
    assert layout.write_points(df, path, 0.1, 300) >= 15
    sizes = [r.points for r in spark.read.parquet(f"{path}/_boxes").collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 3 * 300
    for box in ((500, 500, 502, 502), (-10_000, -10_000, -9_000, -9_000), (-10_000, -10_000, 10_000, 10_000), (505, 505, 505, 505), (20_000, 0, 30_000, 1)):
        want = {p[0] for p in points if box[0] <= p[1] <= box[2] and box[1] <= p[2] <= box[3]}
        assert {r.id for r in layout.read_box(spark, path, *box).collect()} == want
    opened = lambda *box: layout.files_of_box(spark, path, *box).count()
    assert 1 <= opened(-10_000, -10_000, -9_000, -9_000) <= len(sizes) / 4
    assert 1 <= opened(500, 500, 502, 502) <= len(sizes) / 2  # in the dense spot


def test_without_points(spark, tmp_path):
    path = str(tmp_path / "none")
    layout.write_points(spark.createDataFrame([], SCHEMA), path, 1.0)
    assert layout.read_box(spark, path, 0, 0, 1, 1).collect() == []
