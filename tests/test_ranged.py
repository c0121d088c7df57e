"""Ranged file source: heads, checksums in chunks, pushed filters, exact-named files."""

from __future__ import annotations

import hashlib
import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyspark.sources import files, las, ranged, sinks


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("ranged")
    for name, data in (("b.LAZ", b"x" * 1000), ("a.las", b"y"), ("c.txt", b""), ("noext", b"z" * 10), (".hidden", b"h")):
        (path / name).write_bytes(data)
    (path / "sub").mkdir()
    (path / "sub" / "d.laz").write_bytes(b"deep")
    return str(path)


def test_rows_and_heads(spark, folder):
    got = ranged.scan(spark, folder, head=4, recursive=True).collect()
    assert [(r.name, r.extension, r.length, bytes(r.head)) for r in got] == [
        (".hidden", "", 7 - 6, b"h"), ("a.las", ".las", 1, b"y"), ("b.LAZ", ".laz", 1000, b"xxxx"), ("c.txt", ".txt", 0, b""), ("noext", "", 10, b"zzzz"), ("d.laz", ".laz", 4, b"deep"),
    ]
    assert {r.name for r in ranged.scan(spark, folder, extensions=".laz").collect()} == {"b.LAZ"}
    assert ranged.scan(spark, f"{folder}/a.las").count() == 1
    assert "head" not in ranged.scan(spark, folder).columns


def test_pushed_filter(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for test, wanted in ((F.col("extension") == ".laz", {"b.LAZ", "d.laz"}), (F.col("extension").isin(".laz", ".las"), {"a.las", "b.LAZ", "d.laz"})):
            df = ranged.scan(spark, folder, head=4, recursive=True).filter(test).filter("length > 0")
            assert {r.name for r in df.collect()} == wanted
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Filter" in plan and "extension" not in plan.split("Filter")[1].split("BatchScan")[0].split("\n")[0]  # only length is left to Spark
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = ranged.PushingReader({"path": folder, "recursive": "true"}, type("S", (), {"names": ["path", "name", "extension", "length", "modified"]}))
    left = list(reader.pushFilters([ranged.EqualTo(("extension",), ".laz"), ranged.EqualTo(("name",), "x")]))
    assert [f.attribute for f in left] == [("name",)]
    assert [r[1] for p in reader.partitions() for r in p.rows] == ["b.LAZ", "d.laz"]


def test_files_are_dealt_by_bytes(folder):
    columns = type("S", (), {"names": ["path", "name", "extension", "length", "modified", "md5"]})
    parts = ranged.FileReader({"path": folder, "taskBytes": str(ranged.OPEN_COST + 500)}, columns).partitions()
    assert [len(p.rows) for p in parts] == [1] * 5
    assert [len(p.rows) for p in ranged.FileReader({"path": folder}, columns).partitions()] == [5]


@pytest.mark.parametrize("size", [0, 1, 99, 100, 101, 200, 1000])
def test_checksum_on_both_sides_of_a_chunk_border(spark, tmp_path, size):
    data = os.urandom(size)
    (tmp_path / "f.bin").write_bytes(data)
    row = files.checksums(spark, str(tmp_path), chunk=100).first()
    assert (row.name, row.length, row.md5) == ("f.bin", size, hashlib.md5(data).hexdigest())


def test_a_file_beyond_three_gigabytes(spark, tmp_path):
    """A sparse file: its header is read by range, its checksum in chunks."""
    raw = bytearray(375)
    raw[:4], raw[24], raw[25], raw[104] = b"LASF", 1, 4, 6
    struct.pack_into("<H", raw, 94, 375)
    struct.pack_into("<Q", raw, 247, 5_000_000_000)
    big = tmp_path / "big.laz"
    big.write_bytes(raw)
    os.truncate(big, (3 << 30) + 7)
    (tmp_path / "cut.las").write_bytes(b"LASF")
    got = {r.name: r for r in las.inventory(spark, str(tmp_path)).collect()}
    assert (got["big.laz"].length, got["big.laz"].points, got["big.laz"].header_size, got["big.laz"].problem) == ((3 << 30) + 7, 5_000_000_000, 375, None)
    assert got["cut.las"].problem == "no LAS header"
    state = hashlib.md5(raw)
    rest, zeros = (3 << 30) + 7 - 375, bytes(1 << 24)
    while rest:
        state.update(zeros[: min(rest, len(zeros))])
        rest -= min(rest, len(zeros))
    sums = {r.name: r.md5 for r in files.checksums(spark, str(tmp_path)).collect()}
    assert sums == {"big.laz": state.hexdigest(), "cut.las": hashlib.md5(b"LASF").hexdigest()}


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([("a.xml", "<a/>"), ("b.xml", None)], "name string, content string")
    at = f"file://{tmp_path}/out"
    assert sinks.write_files(df, at) == 2
    assert sinks.write_files(df, at) == 2  # again: the same files
    assert sorted(os.listdir(tmp_path / "out")) == ["a.xml", "b.xml"]
    assert (tmp_path / "out" / "a.xml").read_text() == "<a/>"
    assert sinks.write_files(df.limit(0), at) == 0
    assert ranged.scan(spark, at).count() == 2


def test_manifest_is_ordered(spark, folder):
    assert [r.name for r in files.manifest(spark, folder, (".las", ".laz"), recursive=True).collect()] == ["a.las", "b.LAZ", "d.laz"]


def test_files_that_stay_closed_share_a_task(spark, tmp_path):
    """Each counted as 4 MB, so that a scan for names alone came in a task for every 128 files."""
    for k in range(300):
        (tmp_path / f"{k}.tif").write_text("x")
    schema = lambda o: StructType.fromDDL(ranged.FileSource(o).schema())
    parts = lambda **o: ranged.FileReader({"path": str(tmp_path), **o}, schema(o)).partitions()
    assert len(parts()) == 1
    assert len(parts(head=10)) == 3
