"""Sinks and the sources that read them back."""

from __future__ import annotations

import json

from surveyspark import rules
from surveyspark.operators import deliveries as D
from surveyspark.operators import manifest as M
from surveyspark.sources import files, sinks


def test_manifest_grows_in_order(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = spark.createDataFrame([(0, f"{i:03d}", 0, f"line{i}") for i in range(30)] + [(0, "999", 0, " ")], "run int, ord string, part int, line string")
    sinks.write_manifest(rows, path)
    new = spark.createDataFrame([("000", 0, "later")], "ord string, part int, line string")
    both = M.append(sinks.read_manifest(spark, path), new)
    sinks.write_manifest(both, str(tmp_path / "again"))
    assert [r.value for r in spark.read.text(str(tmp_path / "again")).collect()] == [*(f"line{i}" for i in range(30)), "later"]


def test_documents_tiles_reports_log(spark, tmp_path):
    sinks.write_documents(spark.createDataFrame([("a.tif", "<x>\n1</x>"), ("b.laz", "<y/>")], "name string, xml string"), str(tmp_path / "docs"))
    got = spark.read.text(str(tmp_path / "docs"), wholetext=True).collect()
    assert sorted((r.tile, r.value.strip()) for r in got) == [("a", "<x>\n1</x>"), ("b", "<y/>")]
    sinks.write_tiles(spark.createDataFrame([("t1", 1), ("t2", 2), ("t1", 3)], "name string, v int"), str(tmp_path / "tiles"))
    assert spark.read.parquet(str(tmp_path / "tiles")).filter("tile_key = 't1'").count() == 2
    sinks.write_report(spark.createDataFrame([("t", 0, 1, "real")], "tile string, root_row int, root_c int, decision string"), str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), sep=";", header=True).first().decision == "real"
    one = spark.createDataFrame([("2026-01-01", "SB_DOP", "BERN", "0921", "https://x")], "stamp string, gds string, area string, line string, link string")
    sinks.log_import(str(tmp_path / "log"), one)
    sinks.log_import(str(tmp_path / "log"), one)
    assert [r.value for r in spark.read.text(str(tmp_path / "log")).collect()] == ["2026-01-01  SB_DOP_BERN_0921 = https://x"] * 2


def test_items_years_and_texts(spark, tmp_path):
    (tmp_path / "item.json").write_text(json.dumps({"id": "kry-x", "assets": {"kry-x-rgb-mosaic.tif": {"href": "h"}}, "properties": {"updated": "2026"}}))
    item = files.catalog_items(spark, str(tmp_path / "item.json")).first()
    assert (item.item, item.assets, item.updated) == ("kry-x", {"kry-x-rgb-mosaic.tif": "h"}, "2026")
    f = spark.createDataFrame([("a", "x/2019/y", "n.tif"), ("a", "x/2019/y", "b_2021.tif"), ("b", "2017/2018/z", "n.tif")], "delivery string, path string, name string")
    assert {r.delivery: r.year for r in D.year_of_delivery(f).collect()} == {"a": 2021, "b": 2018}
    d = spark.createDataFrame([("SB_DOP", rules.DMC), ("SB_DOP", rules.ADS80)], "gds string, camera string")
    assert {r.camera: r.custom_attribute for r in D.with_product_texts(d, rules.products(spark)).collect()}[rules.DMC] == rules.CUSTOM_ATTRIBUTE_DMC["SB_DOP"]
    p = D.preview(spark.createDataFrame([("a", "2", "x2"), ("a", "1", "x1")], "delivery string, name string, xml string")).first()
    assert (p.name, p.xml) == ("1", "x1")


def test_files_go_to_python_in_small_batches(spark, tmp_path):
    from surveyspark.plans.source_queries import point_files
    import pyarrow as pa

    n = 2000
    made = list(point_files([pa.RecordBatch.from_pydict({"key": list(range(n)), "points": [600] * n, "low": [1.0] * n, "high": [2.0] * n})]))
    assert sum(b.num_rows for b in made) == n and max(b.nbytes for b in made) < 5 << 20
    files = spark.range(n).selectExpr("CAST(id AS STRING) AS name", "IF(id = 7, NULL, repeat('x', 10000)) AS content").coalesce(1)
    assert sinks.write_files(files, f"{tmp_path}/many") == n
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
    sizes = {p.name: p.stat().st_size for p in (tmp_path / "many").iterdir()}
    assert len(sizes) == n and sizes["7"] == 0 and sizes["8"] == 10000
