"""Tiles, grid cells, points, headers and coordinate systems."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark.functions import geo
from surveyspark.operators import catalog as C
from surveyspark.operators import points as P
from surveyspark.operators import tiles as T


def test_missing_neighbours(spark):
    t = spark.createDataFrame([("a", 2600, 1100), ("b", 2602, 1100), ("c", None, None)], "tile string, e int, n int")
    got = {r.tile: r.missing for r in T.missing_neighbours(t).collect()}
    assert got["a"] == ["N", "NE", "SE", "S", "SW", "W", "NW"] and got["b"] == ["N", "NE", "E", "SE", "S", "SW", "NW"] and len(got["c"]) == 8


def test_overlaps(spark):
    b = spark.createDataFrame([("a", 0.0, 0.0, 1000.0, 1000.0), ("b", 950.0, 0.0, 1950.0, 1000.0), ("c", 1949.0, 0.0, 2949.0, 1000.0), ("d", 5000.0, 0.0, 6000.0, 9.0)], "id string, minx double, miny double, maxx double, maxy double")
    assert [tuple(r) for r in T.overlapping_pairs(b, 1000.0).collect()] == [("a", "b", 50.0, 1000.0)]
    assert {r.a + r.b for r in T.overlapping_pairs(b, 1000.0, kind="extent", limit=0.05).collect()} == {"ab", "bc"}


def test_text_points(spark):
    lines = [("s", i, v) for i, v in enumerate(["x y h", "1 2 3", "4  5 6", "7 8", "a b c"])] + [("t", i, v) for i, v in enumerate(["1;2;3;9", "4;5;6;9"])]
    lines += [("e", 0, "nothing here"), ("two", 0, "1 2")]
    df = spark.createDataFrame(lines, "file string, line_no long, value string")
    s = P.sniff(df)
    got = {r.file: (r.kind, r.sep, r.skip, r.columns, r.problem) for r in s.collect()}
    assert got["s"] == ("xyz", " ", 1, 3, None) and got["t"] == ("xyz", ";", 0, 4, None)
    assert got["e"][4] == "no numbers" and got["two"][4] == "columns"
    pts = P.xyz_points(df, s).orderBy("file", "line_no").collect()
    assert [(r.file, r.x, r.y, r.z) for r in pts if not r.ignored] == [("s", 1, 2, 3), ("s", 4, 5, 6), ("t", 1, 2, 3), ("t", 4, 5, 6)]
    assert sum(r.ignored for r in pts) == 2


def test_grid_centres(spark):
    text = ["ncols 2", "nrows 2", "xllcorner 10", "yllcenter 21", "cellsize 2", "NODATA_value -9999", "1 2 3", "-9999"]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(text)], "file string, line_no long, value string")
    assert sorted((r.x, r.y, r.z) for r in P.grid_points(df).collect()) == [(11, 21, 3), (11, 23, 1), (13, 23, 2)]
    assert P.sniff(df).first().kind == "grid"


def test_frames_and_formats(spark):
    h = spark.createDataFrame([("ok", 2629, 1106, 2629000.012, 2629999.987, 1106000.004, 1106999.991), ("wide", 2629, 1106, 2628999.9, 2629999.9, 1106000.0, 1106900.0)], "name string, e_km int, n_km int, minx double, maxx double, miny double, maxy double")
    got = {r.name: (r.violation, [tuple(g) for g in r.gaps]) for r in P.frame_report(h, 1.0).collect()}
    assert got == {"ok": (False, []), "wide": (True, [("north", 99.99)])}
    f = spark.createDataFrame([(True, True), (False, False), (False, True), (True, False)], "rgb boolean, keep boolean").select(geo.point_format(F.col("rgb"), F.col("keep")))
    assert [r[0] for r in f.collect()] == [7, 6, None, None]


def test_thresholds_and_extent(spark):
    df = spark.createDataFrame([([2713000.0, 0.1, 0.0, 1205000.0, 0.0, -0.1],), ([713000.0, 0.1, 0.0, 205000.0, 0.0, -0.1],)], "gt array<double>")
    g, n = F.col("gt"), F.lit(10000)
    got = df.select(geo.in_lv95(g, n, n), geo.thresholds(g[1], g[5])["area_px"], geo.thresholds(g[1], g[5])["contact_px"]).collect()
    assert [tuple(r) for r in got] == [(True, 90000, 800), (False, 90000, 800)]


INFO = "struct<has_crs:boolean,in_lv95_extent:boolean,name:string,is_compound:boolean,horizontal_is_lv95:boolean,lv95_equivalent:boolean,local_only:boolean,vertical_epsg:string>"


def test_crs_decisions(spark):
    plain, c5728, c5729 = (True, True, "X", False, True, False, False, None), (True, True, "X", True, True, False, False, "5728"), (True, True, "X", True, True, False, False, "5729")
    none_in, none_out, lv03 = (False, True, "", False, False, False, False, None), (False, False, "", False, False, False, False, None), (True, True, "LV03", False, False, False, False, None)
    cases = [
        (plain, geo.LV95, "ok"), (plain, geo.LV95_LN02, "set"), (c5728, geo.LV95, "set"), (c5728, geo.LV95_LN02, "ok"), (c5729, geo.LV95, "set"),
        (c5729, geo.LV95_LN02, "error"), (none_in, geo.LV95, "set"), (none_out, geo.LV95, "error"), (lv03, geo.LV95, "error"),
    ]
    df = spark.createDataFrame(cases, f"info {INFO}, target string, want string")
    for r in df.select("want", geo.crs_decision(F.col("info"), F.col("target"), F.lit(True)).alias("d")).collect():
        assert r.d.action == r.want
    files = spark.createDataFrame([("SB_DOP", "a.tif", lv03), ("SB_DOP", "b.tif", c5729), ("SB_DSM", "x_DSM.tif", plain), ("SB_DSM_PUNKTWOLKE", "p.laz", plain)], f"gds string, name string, info {INFO}")
    got = {r.name: r.action for r in C.crs_actions(files).collect()}
    assert got == {"a.tif": "retag", "b.tif": "warn", "x_DSM.tif": "set"}
    stops = {r.gds: r.stop for r in C.crs_summary(C.crs_actions(files), "gds").collect()}
    assert stops == {"SB_DOP": True, "SB_DSM": False}


def test_point_ranges(spark):
    a = spark.createDataFrame([("f", 1.0, 2.0, 2412.345, 1), ("f", 3.0, 4.0, 4190.1, 6)], "file string, x double, y double, z double, cls int")
    b = a.withColumns({"z": F.col("z") + 0.05, "cls": F.when(F.col("cls") == 1, 0).otherwise(F.col("cls"))})
    got = {r.dim: r.problem for r in P.compare_ranges(P.ranges(a, "file"), P.ranges(b, "file"), "file", 0.01).collect()}
    assert got == {"x": None, "y": None, "z": "low", "cls": "low"}
