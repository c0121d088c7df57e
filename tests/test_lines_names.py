"""Line ids and file names: examples with their known results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import lines as L
from surveyspark.functions import names as N
from surveyspark.operators import deliveries as D
from surveyspark.operators import manifest as M


def test_parse_line_id(spark):
    cases = {
        "20230820_0921": (2023, 8, 20, 9, 21, 0, 0), "20230820_092130": (2023, 8, 20, 9, 21, 30, 0), "20230820_09213045": (2023, 8, 20, 9, 21, 30, 45),
        "20230820_092130456": (2023, 8, 20, 9, 21, 30, 46), "20230820_092130999": (2023, 8, 20, 9, 21, 30, 99), "20200913_1054_12501": (2020, 9, 13, 10, 54, 0, 0),
        "20230820_092130445": (2023, 8, 20, 9, 21, 30, 44), "20230820_092130455": (2023, 8, 20, 9, 21, 30, 46), "20230820": None, "": None, "x_y": None, None: None,
        "20231320_0921": (2023, 13, 20, 9, 21, 0, 0), "20230820_0921305": (2023, 8, 20, 9, 21, 30, 0), "20230820_09213": (2023, 8, 20, 9, 21, 0, 0),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "id string").withColumn("t", L.parse_line_id(F.col("id"))).collect()
    assert {r.id: r.t and tuple(r.t) for r in rows} == cases
    got = spark.createDataFrame([("20230820_09213045",), ("kaputt",)], "id string").select(L.iso8601(L.parse_line_id(F.col("id"))), L.stac_time(L.parse_line_id(F.col("id")))).collect()
    assert [tuple(r) for r in got] == [("2023-08-20T09:21:30.45", "2023-08-20t09213045"), ("UNKNOWN", "UNKNOWN")]


DELIVERIES = [
    ("a", rules.DMC, ["20260813_0822_41216_004_082750", "20260813_0822_41216_003_082221"]),
    ("b", rules.DMC, ["20260813_0822_41216_009_085104", "20260813_0822_41216_008_084617"]),
    ("c", rules.DMC, ["20260813_0822_41216_003_082221", "20260813_0915_41216_001_091530"]),
    ("d", rules.ADS100, ["20200913_1104_12501", "20200913_1054_12501"]),
    ("e", rules.DMC, ["kaputt"]),
]


@pytest.fixture
def entered(spark):
    return spark.createDataFrame([(d, c, i, x) for d, c, ids in DELIVERIES for i, x in enumerate(ids)], "delivery string, camera string, ord long, line_id string")


def test_delivery_fields(entered):
    got = {r.delivery: r for r in D.delivery_fields(entered).collect()}
    assert (got["a"].first_acquisition, got["a"].stac_time, got["a"].band_id, got["a"].year) == ("2026-08-13T08:22:21.00", "2026-08-13t08222100", "0822", "2026")
    assert (got["b"].band_id, got["b"].first_acquisition) == ("0846", "2026-08-13T08:46:17.00")
    assert (got["d"].line_ids, got["d"].band_id) == ("20200913_1104_12501,20200913_1054_12501", "1104")
    assert [tuple(r) for r in D.foreign_lines(entered).select("delivery", "expected", "foreign").collect()] == [
        ("c", "20260813_0822_41216", "20260813_0915_41216_001_091530")
    ]


def test_delivery_stac_time(spark):
    df = spark.createDataFrame(DELIVERIES, "d string, camera string, ids array<string>")
    got = {r.d: r.s for r in df.select("d", L.delivery_stac_time(F.col("ids"), F.col("camera")).alias("s")).collect()}
    assert got == {"a": "2026-08-13t08222100", "b": "2026-08-13t08461700", "c": "—", "d": "2020-09-13t11040000", "e": "—"}
    items = spark.createDataFrame([("kry-2026-08-13t08222100",), ("kry-—",), (None,)], "i string").select(L.item_id_valid(F.col("i"))).collect()
    assert [r[0] for r in items] == [True, False, False]


def test_names(spark):
    cases = [
        ("SB_DOP", "2025_PLAINE_MORTE_DOP_1005NRGB_2601_1136_LV95.tif", "PLAINE_MORTE", "2601_1136", "1005", False),
        ("SB_DSM_PUNKTWOLKE", "2025_PLAINE_MORTE_TIN_2601_1136_LV95_LN02.laz", "PLAINE_MORTE", "2601_1136", None, False),
        ("SB_DSM", "2025_PLAINE_MORTE_hillshade_1000.tif", "PLAINE_MORTE", "UNKNOWN", None, True),
        ("SB_DOP", "2025_BERN_DOP_0001_LV95.tif", "BERN", "DOP_0001", None, False),
        ("SB_DSM", "2016_SILVRETTA_DSM_1m_LV95_LN02_GG_wf_raw_HS.tif", "SILVRETTA", "DSM_1m", None, True),
        ("SB_DOP", "kein_jahres_prefix.tif", "UNKNOWN", "UNKNOWN", None, False),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "gds string, name string")
    n, g = F.col("name"), F.col("gds")
    got = df.select(g, n, N.area(n, g), N.tile_key(n), N.line_token(n), N.is_hillshade(n)).collect()
    assert [tuple(r) for r in got] == cases


def test_nodata_and_layout(spark):
    df = spark.createDataFrame([("SB_DOP", "a.tif", "255 255 255", 3), ("SB_DOP", "a.tif", "255", 4), ("SB_DOP", "a.tif", "0 0", 3), ("SB_DSM", "x_DSM_1.tif", None, 1)], "gds string, name string, v string, b int")
    n, g = F.col("name"), F.col("gds")
    got = df.select(N.nodata_output(g, N.nodata_source(n, g, F.col("v"))), N.nodata_bands(F.col("v"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("0 0 0", ["255"] * 3), ("0", ["255"] * 4), ("0 0", None), ("-3.4028235e+38", None)]
    rows = spark.createDataFrame([(1, "SB_DSM_PUNKTWOLKE", "2025_A_TIN_2601_1136_LV95_LN02.laz", "m", ""), (2, "SB_DOP", "2025_A_DOP_2601_1136_LV95.tiff", "m", "")], "ord int, gds string, name string, md5 string, footprint string")
    assert [r.line for r in M.csv_rows(rows).orderBy("ord", "part").collect()] == [
        "NV\\SB_DSM_PUNKTWOLKE\\2025_A_TIN_2601_1136_LV95_LN02.laz;m;2601_1136;add;",
        "PreCalculatedFormats\\SB_DSM_PUNKTWOLKE\\SB_DSM_PUNKTWOLKE_LAZ_CHLV95_LN02_2601_1136.laz;m;2601_1136;add;",
    ]


def test_append_and_merge(spark):
    old = spark.createDataFrame([(0, "a", 0, "x"), (0, "b", 0, " ")], "run int, ord string, part int, line string")
    new = spark.createDataFrame([("a", 0, "y")], "ord string, part int, line string")
    assert [tuple(r) for r in M.append(old, new).orderBy("run").collect()] == [(0, "a", 0, "x"), (1, "a", 0, "y")]
    first = M.append(old.limit(0), new).collect()
    assert [r.run for r in first] == [0]
    a = spark.createDataFrame([("k1", 1), ("k2", 1)], "k string, v int")
    b = spark.createDataFrame([("k2", 2), ("k3", 2)], "k string, v int")
    assert sorted(map(tuple, M.merge_trees(a, b, "k").collect())) == [("k1", 1), ("k2", 2), ("k3", 2)]
