"""The scalar rules as SQL functions give what their columns give."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from surveyspark.functions import geo, lines, names, pixels, sqlfunctions
from surveyspark.plans import sql_queries
from surveyspark.plans.derive import v_file, v_line

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def registered(spark):
    return sqlfunctions.register(spark, ("catalog.example", "int.example"))


def test_all_scalars_are_there(spark, registered):
    assert len(registered) > 70
    known = {r[0].rsplit(".", 1)[-1] for r in spark.sql("SHOW USER FUNCTIONS LIKE 'survey_*'").collect()}
    assert known >= set(registered)


def test_functions_of_names_and_lines_on_tables(spark, registered):
    tables = {"v": v_line(spark, DATA), "f": v_file(spark, DATA).withColumn("year", F.lit(2020))}
    own = {lines: ["line_id", "camera"], names: ["name", "gds"]}
    checked = 0
    for name, (f, fixed) in sqlfunctions.scalars().items():
        module = {m.__name__: m for m in (lines, names)}.get(f.__module__)
        if module is None or fixed:
            continue
        taken = re.search(r"FUNCTION \w+\((.*?)\) RETURN", sqlfunctions.definition(name, f, fixed))[1]
        given = [x.split(" ")[0].strip("`") for x in taken.split(", `")]
        if not set(given) <= set(own[module]):
            continue
        df = tables["v" if module is lines else "f"].select(*own[module]).distinct()
        both = df.select(f(*[F.col(c) for c in given]).alias("a"), F.expr(f"{name}({', '.join(given)})").alias("b"))
        assert both.filter("NOT (to_json(struct(a)) <=> to_json(struct(b AS a)))").isEmpty(), name
        checked += 1
    assert checked >= 15


@pytest.mark.parametrize(
    ("call", "column"),
    [
        ("survey_thresholds(0.1D, -0.1D).contact_px", lambda: geo.thresholds(F.lit(0.1), F.lit(-0.1))["contact_px"]),
        ("survey_requantised(1.005D, 0D)", lambda: geo.requantised(F.lit(1.005), F.lit(0.0))),
        ("survey_frame_violation(2600000.0D, 2600999.99D + 0.021D, 1100000.0D, 1100999.0D, 2600, 1100)", lambda: geo.frame_violation(F.lit(2600000.0), F.lit(2600999.99) + 0.021, F.lit(1100000.0), F.lit(1100999.0), F.lit(2600), F.lit(1100))),
        ("to_json(survey_runs(array(true, false, true, true)))", lambda: F.to_json(pixels.runs(F.array(F.lit(True), F.lit(False), F.lit(True), F.lit(True))))),
        ("survey_rescaled(array(0, 1, 127, 255))", lambda: pixels.rescaled(F.array(*map(F.lit, (0, 1, 127, 255))), 225)),
        ("survey_shadow_lifts(array(0, 9), array(1, 9), array(2, 9))", lambda: pixels.shadow_lifts(*[F.array(F.lit(k), F.lit(9)) for k in (0, 1, 2)])),
        ("survey_nodata_mask(array(array(1D, 2D), array(1D, 1D)), array(1D, 1D))", lambda: F.array(F.lit(False), F.lit(True))),
        ("survey_catalog_link('SB_DOP', 'x/BUCKET_INT/y')", lambda: F.lit("https://int.example/catalog-ng/catalog/SB_DOP/import")),
        ("survey_vertical_epsg_of(array(named_struct('type', 'VerticalCRS', 'authority', 'EPSG', 'code', '5728')))", lambda: F.lit("5728")),
        ("survey_item_id_valid(survey_item_id('kry', '2026-08-13t08222100'))", lambda: F.lit(True)),
    ],
)
def test_calls(spark, registered, call, column):
    row = spark.range(1).select(F.expr(call).alias("a"), column().alias("b")).first()
    assert row.a == row.b


def test_plans_hold_no_python(spark):
    for f in sql_queries.QUERIES.values():
        plan = f(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_parameters_take_their_declared_types(spark):
    """No session functions here: each rule gets columns of the types that its definition declares."""
    wrong = []
    for name, (f, fixed) in sqlfunctions.scalars().items():
        given = re.search(r"FUNCTION \w+\((.*?)\) RETURN", sqlfunctions.definition(name, f, fixed))[1]
        typed = [re.match(r"`(\w+)` (.*)", x).groups() for x in re.split(r", (?=`)", given) if x]
        row = spark.range(1).select(*[F.lit(None).cast(t).alias(p) for p, t in typed])
        try:
            row.select(f(*[F.col(p) for p, _ in typed], **fixed)).schema
        except AnalysisException as e:
            wrong.append((name, e.getCondition()))
    assert not wrong


def test_tile_key_of_takes_parts(spark, registered):
    odd = ["2020_AROSA_TIN_2600_1200_LV95_LN02.laz", "2600_1200_LV95.tif", "1200_LV95.tif", "LV95", "a_b_lv95.tif", "a__LV95_b_LV95.tif", "", None]
    df = spark.createDataFrame([(x,) for x in odd], "name string")
    got = df.select(F.expr("survey_tile_key_of(survey_parts(name))").alias("a"), names.tile_key(F.col("name")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] == ["2600_1200", "2600_1200", "UNKNOWN", "UNKNOWN", "UNKNOWN", "a_", "UNKNOWN", "UNKNOWN"]


def test_sql_files_of_a_new_session(spark, tmp_path):
    own = spark.newSession()  # has no functions yet
    keys = [(0, 8, 1, 1), (2, 6, 13, 1), (0, 1, 1, 1), (4, 4, 2, 2)]  # a DOP, a hillshade without tile numbers, a world file, a lower-case lv95
    own.createDataFrame([(*k, 1.0) for k in keys], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(tuple(r) for r in sql_queries.sql_files(own, str(tmp_path)).collect())
    assert got == [("BERN", 2, 0, 1, 2601, "255", "DSM"), ("SILVRETTA", 1, 1, 0, None, "0", "DSM")]


def test_sql_lines_of_a_new_session(spark, tmp_path):
    own = spark.newSession()  # has no functions yet
    day = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901, datetime.UTC)
    rows = [(6, day, 7, "view"), (97, day, 7, "click"), (3, day, 7, "purchase")]  # two DMC lines, one of them with another start, and an ADS line
    own.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in sql_queries.sql_lines(own, str(tmp_path)).collect())
    assert got == [
        (3, True, "0304", None, "2024-01-02T03:04:00.00", "2024-01-02t03040568"),
        (6, True, "0304", "20240102_0304_41216", "2024-01-02T03:04:05.00", "2024-01-02t03040000"),
        (97, True, "0304", "20240102_1759_41216", "2024-01-02T03:04:05.00", "2024-01-02t03040500"),
    ]
