"""What a query makes once a row, by its plan: values used more than once are columns, and casts get no texts that can't be cast."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from surveyspark.functions import names as N
from surveyspark.operators import manifest as M
from surveyspark.plans import file_queries

SF = "/root/testdata/sf0.001"


def plan(df):
    """The optimised plan, a line an operator."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tile_keys_split_a_name_once(spark):
    """The stem was made and split five times a row."""
    p = plan(file_queries.name_tilekey(spark, SF))
    assert p.count("regexp_replace(") == 1
    assert p.count("split(regexp_replace") == 1


@pytest.mark.parametrize("value", [N.las_origin, N.year_of])
def test_names_without_numbers_are_not_cast(spark, value):
    """try_cast of an empty text cost an exception a row."""
    p = plan(spark.range(1).select(F.col("id").cast("string").alias("name")).select(value(F.col("name")))).replace("else (", "else ")
    assert p.count("try_cast(") == p.count("null else try_cast(") > 0


def test_manifest_rows_are_counted_without_their_texts(spark):
    """The texts of all rows were made before a reader's choice of parts."""
    files = spark.createDataFrame([("1", "SB_DSM_PUNKTWOLKE", "a.laz", "m", "")], "ord string, gds string, name string, md5 string, footprint string")
    p = plan(M.csv_rows(files).filter("part = 0").select("ord"))
    assert "split(" not in p and "concat_ws(" not in p
    whole = plan(M.csv_rows(files))
    assert whole.count("split(regexp_replace(") == 1


def test_blank_lines_are_left_out_where_lines_are_made(spark):
    """The filter went below the rows' texts and made them, keys and stems and all, once more, in a method too long to be compiled."""
    p = plan(file_queries.manifest_append(spark, SF))
    assert not [x for x in p.splitlines() if "Filter" in x and ("concat_ws(" in x or "CASE" in x)]
    # the number of the last run is read without texts
    assert p.count("md5(") == 2


def test_blank_lines_are_no_rows(spark):
    old = spark.createDataFrame([(3, "a", 0, "x"), (3, "b", 0, " "), (3, "c", 0, None)], "run int, ord string, part int, line string")
    new = spark.createDataFrame([("d", 0, ""), ("e", 0, "y")], "ord string, part int, line string")
    assert sorted(map(tuple, M.append(old, new).collect())) == [(3, "a", 0, "x"), (4, "e", 0, "y")]


def test_documents_meet_no_other_documents(spark):
    """Files were joined to their own headers by a shuffle of all of them; only their deliveries' first headers are joined."""
    from surveyspark import rules
    from surveyspark.plans import catalog_queries, pipelines

    types = "delivery string, ord string, gds string, name string, nodata string, px double, py double, block int, width int, height int"
    files = spark.createDataFrame([("1", "a", "SB_DOP", "x.tif", "0", 0.1, -0.1, 512, 10, 20), ("1", "b", "SB_DOP", "y.tif", "0", 0.2, -0.2, 256, 11, 21), ("1", "c", "SB_DSM_PUNKTWOLKE", "z.laz", "", 0.3, -0.3, 1, 2, 3)], types)
    docs = pipelines.with_documents(files, catalog_queries._meta(files), rules.products(spark))
    assert plan(docs).count("Join ") == 3  # first headers, meta, products
    said = {r["name"]: ("<CellSize>0.1</CellSize>" in r["xml"], "<Width>10</Width>" in r["xml"]) for r in docs.collect()}
    assert said == {"x.tif": (True, True), "y.tif": (True, True), "z.laz": (False, False)}


def test_texts_are_read_once(spark):
    """Report, rows, documents and tiles read and cast all texts again, about a dozen times, and sent all points to all cells of the grid."""
    from surveyspark.plans import text_queries

    p = plan(text_queries.pipeline_text(spark, SF))
    assert "l_partkey" not in p and "split(value" not in p


def test_a_line_is_made_once_to_be_read(spark):
    """The test for blank lines went below the lines' texts and made them twice."""
    from surveyspark.operators import points as P
    from surveyspark.plans import text_queries

    lines = text_queries._lines(spark, SF)
    sniffed = spark.createDataFrame([("1", "xyz", " ", 0, 1, 3, None)], "file string, kind string, sep string, skip int, first_line long, columns int, problem string")
    assert plan(lines).count("concat_ws(") == plan(P.sniff(lines)).count("concat_ws(") == plan(P.xyz_points(lines, sniffed)).count("concat_ws(") == 1


def test_only_cells_with_points_are_kept(spark):
    from surveyspark.operators import points as P

    pts = spark.createDataFrame([(5.0, 5.0), (6.0, 7.0), (15.0, 5.0), (None, 1.0)], "x double, y double")
    cells = spark.createDataFrame([(0, 0, "a"), (0, 0, "again"), (1, 0, None), (2, 0, "c"), (None, 0, "d")], "ix int, iy int, name string")
    used = P.cells_in_use(pts, cells, 10)
    assert sorted(map(tuple, used.collect()), key=repr) == [(0, 0, "a"), (0, 0, "again"), (1, 0, None)]
    rows = lambda c: sorted(map(tuple, P.to_cells(pts, c, 10).collect()), key=repr)
    assert rows(used) == rows(cells)


def test_blank_lines_stay_out_of_texts(spark):
    """Blank lines are neither points nor ignored, wherever they stand; points outside the grid are told by the balance."""
    from surveyspark import rules
    from surveyspark.plans import catalog_queries, pipelines

    texts = ["", "x y z", " ", "2600000.10 1100000.20 300.004", "\t", "2600000.50 1100000.60 301.0", "2600000.5 x 1", "9.0 9.0 9.0", None]
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(texts)], "file string, line_no int, value string")
    cells = spark.createDataFrame([(2600, 1100, "2600_1100"), (2601, 1100, "2601_1100")], "ix int, iy int, name string")
    meta = catalog_queries._meta(spark.createDataFrame([("d",)], "delivery string"))
    out = pipelines.text_conversion(lines, cells, meta, rules.products(spark), "d", 2020, "BERN")
    s = out["sources"].first()
    assert (s.kind, s.points, s.ignored) == ("xyz", 3, 2)  # a tab is no blank line
    name = "2020_BERN_TIN_2600_1100_LV95_LN02.laz"
    assert [tuple(r) for r in out["report"].select("name", "points", "status").collect()] == [(name, 2, "ok")]
    assert sorted(round(r.z, 6) for r in out["tiles"].collect()) == [300.0, 301.0]
    assert [tuple(r) for r in out["balance"].collect()] == [(3, 2, 1, True)]
    assert [r.name for r in out["documents"].collect()] == [name] and out["rows"].count() == 2


def test_a_mask_is_made_once_to_be_cut_into_runs(spark):
    """The whole mask of a line was made again for each of its pixels, several times."""
    from surveyspark.operators import components as C

    scan = spark.createDataFrame([("t", 0, [255, 255, 1, 255]), ("t", 1, [])], "tile string, row int, band array<int>")
    runs = C.scan_runs(scan, F.transform("band", lambda v: v == 255))
    assert plan(runs).count("transform(band") == 1
    assert sorted(map(tuple, runs.collect())) == [("t", 0, 0, 1), ("t", 0, 3, 3)]


def test_scanlines_are_read_for_pixels_only(spark):
    """Each step that takes a row a tile (neighbours, empty tiles) went through all scanlines again."""
    from surveyspark.plans import catalog_queries

    p = plan(catalog_queries.pipeline_nodata(spark, SF))
    assert p.count("Relation [vec_id") == 1 and "forall(" not in p
