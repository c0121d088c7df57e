"""Queries over checks of headers, points, grids, packages and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import geo
from surveyspark.functions import names as N
from surveyspark.operators import catalog as C
from surveyspark.operators import headers as H
from surveyspark.operators import manifest as M
from surveyspark.operators import points as P
from surveyspark.operators import raster as R

from . import pipelines
from .catalog_queries import _meta
from .derive import V_FILE, V_POINT, V_SCAN, table, v_file, v_point, v_scan
from .point_queries import _SNIFF, _text
from .raster_queries import percentiles

HOST, HOST_INT = "catalog.example", "catalog-int.example"


def las_vlr_check(spark, sf_dir):
    """Records of the coordinate system in the header of each file; some lack one, its null byte, or have other heights."""
    p = v_point(spark, sf_dir).select("file").distinct()
    odd = lambda k: F.pmod("file", F.lit(k)) == 0
    record = lambda user, n, data: F.struct(F.lit(user).alias("user_id"), F.lit(n).alias("record_id"), data.alias("data"))
    keys = record("LASF_Projection", 34735, F.lit(b"\x01"))
    text = record("LASF_Projection", 2112, F.when(odd(5), F.encode(F.lit("WKT"), "utf-8")).otherwise(F.concat(F.encode(F.lit("WKT"), "utf-8"), F.lit(b"\x00"))))
    other = record("other", 34735, F.lit(b"\x00"))
    vlrs = F.when(odd(7), F.array(other)).when(odd(11), F.array(keys)).when(odd(13), F.array(other, text)).otherwise(F.array(keys, text))
    wkt = F.when(odd(17), "LHN95 height").when(odd(19), 'ID["EPSG",5729]').otherwise("LN02")
    return P.vlr_checks(p.select(F.col("file").alias("name"), F.when(~odd(23), vlrs).alias("vlrs"), wkt.alias("wkt"))).select("name", F.array_join("problems", ",").alias("problems"))


def header_box(spark, sf_dir):
    """Header boxes that are too high in some files and lack a field in others, against the points."""
    p = v_point(spark, sf_dir)
    r = P.ranges(p, "file", ("x", "y", "z")).select("file", "dim", F.col("low") / 100, F.col("high") / 100).toDF("file", "dim", "low", "high")
    odd = lambda k: F.pmod("file", F.lit(k)) == 0
    boxes = p.groupBy("file").agg(*[(f(c) / 100).alias(f"{n}{c}") for c in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))])
    boxes = boxes.withColumns({"maxz": F.col("maxz") + F.when(odd(5), 0.05).when(odd(3), 0.01).otherwise(0.0), "minx": F.when(~odd(7), F.col("minx")), "miny": F.col("miny") - F.when(odd(11), 1.0).otherwise(0.0)})
    return P.box_deviations(boxes, r.filter(~(odd(13) & (F.col("dim") == "y"))), "file").select("file", F.array_join("deviations", ",").alias("deviations"))


def rgb_ranges(spark, sf_dir):
    """Colour ranges of copies, which must be those of the source exactly."""
    p = v_point(spark, sf_dir).select("file", "red", F.pmod(F.col("x"), F.lit(65_536)).alias("green"), F.pmod(F.col("y"), F.lit(65_536)).alias("blue"))
    dims = ("red", "green", "blue")
    copy = p.filter(F.pmod("file", F.lit(29)) != 0).withColumn("green", F.col("green") + F.when(F.pmod("file", F.lit(7)) == 0, 1).otherwise(0))
    return P.compare_ranges(P.ranges(p, "file", dims), P.ranges(copy, "file", dims), "file", 0.0, exact=dims)


def ascii_columns(spark, sf_dir):
    """Column names and system of each text; those of one priority have a header line."""
    t = _text(spark, sf_dir)
    files = t.select("file").distinct()
    sep = F.when(F.col("file").endswith("-F"), ";").when(F.col("file").endswith("-O"), " ").otherwise(",")
    title = files.filter("file LIKE '1-%' OR file LIKE '2-%'").select("file", F.lit(-1).cast("long").alias("line_no"), F.concat(F.lit("Class"), sep, F.lit('"Y"'), sep, F.lit("h")).alias("value"))
    old = F.col("file").endswith("-P")
    x, y = F.when(old, "600000").otherwise("2600000"), F.when(old, "200000").otherwise("1200000")
    at = F.concat(x, sep, y, sep, F.lit("1"), F.when(F.col("file").startswith("2"), F.concat(sep, F.lit("5"))).otherwise(""))
    first = files.select("file", F.lit(0).cast("long").alias("line_no"), at.alias("value"))
    points = t.filter("line_no < 0").unionByName(first).unionByName(title)
    far = t.filter(F.col("file").startswith("4-")).unionByName(points)  # points near the origin, in neither system
    return P.text_columns(far, P.sniff(far)).select("file", F.array_join("names", ",").alias("names"), "crs")


def raster_alignment(spark, sf_dir):
    """Rasters of suppliers, some turned, shifted, with other pixels or bands, against the first of their delivery."""
    k, s = F.pmod("l_orderkey", F.lit(17)), F.pmod("l_suppkey", F.lit(3))
    gsd = F.when(s == 0, 0.5).when(s == 1, 0.25).otherwise(0.3)
    e, n = 2600 + F.pmod("l_partkey", F.lit(100)), 1100 + F.pmod("l_orderkey", F.lit(100))
    name = F.concat_ws("_", F.lit("2016_X_DOP"), e.cast("string"), n.cast("string"), F.when(k == 1, "LV95_x.tif").otherwise("LV95.tif"))
    gt = F.array(
        e * 1000.0 + F.when(k == 2, 0.125).when(k == 3, -400_000.0).otherwise(0.0), F.when(k == 4, 0.75).otherwise(gsd), F.when(k == 5, 0.5).otherwise(0.0),
        n * 1000.0 + 1000.0 + F.when(k == 6, 0.125).otherwise(0.0), F.lit(0.0), -F.when(k == 4, 0.75).otherwise(gsd),
    )
    f = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("delivery"), F.concat(F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.col("l_linenumber").cast("string"), F.lit("_"), name).alias("name"),
        gt.alias("gt"), F.when(s == 0, 2000).otherwise(4000).alias("nx"), F.when(s == 0, 2000).otherwise(4000).alias("ny"),
        F.when(k == 7, 4).otherwise(3).alias("bands"), F.when(k == 8, "UInt16").otherwise("Byte").alias("dtype"),
    )
    return H.grid_problems(f).select("delivery", "name", "on_grid", F.array_join("problems", ",").alias("problems"))


def precalc_spelling(spark, sf_dir):
    """Folders of packages: most have the one of precalculated formats, some in two spellings, some as a file."""
    k = F.pmod("o_orderkey", F.lit(9))
    name = F.when(k < 3, "PreCalculatedFormats").when((k == 3) & (F.pmod("o_custkey", F.lit(2)) == 0), "precalculatedformats").otherwise("NV")
    return M.precalc_folders(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("package"), name.alias("name"), (k != 2).alias("is_dir")))


def footprint_full(spark, sf_dir):
    """Footprints with all digits, of turned rasters with odd pixel sizes."""
    px = F.col("length") / 3_000_000.0
    gt = F.array(2_600_000 + F.col("l_partkey") / 8, px, F.when(F.pmod("l_suppkey", F.lit(3)) == 0, 0.1).otherwise(0.0), 1_200_000 + F.col("l_suppkey") / 16, F.lit(0.0), -px)
    f = v_file(spark, sf_dir).withColumn("gt", gt)
    return f.select("l_orderkey", "l_linenumber", geo.full_footprint(F.col("gt"), F.lit(100), F.lit(50), F.col("name")).alias("wkt"))


def srs_codes(spark, sf_dir):
    """Codes of systems as JSON: compound ones, single ones, of other authorities, broken text."""
    ident = lambda a, c: F.concat(F.lit('"id":{"authority":"'), F.lit(a), F.lit('","code":'), c, F.lit("}"))
    code = F.when(F.pmod("o_custkey", F.lit(3)) == 0, "5729").otherwise("5728")
    part = lambda kind, i: F.concat(F.lit(f'{{"type":"{kind}",'), i, F.lit("}"))
    flat, high = part("ProjectedCRS", ident("EPSG", F.lit("2056"))), part("VerticalCRS", ident("EPSG", code))
    k = F.pmod("o_orderkey", F.lit(7))
    both = lambda *parts: F.concat(F.lit('{"type":"CompoundCRS","components":['), F.concat_ws(",", *parts), F.lit("]}"))
    srs = (
        F.when(k == 0, flat).when(k == 1, both(flat, high)).when(k == 2, both(high, part("GeographicCRS", ident("EPSG", F.lit("4326"))), flat))
        .when(k == 3, both(flat, part("VerticalCRS", ident("OGC", F.lit("1"))))).when(k == 4, part("ProjectedCRS", ident("ESRI", F.lit("1")))).when(k == 5, F.lit("none"))
    )
    e = geo.resolved_epsg(srs)
    return table(spark, sf_dir, "orders").select("o_orderkey", e["horizontal"].alias("horizontal"), e["vertical"].alias("vertical"))


def format_problem(spark, sf_dir):
    """Why no point format fits: points of a file with or without colour, cameras with or without."""
    p = v_point(spark, sf_dir).groupBy("file").agg(F.max(F.when(F.pmod("file", F.lit(3)) == 0, F.col("red")).otherwise(0)).alias("red"))
    rgb, keep = geo.has_rgb(F.col("red"), F.lit(0), F.lit(0)), F.pmod("file", F.lit(2)) == 0
    return p.select("file", geo.point_format(rgb, keep).alias("format"), geo.point_format_problem(rgb, keep).alias("problem"))


def path_fields(spark, sf_dir):
    """Year, area, link and names of output tiles from target folders."""
    o = table(spark, sf_dir, "orders").withColumns({"k": F.pmod("o_orderkey", F.lit(4)), "y": F.year("o_orderdate").cast("string")})
    bucket = F.when(F.pmod("o_custkey", F.lit(2)) == 0, "BUCKET_INT").otherwise("BUCKET")
    last = F.when(F.col("k") == 0, F.concat(F.lit("2025_AREA_"), F.col("o_custkey").cast("string"), F.lit("_dop16_1005/"))).when(F.col("k") == 1, "2024_GRIES").when(F.col("k") == 2, "misc").otherwise("")
    path = F.concat(F.lit("/data/"), bucket, F.lit("/"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("2031/"), "y", F.lit("/"))).when(F.col("o_orderstatus") == "O", F.concat("y", F.lit("x/"))).otherwise(""), last)
    gds = F.element_at(F.array(*map(F.lit, ("SB_DOP", "SB_DSM", "OTHER"))), (F.pmod("o_custkey", F.lit(3)) + 1).cast("int"))
    area = N.area_of_target(path)
    return o.select("o_orderkey", N.year_of_path(path).alias("year"), area.alias("area"), N.catalog_link(gds, path, HOST, HOST_INT).alias("link"), N.point_tile_name(F.col("y"), area, F.lit("2600_1100")).alias("laz"), N.raster_tile_name(area, F.lit("2600_1100")).alias("tif"))


def unwanted_files(spark, sf_dir):
    return M.unwanted(v_file(spark, sf_dir)).select("l_orderkey", "l_linenumber", "name")


def queue_failed(spark, sf_dir):
    """Deliveries against waiting packages; some buckets have no catalog folder."""
    o = table(spark, sf_dir, "orders")
    d = o.select(F.col("o_orderkey").alias("delivery"), F.concat(F.lit("i"), F.expr("o_custkey div 4").cast("string")).alias("item"), F.lit("SB_DOP").alias("catalog"), F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("package"), F.pmod("o_custkey", F.lit(10)).alias("bucket"))
    waiting = d.filter(F.pmod("delivery", F.lit(3)) == 0).select(F.when(F.pmod("delivery", F.lit(2)) == 0, "SB_DOP").otherwise("SB_DSM").alias("catalog"), "package", "item", F.lit("A").alias("area"), F.lit(False).alias("unreadable"))
    return C.queue_status(d, waiting, d.filter("bucket < 8").select("bucket", "catalog"))


def conversion_summary(spark, sf_dir):
    """Results of conversions per product, with the files that have colour."""
    k = F.pmod("l_partkey", F.lit(100))
    status = F.when(k < 1, "failed").when(k < 10, "warning").when(k < 20, "skipped").otherwise("ok")
    return C.status_summary(v_file(spark, sf_dir).select("gds", "name", status.alias("status"), F.when(F.pmod("l_suppkey", F.lit(2)) == 0, 7).otherwise(6).alias("format")), "gds")


def overview(spark, sf_dir):
    """Previews of 10 pixels a side: 16-bit grey ones with a stretch, 8-bit ones of four bands."""
    s = v_scan(spark, sf_dir)
    flip = F.transform("band", lambda v: 255 - v)
    s = s.select("tile", "row", F.when(F.pmod("tile", F.lit(2)) == 0, F.array(F.transform("band", lambda v: v * 200))).otherwise(F.array(F.col("band"), flip, F.col("band"), flip)).alias("bands"))
    size = s.groupBy("tile").agg(F.lit(64).alias("width"), (F.max("row") + 1).alias("height")).withColumn("byte", F.pmod("tile", F.lit(2)) == 1)
    return R.overview(s, size, 10).select("tile", "r", "c", F.array_join("rgb", ",").alias("rgb"))


def pipeline_conversion(spark, sf_dir):
    """Conversion of a file per point file: refused sources, wrong headers, records, boxes and classes; documents and rows of the rest."""
    name = F.concat(F.lit("2025_AREA_TIN_"), (2600 + F.col("file")).cast("string"), F.lit("_1100_LV95_LN02.laz"))
    p = v_point(spark, sf_dir).select(name.alias("name"), F.col("file").alias("k"), "x", "y", "z", "cls")
    odd = lambda n: F.pmod("k", F.lit(n)) == 0
    copy = p.withColumn("cls", F.col("cls") - F.when(odd(19), 1).otherwise(0))
    heads = p.groupBy("name", "k").agg(F.count("*").alias("points"), *[f(c).alias(f"{n}{c}") for c in ("x", "y", "z") for n, f in (("min", F.min), ("max", F.max))])
    rgb = odd(3)
    source = heads.select("name", "points", F.lit("2056").alias("horizontal"), F.when(odd(23), "5729").otherwise("5728").alias("vertical"), F.lit("").alias("wkt"), rgb.alias("rgb"), F.when(odd(29), ~rgb).otherwise(rgb).alias("keep_rgb"))
    record = lambda n: F.struct(F.lit("LASF_Projection").alias("user_id"), F.lit(n).alias("record_id"), F.lit(b"\x00").alias("data"))
    target = heads.select(
        "name", (F.col("points") + F.when(odd(7), 1).otherwise(0)).alias("points"), F.when(odd(11), 2).otherwise(4).alias("minor_version"), F.when(rgb, 7).otherwise(6).alias("format"),
        F.when(rgb, 36).otherwise(30).alias("point_length"), F.lit(375).alias("header_size"), F.lit(17).alias("encoding"), F.lit("2056").alias("horizontal"), F.lit("5728").alias("vertical"),
        F.when(odd(13), F.array(record(2112))).otherwise(F.array(record(34735), record(2112))).alias("vlrs"), F.lit("").alias("wkt"), "minx", "maxx", "miny", "maxy", "minz",
        (F.col("maxz") + F.when(odd(17), 5).otherwise(0)).alias("maxz"),
    )
    files = heads.select(F.pmod("k", F.lit(5)).cast("string").alias("delivery"), F.col("k").cast("string").alias("ord"), F.lit("SB_DSM_PUNKTWOLKE").alias("gds"), "name", F.md5(F.encode("name", "utf-8")).alias("md5"), F.lit("").alias("nodata"))
    out = pipelines.point_conversion(files, _meta(files), rules.products(spark), source, target, P.ranges(p, "name"), P.ranges(copy, "name"))
    rows = out["rows"].groupBy(F.substring_index("ord", "|", -1).alias("ord")).agg(F.count("*").alias("n_rows"), F.max("line").alias("last_row"))
    docs = out["documents"].select("ord", "name", F.regexp_extract("xml", "<LineID>(.*)</LineID>", 1).alias("line_id")).join(rows, "ord").drop("ord")
    return out["report"].join(docs, "name", "left").select("name", "refused", F.coalesce(F.array_join("problems", ","), F.lit("")).alias("problems"), "status", "n_rows", "last_row", "line_id")


QUERIES = {
    f.__name__: f
    for f in (
        las_vlr_check, header_box, rgb_ranges, ascii_columns, raster_alignment, precalc_spelling, footprint_full, srs_codes, format_problem, path_fields,
        unwanted_files, queue_failed, conversion_summary, overview, pipeline_conversion,
    )
}

_CODE = "CASE WHEN o_custkey % 3 = 0 THEN 5729 ELSE 5728 END"
_DEV = lambda f, odd: f"CASE WHEN {odd} THEN '{f}' END"
_CH = "unnest(['red', 'green', 'blue']) AS dim, unnest([min(red), min(green), min(blue)])::DOUBLE AS low, unnest([max(red), max(green), max(blue)])::DOUBLE AS high"

ORACLE = {
    "pipeline_conversion": f"""WITH {V_POINT}, k AS (SELECT DISTINCT file AS k FROM v_point),
      c AS (SELECT k, '2025_AREA_TIN_' || (2600 + k) || '_1100_LV95_LN02.laz' AS name, CASE WHEN k % 23 = 0 THEN 'LHN95 heights'
          WHEN k % 29 = 0 THEN CASE WHEN k % 3 = 0 THEN 'colour, but a camera without' ELSE 'no colour, but a colour camera' END END AS refused,
          concat_ws(',', CASE WHEN k % 17 = 0 THEN 'box: maxz' END, CASE WHEN k % 7 = 0 THEN 'header: points' END, CASE WHEN k % 11 = 0 THEN 'header: version' END,
            CASE WHEN k % 19 = 0 THEN 'range: cls low' END, CASE WHEN k % 13 = 0 THEN 'record: no key directory' END) AS problems FROM k),
      s AS (SELECT *, refused IS NULL AND problems = '' AS fine FROM c)
      SELECT name, refused, problems, CASE WHEN fine THEN 'ok' ELSE 'failed' END AS status, CASE WHEN fine THEN 2 END AS n_rows,
        CASE WHEN fine THEN 'PreCalculatedFormats\\SB_DSM_PUNKTWOLKE\\SB_DSM_PUNKTWOLKE_LAZ_CHLV95_LN02_' || (2600 + k) || '_1100.laz;' || md5(name) || ';' || (2600 + k) || '_1100;add;' END AS last_row,
        CASE WHEN fine THEN 'L' || (k % 5) END AS line_id FROM s""",
    "las_vlr_check": f"""WITH {V_POINT}, k AS (SELECT DISTINCT file FROM v_point),
      h AS (SELECT file, file % 7 <> 0 AND file % 23 <> 0 AND (file % 11 = 0 OR file % 13 <> 0) AS keys, file % 7 <> 0 AND file % 23 <> 0 AND file % 11 <> 0 AS txt FROM k)
      SELECT file AS name, concat_ws(',', CASE WHEN NOT keys THEN 'no key directory' END, CASE WHEN NOT txt THEN 'no WKT' WHEN file % 5 = 0 THEN 'WKT without null byte' END,
        CASE WHEN file % 17 = 0 OR file % 19 = 0 THEN 'LHN95' END) AS problems FROM h""",
    "header_box": f"""WITH {V_POINT}, k AS (SELECT DISTINCT file FROM v_point)
      SELECT file, concat_ws(',', {_DEV("minx missing", "file % 7 = 0")}, CASE WHEN file % 13 = 0 THEN 'miny missing,maxy missing' WHEN file % 11 = 0 THEN 'miny' END,
        {_DEV("maxz", "file % 5 = 0")}) AS deviations FROM k""",
    "rgb_ranges": f"""WITH {V_POINT}, p AS (SELECT file, red, x % 65536 AS green, y % 65536 AS blue FROM v_point),
      q AS (SELECT * REPLACE (green + CASE WHEN file % 7 = 0 THEN 1 ELSE 0 END AS green) FROM p WHERE file % 29 <> 0),
      s AS (SELECT file, {_CH} FROM p GROUP BY file), t AS (SELECT file, {_CH} FROM q GROUP BY file)
      SELECT s.file, s.dim, CASE WHEN t.low IS NULL THEN 'missing' WHEN s.low <> t.low THEN 'low' WHEN s.high <> t.high THEN 'high' END AS problem
      FROM s LEFT JOIN t ON t.file = s.file AND t.dim = s.dim""",
    "ascii_columns": f"""WITH {_SNIFF}, g AS (SELECT file, substr(file, 1, 1) AS p, substr(file, 3) = 'P' AS old FROM f)
      SELECT file, CASE WHEN p = '1' THEN 'Classification,Y,Z' WHEN p = '2' THEN 'X,Y,Z,Col4' ELSE 'X,Y,Z' END AS names,
        CASE WHEN p = '4' THEN 'unknown' WHEN old THEN 'LV03' ELSE 'LV95' END AS crs FROM g""",
    "raster_alignment": """WITH r AS (SELECT *, l_orderkey % 17 AS k, l_suppkey % 3 AS s, 2600 + l_partkey % 100 AS e, 1100 + l_orderkey % 100 AS n FROM lineitem),
      q AS (SELECT *, l_suppkey AS delivery, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || l_linenumber || '_2016_X_DOP_' || e || '_' || n || CASE WHEN k = 1 THEN '_LV95_x.tif' ELSE '_LV95.tif' END AS name,
          CASE WHEN k = 4 THEN 0.75 WHEN s = 0 THEN 0.5 WHEN s = 1 THEN 0.25 ELSE 0.3 END::DOUBLE AS px, CASE WHEN s = 0 THEN 2000 ELSE 4000 END AS nx,
          e * 1000.0::DOUBLE + CASE k WHEN 2 THEN 0.125 WHEN 3 THEN -400000 ELSE 0 END AS x, n * 1000.0::DOUBLE + 1000 + CASE WHEN k = 6 THEN 0.125 ELSE 0 END AS y,
          CASE WHEN k = 7 THEN '4' ELSE '3' END || CASE WHEN k = 8 THEN 'UInt16' ELSE 'Byte' END AS form FROM r),
      w AS (SELECT *, first_value(px) OVER a AS gsd, first_value(form) OVER a AS form0, x + nx * px AS maxx, y - nx * px AS miny FROM q WINDOW a AS (PARTITION BY delivery ORDER BY name))
      SELECT delivery, name, k <> 1 AND abs(maxx - x - 1000) < 1e-6 AND abs(y - miny - 1000) < 1e-6 AND k NOT IN (2, 6) AS on_grid,
        concat_ws(',', CASE WHEN k = 5 THEN 'rotated' END, CASE WHEN abs(px - gsd) > 1e-9 THEN 'pixel size' END, CASE WHEN form <> form0 THEN 'bands' END,
          CASE WHEN x < 2400000 OR maxx > 2900000 OR miny < 1000000 OR y > 1400000 THEN 'not LV95' END, CASE WHEN abs(x / gsd - round(x / gsd)) > 1e-6 THEN 'x off raster' END,
          CASE WHEN abs(y / gsd - round(y / gsd)) > 1e-6 THEN 'y off raster' END, CASE WHEN abs(1000 / gsd - round(1000 / gsd)) > 1e-6 THEN 'cell size' END) AS problems FROM w""",
    "precalc_spelling": """WITH e AS (SELECT o_custkey AS package, o_orderkey % 9 AS k, CASE WHEN o_orderkey % 9 < 3 THEN 'PreCalculatedFormats'
          WHEN o_orderkey % 9 = 3 AND o_custkey % 2 = 0 THEN 'precalculatedformats' END AS name FROM orders),
      g AS (SELECT package, list_sort(list(DISTINCT name) FILTER (WHERE name IS NOT NULL AND k <> 2)) AS names FROM e GROUP BY package)
      SELECT package, CASE WHEN len(names) = 1 THEN names[1] END AS folder,
        CASE WHEN coalesce(len(names), 0) = 0 THEN 'missing' WHEN len(names) > 1 THEN 'several: ' || array_to_string(names, ', ') END AS problem FROM g""",
    "footprint_full": f"""WITH {V_FILE}, g AS (SELECT l_orderkey, l_linenumber, name, 2600000 + l_partkey / 8.0::DOUBLE AS x, 1200000 + l_suppkey / 16.0::DOUBLE AS y,
          length / 3000000.0::DOUBLE AS px, CASE WHEN l_suppkey % 3 = 0 THEN 0.1 ELSE 0.0 END::DOUBLE AS t FROM v_file),
      c AS (SELECT *, x + 50 * t AS llx, x + 100 * px + 50 * t AS lrx, x + 100 * px + 0 * t AS urx, y + 50 * -px AS ly FROM g)
      SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(lower(name), '\\.tiff?$') THEN
        'POLYGON ((' || llx || ' ' || ly || ', ' || lrx || ' ' || ly || ', ' || urx || ' ' || y || ', ' || x || ' ' || y || ', ' || llx || ' ' || ly || '))' ELSE '' END AS wkt FROM c""",
    "srs_codes": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 4 THEN 2056 END AS horizontal, CASE WHEN o_orderkey % 7 IN (1, 2) THEN {_CODE} END AS vertical FROM orders""",
    "format_problem": f"""WITH {V_POINT}, p AS (SELECT file, file % 3 = 0 AND max(red) > 0 AS rgb, file % 2 = 0 AS keep FROM v_point GROUP BY file)
      SELECT file, CASE WHEN rgb AND keep THEN 7 WHEN NOT rgb AND NOT keep THEN 6 END AS format,
        CASE WHEN keep AND NOT rgb THEN 'no colour, but a colour camera' WHEN rgb AND NOT keep THEN 'colour, but a camera without' END AS problem FROM p""",
    "path_fields": f"""WITH o AS (SELECT *, o_orderkey % 4 AS k, CAST(year(o_orderdate) AS VARCHAR) AS y,
          ['SB_DOP', 'SB_DSM', 'OTHER'][o_custkey % 3 + 1] AS gds, CASE WHEN o_custkey % 2 = 0 THEN 'BUCKET_INT' ELSE 'BUCKET' END AS bucket FROM orders),
      q AS (SELECT *, CASE k WHEN 0 THEN 'AREA_' || o_custkey WHEN 1 THEN 'GRIES' WHEN 2 THEN 'misc'
          ELSE CASE o_orderstatus WHEN 'F' THEN y WHEN 'O' THEN y || 'x' ELSE bucket END END AS area FROM o)
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(CASE WHEN y LIKE '20%' THEN y ELSE '2031' END AS INTEGER) END AS year, area,
        CASE WHEN gds = 'OTHER' THEN '' ELSE 'https://' || CASE WHEN bucket = 'BUCKET_INT' THEN '{HOST_INT}' ELSE '{HOST}' END || '/catalog-ng/catalog/' || gds || '/import' END AS link,
        y || '_' || area || '_TIN_2600_1100_LV95_LN02.laz' AS laz, area || '_2600_1100_LV95.tif' AS tif FROM q""",
    "unwanted_files": f"WITH {V_FILE} SELECT l_orderkey, l_linenumber, name FROM v_file WHERE regexp_matches(lower(name), '\\.(pyr|xml|rdx)$')",
    "queue_failed": """WITH d AS (SELECT o_orderkey AS delivery, 'i' || (o_custkey // 4) AS item, o_custkey % 10 AS bucket FROM orders),
      w AS (SELECT item, delivery AS owner, delivery % 2 = 0 AS same FROM d WHERE delivery % 3 = 0),
      j AS (SELECT d.delivery, d.bucket, count(w.item) FILTER (WHERE NOT (same AND owner = d.delivery)) AS hits, coalesce(bool_or(same AND owner <> d.delivery), false) AS bad
        FROM d LEFT JOIN w ON w.item = d.item GROUP BY ALL)
      SELECT delivery, CASE WHEN bucket >= 8 THEN 'failed' WHEN bad THEN 'conflict' ELSE 'ok' END AS status, CASE WHEN bucket >= 8 THEN 0 ELSE hits END AS hits FROM j""",
    "conversion_summary": f"""WITH {V_FILE}, s AS (SELECT gds, l_suppkey % 2 = 0 AS colour, l_partkey % 100 AS k FROM v_file)
      SELECT gds, count(*) AS total, count(*) FILTER (WHERE k >= 20) AS ok, count(*) FILTER (WHERE k BETWEEN 1 AND 9) AS warning, count(*) FILTER (WHERE k BETWEEN 10 AND 19) AS skipped,
        count(*) FILTER (WHERE k < 1) AS failed, count(*) FILTER (WHERE colour AND k >= 1) AS pf7 FROM s GROUP BY gds""",
    "overview": f"""WITH {V_SCAN}, z AS (SELECT tile, max(row) + 1 AS h FROM v_pix GROUP BY tile),
      b AS (SELECT p.tile, row, col, h, val, unnest(CASE WHEN p.tile % 2 = 0 THEN [0] ELSE [0, 1, 2] END) AS band FROM v_pix p JOIN z USING (tile)),
      m AS (SELECT tile, band, CAST(floor(row * greatest(1, round_even(h * (10.0::DOUBLE / 64), 0)) / h) AS INTEGER) AS r, CAST(col * 10 // 64 AS INTEGER) AS c,
          avg(CASE WHEN tile % 2 = 0 THEN val * 200 WHEN band = 1 THEN 255 - val ELSE val END) AS v FROM b GROUP BY ALL),
      e AS ({percentiles('m', 'v')}),
      s AS (SELECT m.tile, r, c, band, CAST(floor(greatest(0, least(255, CASE WHEN m.tile % 2 = 1 THEN v
          ELSE (v - low) * (255.0::DOUBLE / CASE WHEN high > low THEN high - low ELSE 1 END) END))) AS INTEGER) AS g FROM m JOIN e USING (tile))
      SELECT tile, r, c, CASE WHEN tile % 2 = 0 THEN any_value(g || ',' || g || ',' || g) ELSE string_agg(g, ',' ORDER BY band) END AS rgb FROM s GROUP BY tile, r, c""",
}
