"""Queries over coordinate systems, catalog items, waiting packages and whole deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import geo, xmlout
from surveyspark.functions import names as N
from surveyspark.operators import catalog as C
from surveyspark.operators import points as P
from surveyspark.sources.files import package_xml

from . import pipelines
from .derive import V_FILE, V_SCAN, table, v_file, v_point, v_scan, v_tile
from .file_queries import _CSV, _EXT, _KEY
from .header_queries import _RASTERS, raster_columns
from .point_queries import _COARSE
from .raster_queries import ORACLE as RASTER


def _bit(k):
    return F.pmod(F.expr(f"l_partkey div {2**k}"), F.lit(2)) == 1


def _info():
    """CRS flags from the bits of a key."""
    return F.struct(
        _bit(0).alias("has_crs"), _bit(1).alias("in_lv95_extent"), F.lit("X").alias("name"), _bit(2).alias("is_compound"),
        (F.pmod("l_suppkey", F.lit(3)) != 0).alias("horizontal_is_lv95"), (F.pmod("l_suppkey", F.lit(7)) == 0).alias("lv95_equivalent"),
        (F.pmod("l_suppkey", F.lit(5)) == 0).alias("local_only"), F.when(_bit(3), "5728").when(_bit(4), "5729").alias("vertical_epsg"),
    )


def crs_decision(spark, sf_dir):
    f = v_file(spark, sf_dir).withColumns({"info": _info(), "target": geo.crs_target(F.col("gds"), F.col("name"))}).filter("target IS NOT NULL")
    d = geo.crs_decision(F.col("info"), F.col("target"), ~F.col("gds").isin(*geo.DOP))
    return f.select(
        "l_partkey", "l_suppkey", "gds", "name", "target", d["action"].alias("action"), d["message"].alias("message"),
        geo.vertical_warning(F.col("gds"), F.col("info")).alias("vertical_warning"), geo.retag_allowed(F.col("gds"), F.col("info")).alias("retag"),
    )


def crs_summary(spark, sf_dir):
    f = v_file(spark, sf_dir).select("gds", "name", _info().alias("info"))
    return C.crs_summary(C.crs_actions(f), "gds")


def point_crs_gate(spark, sf_dir):
    """Codes from component lists, the last of a type counting; some name heights in the text only."""
    f = v_file(spark, sf_dir)
    comp = lambda t, c: F.struct(F.lit(t).alias("type"), F.lit("EPSG").alias("authority"), c.alias("code"))
    h = F.when(F.pmod("l_suppkey", F.lit(9)) == 0, "21781").otherwise("2056")
    v = F.when(_bit(0), "5728").when(_bit(1), "5729").otherwise("5710")
    parts = F.when(_bit(4), F.array(comp("Projected", h))).otherwise(F.array(comp("Vertical", F.lit("1")), comp("Projected", h), comp("Vertical", v)))
    wkt = F.when(F.pmod("l_suppkey", F.lit(11)) == 0, "VERT_CS[lhn95]")
    f = f.select("l_partkey", "l_suppkey", parts.alias("c"), wkt.alias("wkt"))
    hz, vt = geo.epsg_of(F.col("c"), "Projected"), geo.epsg_of(F.col("c"), "Vertical")
    return f.select("l_partkey", "l_suppkey", hz.alias("horizontal"), vt.alias("vertical"), geo.point_crs_problem(hz, vt, F.col("wkt")).alias("problem"))


def _items(spark, sf_dir):
    """Catalog items: one per order day and type, with the assets that the day's orders name."""
    o = table(spark, sf_dir, "orders").select(*_order_cols())
    made = o.filter(F.pmod("k", F.lit(3)) != 0).select("item", F.explode(F.filter(F.array(
        F.when(F.pmod(F.expr("k div 2"), F.lit(2)) == 1, F.concat("item", F.lit("-rgb-mosaic.tif"))),
        F.when(F.pmod(F.expr("k div 4"), F.lit(2)) == 1, F.concat("item", F.lit("-dsm-raster.tif"))),
        F.concat("item", F.lit("-thumbnail.png")),
    ), lambda x: x.isNotNull())).alias("asset"), "day")
    items = made.groupBy("item").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("asset", F.lit("x").alias("v"))))).alias("assets"), F.max("day").alias("updated"))
    return items


def _order_cols():
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.element_at(F.array(*[F.lit(x) for x in rules.ORDER_TYPES]), (F.pmod("o_custkey", F.lit(5)) + 1).cast("int"))
    k = F.col("o_orderkey")
    gds = F.element_at(F.array(*[F.lit(x) for x in rules.PRODUCTS]), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    item = F.concat(kind, F.lit("-"), day, F.lit("t"), F.lpad((F.pmod("o_custkey", F.lit(4)) * 100 + 900).cast("string"), 4, "0"), F.lit("0000"))
    item = F.when(F.pmod(k, F.lit(41)) == 0, F.concat(F.upper(kind), F.lit("-x"))).otherwise(item)
    return k.alias("k"), item.alias("item"), gds.alias("gds"), day.alias("day"), F.col("o_custkey").alias("c")


def _deliveries(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(*_order_cols())
    return o.select(F.col("k").alias("delivery"), "item", "gds", F.lit(False).alias("is_dmc"), F.col("gds").alias("catalog"), F.concat(F.lit("P"), F.col("k").cast("string")).alias("package"), "day", "c")


def stac_conflict(spark, sf_dir):
    out = C.asset_conflicts(_deliveries(spark, sf_dir), _items(spark, sf_dir), rules.products(spark))
    return out.select("delivery", "item", "status", F.array_join("conflict", ",").alias("conflict"), "updated")


def _packages(spark, sf_dir):
    """Documents of waiting packages, two files each; some are broken."""
    d = _deliveries(spark, sf_dir).filter(F.pmod("delivery", F.lit(6)) == 1)
    doc = lambda area: xmlout.document([("Auftragstyp", F.substring("item", 1, 3)), ("Area", area), ("StacItemIdDatetime", F.substring("item", 5, 100))])
    whole = doc(F.concat(F.lit("A"), F.pmod("c", F.lit(7)).cast("string")))
    broken = F.when(F.pmod("c", F.lit(13)) == 0, F.substring(whole, 1, 90)).otherwise(whole)
    files = F.array(
        F.struct(F.concat_ws("/", F.lit("b"), "catalog", "package", F.lit("NV/DSM/a.xml")).alias("path"), doc(F.lit("later")).alias("xml")),
        F.struct(F.concat_ws("/", F.lit("b"), "catalog", "package", F.lit("NV/b.xml")).alias("path"), broken.alias("xml")),
        F.struct(F.concat_ws("/", F.lit("b"), "catalog", "package", F.lit("NV/x/y/0.xml")).alias("path"), F.lit("deep").alias("xml")),
    )
    return d.select("catalog", "package", F.inline(files))


def package_items(spark, sf_dir):
    return package_xml(_packages(spark, sf_dir))


def queue_conflict(spark, sf_dir):
    return C.queue_conflicts(_deliveries(spark, sf_dir), package_xml(_packages(spark, sf_dir)))


def preflight_gate(spark, sf_dir):
    d = _deliveries(spark, sf_dir)
    stamp = F.regexp_replace("day", "-", "")
    full = d.select(
        "delivery", "item", "gds", "catalog", "package", F.lit(rules.ADS100).alias("camera"),
        F.array(F.concat(stamp, F.when(F.pmod("c", F.lit(9)) == 0, "_0921").otherwise("_0921_12501"))).alias("line_ids"),
        F.when(F.col("gds") == "SB_DOP_16", "0 0 0 0").otherwise("0 0 0").alias("nodata"), F.lit("BERN").alias("area"), F.substring("day", 1, 4).alias("year"),
        F.lit(False).alias("has_ascii"), F.lit(True).alias("has_laz"), F.lit(True).alias("has_grid"),
    )
    return pipelines.preflight(full, rules.products(spark), _items(spark, sf_dir), package_xml(_packages(spark, sf_dir)))


def _results(spark, sf_dir):
    r = v_file(spark, sf_dir)
    k = F.pmod("l_partkey", F.lit(100))
    status = F.when(k < 1, "failed").when(k < 10, "warning").when(k < 20, "skipped").otherwise("ok")
    return r.select("gds", "name", status.alias("status"))


def status_summary(spark, sf_dir):
    return C.status_summary(_results(spark, sf_dir), "gds")


def failed_files(spark, sf_dir):
    return C.failures(_results(spark, sf_dir), "gds")


def _raster_files(files):
    """Files (rows of v_file) of a delivery for each supplier, every fourth in another coordinate system."""
    calm = F.struct(*[
        F.lit(True).alias("has_crs"), F.lit(True).alias("in_lv95_extent"), F.lit("X").alias("name"), F.lit(False).alias("is_compound"),
        (F.pmod("l_suppkey", F.lit(4)) != 0).alias("horizontal_is_lv95"), F.lit(False).alias("lv95_equivalent"), F.lit(False).alias("local_only"),
        F.lit(None).cast("string").alias("vertical_epsg"),
    ])
    dtype = F.when((F.pmod("l_suppkey", F.lit(3)) == 0) & (F.pmod("l_partkey", F.lit(4)) == 1), "Float64").otherwise("Float32")
    return files.select(
        F.col("l_suppkey").cast("string").alias("delivery"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("ord"), "gds", "name",
        F.md5(F.encode("name", "utf-8")).alias("md5"), F.lit("POLYGON").alias("footprint"), "nodata", calm.alias("info"), "bands",
        (F.pmod("l_suppkey", F.lit(3)) == 0).alias("has_mask"), dtype.alias("dtype"), *raster_columns(),
    )


def _meta(files):
    none = F.lit("")
    return files.select("delivery").distinct().select(
        "delivery", F.lit("kry").alias("order_type"), F.lit(rules.ADS100).alias("camera"), F.concat(F.lit("L"), F.col("delivery")).alias("line_ids"),
        none.alias("acquisition_times"), none.alias("first_acquisition"), none.alias("stac_time"), none.alias("band_id"), none.alias("year"),
    )


def _report(out):
    docs = out["documents"].groupBy("delivery").agg(F.count("*").alias("documents"))
    rows = out["rows"].groupBy(F.substring_index("ord", "|", 1).alias("delivery")).agg(F.count("*").alias("rows"), F.min("line").alias("first_row"))
    return out["gates"].join(docs, "delivery", "left").join(rows, "delivery", "left").select("delivery", "retag", "error", "stop", "documents", "rows", "first_row")


def _raster(spark, sf_dir):
    files = _raster_files(v_file(spark, sf_dir).filter("gds <> 'SB_DSM_PUNKTWOLKE'"))
    return pipelines.raster_delivery(files, _meta(files), rules.kept_extensions(spark), rules.products(spark))


def pipeline_raster(spark, sf_dir):
    """Documents and manifest rows of raster deliveries (one per supplier) that pass the gate."""
    return _report(_raster(spark, sf_dir))


def pipeline_documents(spark, sf_dir):
    """What the documents of raster deliveries say, beside the files' tags."""
    out = _raster(spark, sf_dir)
    said = lambda tag, name: F.regexp_extract("xml", f"<{tag}>(.*)</{tag}>", 1).alias(name)
    docs = out["documents"].select(
        "delivery", "ord", "name", said("CellSize", "cell_size"), said("BlockSize", "block"), said("Width", "width"), said("Height", "height"), said("Commentary", "commentary")
    )
    return docs.join(out["tags"], ["delivery", "ord"])


def pipeline_surface(spark, sf_dir):
    """Surface models: every third supplier has rasters of a wrong data type."""
    files = _raster_files(v_file(spark, sf_dir))
    return _report(pipelines.surface_delivery(files, _meta(files), rules.kept_extensions(spark), rules.products(spark)))


def pipeline_line(spark, sf_dir):
    """Single lines, every third one chosen; some files lie in their folders already."""
    f = v_file(spark, sf_dir).filter("gds = 'SB_DOP'").withColumns(
        {"gds": F.lit("SB_DOP_16"), "name": F.expr("replace(name, '1005', lpad(CAST(l_partkey % 2400 AS STRING), 4, '0'))")}
    )
    files = _raster_files(f)
    line = N.line_token(F.col("name")).alias("line")
    chosen = files.select("delivery", line).filter(F.pmod(F.col("line").cast("int"), F.lit(3)) == 0)
    there = f.filter(F.pmod("l_partkey", F.lit(4)) == 0).select(line, "name").filter("line IS NOT NULL")
    return _report(pipelines.line_delivery(files, _meta(files), rules.products(spark), chosen, there))


def _corrected(spark, sf_dir):
    s = v_scan(spark, sf_dir)
    px = lambda k: F.transform("band", lambda v: F.when(v == 255, 255).when(v < 90, F.pmod(v + k, F.lit(8))).otherwise(F.least(F.lit(254), v + k)))
    tiles = s.groupBy("tile", "e", "n").agg(F.max(F.size("band")).alias("width"), (F.max("row") + 1).alias("height"))
    return pipelines.nodata_delivery(s.select("tile", "row", px(0).alias("r"), px(1).alias("g"), px(2).alias("b")), tiles, 255, 100, 20)


def pipeline_nodata(spark, sf_dir):
    """Correction of a tile set: per tile the pixels of false groups and the lifted ones."""
    return _corrected(spark, sf_dir)["summary"]


def correction_summary(spark, sf_dir):
    return pipelines.correction_summary(_corrected(spark, sf_dir))


def pipeline_points(spark, sf_dir):
    """Points onto cells of 1 km: ranges per tile of requantised points."""
    p = v_point(spark, sf_dir).withColumns({"x": 260_000_000 + F.pmod(F.col("x") * 7, F.lit(4_000_000)), "y": 110_000_000 + F.pmod(F.col("y") * 3, F.lit(4_000_000))})
    cells = v_tile(spark, sf_dir).select(F.col("e").alias("ix"), F.col("n").alias("iy"), F.col("tile").alias("name"))
    out = pipelines.point_delivery(p, cells, 100_000, 10.0)
    return out["tiles"].groupBy("name").agg(F.count("*").alias("points"), F.sum("zq").cast("long").alias("sum_zq"), F.min("x").alias("minx"), F.max("y").alias("maxy"))


QUERIES = {
    f.__name__: f
    for f in (
        crs_decision, crs_summary, point_crs_gate, stac_conflict, package_items, queue_conflict, preflight_gate, status_summary, failed_files, pipeline_raster, pipeline_documents,
        pipeline_surface, pipeline_line,
        pipeline_nodata, pipeline_points, correction_summary,
    )
}

_STEM = r"regexp_replace(name, '\.[^.]*$', '')"
_SHADE = f"(list_contains(string_split(lower({_STEM}), '_'), 'hillshade') OR string_split(lower({_STEM}), '_')[-1] = 'hs')"
_CRS = f"""{V_FILE},
  fl AS (SELECT *, CASE WHEN gds LIKE 'SB_DOP%' THEN 'EPSG:2056' WHEN gds = 'SB_DSM' AND {_SHADE} THEN 'EPSG:2056' WHEN gds = 'SB_DSM' THEN 'EPSG:2056+5728' END AS target,
      gds LIKE 'SB_DOP%' AS dop, l_partkey % 2 = 1 AS has, l_partkey // 2 % 2 = 1 AS ext, l_partkey // 4 % 2 = 1 AS comp, l_suppkey % 3 <> 0 AS hor,
      l_suppkey % 7 = 0 AS equi, l_suppkey % 5 = 0 AS loc, l_partkey // 8 % 2 = 1 AS ln02 FROM v_file),
  dc AS (SELECT *, NOT has OR (NOT dop AND loc) AS miss FROM fl WHERE target IS NOT NULL),
  ac AS (SELECT *, CASE WHEN miss AND ext THEN 'set' WHEN miss THEN 'error' WHEN NOT hor THEN 'error'
      WHEN NOT comp THEN CASE WHEN target = 'EPSG:2056+5728' OR equi THEN 'set' ELSE 'ok' END WHEN target = 'EPSG:2056' THEN 'set'
      WHEN ln02 THEN CASE WHEN equi THEN 'set' ELSE 'ok' END ELSE 'error' END AS action,
      dop AND comp AND NOT ln02 AS vertical_warning, dop AND has AND NOT hor AND ext AS retag FROM dc)"""
_ORD = """
  od AS (SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%d') AS day, ['kry', 'ram', 'bim', 'mom', 'wam'][o_custkey % 5 + 1] AS kind,
      ['SB_DOP', 'SB_DOP_16', 'SB_DSM', 'SB_DSM_PUNKTWOLKE'][o_orderkey % 4 + 1] AS gds FROM orders),
  dl AS (SELECT *, CASE WHEN k % 41 = 0 THEN upper(kind) || '-x' ELSE kind || '-' || day || 't' || lpad(CAST(c % 4 * 100 + 900 AS VARCHAR), 4, '0') || '0000' END AS item, k % 41 <> 0 AS valid FROM od),
  it AS (SELECT item, bool_or(k // 2 % 2 = 1) AS rgb, bool_or(k // 4 % 2 = 1) AS dsm, max(day) AS updated FROM dl WHERE k % 3 <> 0 GROUP BY item),
  st AS (SELECT dl.k, dl.item, CASE WHEN NOT valid THEN 'failed' WHEN it.item IS NULL THEN 'new' WHEN gds = 'SB_DOP' AND rgb OR gds = 'SB_DSM' AND dsm THEN 'exists' ELSE 'free' END AS status,
      CASE WHEN valid AND gds = 'SB_DOP' AND rgb THEN dl.item || '-rgb-mosaic.tif' WHEN valid AND gds = 'SB_DSM' AND dsm THEN dl.item || '-dsm-raster.tif' ELSE '' END AS conflict,
      CASE WHEN valid THEN updated END AS updated FROM dl LEFT JOIN it ON it.item = dl.item),
  pk AS (SELECT gds AS catalog, 'P' || k AS package, item, 'A' || (c % 7) AS area, c % 13 = 0 AS unreadable, k FROM dl WHERE k % 6 = 1),
  qh AS (SELECT dl.k, pk.catalog = dl.gds AS same, pk.area FROM dl JOIN pk ON pk.item = dl.item AND NOT unreadable AND pk.package || pk.catalog <> 'P' || dl.k || dl.gds),
  qu AS (SELECT dl.k, count(qh.k) AS hits, coalesce(bool_or(same), false) AS conflict, coalesce(string_agg(DISTINCT area, ',' ORDER BY area), '') AS areas FROM dl LEFT JOIN qh ON qh.k = dl.k GROUP BY dl.k)"""

ORACLE = {
    "crs_decision": f"""WITH {_CRS} SELECT l_partkey, l_suppkey, gds, name, target, action, CASE WHEN action <> 'error' THEN NULL
        WHEN miss THEN CASE WHEN loc THEN 'only local CRS X' ELSE 'no CRS' END || ', outside LV95' WHEN NOT hor THEN 'not LV95: X' ELSE 'height is not LN02: X' END AS message,
        vertical_warning, retag FROM ac""",
    "crs_summary": f"""WITH {_CRS}, f AS (SELECT gds, CASE WHEN action = 'error' AND retag THEN 'retag' WHEN action = 'error' THEN 'error' WHEN vertical_warning THEN 'warn' ELSE action END AS a
        FROM ac WHERE regexp_matches(lower(name), '\\.tiff?$'))
      SELECT gds, count(*) FILTER (WHERE a = 'ok') AS ok, count(*) FILTER (WHERE a = 'set') AS "set", count(*) FILTER (WHERE a = 'warn') AS warn, count(*) FILTER (WHERE a = 'retag') AS retag,
        count(*) FILTER (WHERE a = 'error') AS error, count(*) FILTER (WHERE a IN ('error', 'retag')) > 0 AS stop FROM f GROUP BY gds""",
    "point_crs_gate": """WITH f AS (SELECT l_partkey, l_suppkey, CASE WHEN l_suppkey % 9 = 0 THEN '21781' ELSE '2056' END AS horizontal,
        CASE WHEN l_partkey // 16 % 2 = 1 THEN NULL WHEN l_partkey % 2 = 1 THEN '5728' WHEN l_partkey // 2 % 2 = 1 THEN '5729' ELSE '5710' END AS vertical FROM lineitem)
      SELECT *, CASE WHEN vertical = '5729' OR l_suppkey % 11 = 0 THEN 'LHN95 heights' WHEN vertical <> '5728' THEN 'height is not LN02' WHEN horizontal <> '2056' THEN 'not LV95' END AS problem FROM f""",
    "stac_conflict": f"WITH {_ORD} SELECT k AS delivery, item, status, conflict, updated FROM st",
    "package_items": f"""WITH {_ORD} SELECT catalog, package, 'b/' || catalog || '/' || package || '/NV/b.xml' AS path, unreadable,
        CASE WHEN unreadable THEN '-' ELSE item END AS item, CASE WHEN unreadable THEN '' ELSE area END AS area FROM pk""",
    "queue_conflict": f"WITH {_ORD} SELECT k AS delivery, CASE WHEN conflict THEN 'conflict' ELSE 'ok' END AS status, hits, areas FROM qu",
    "preflight_gate": f"""WITH {_ORD} SELECT dl.k AS delivery, CAST(dl.c % 9 = 0 AS INTEGER) AS n_errors, status AS asset, CASE WHEN qu.conflict THEN 'conflict' ELSE 'ok' END AS queue,
        CASE WHEN dl.c % 9 = 0 THEN 'blocked' WHEN status IN ('exists', 'failed') OR qu.conflict THEN 'warn' ELSE 'ok' END AS gate FROM dl JOIN st ON st.k = dl.k JOIN qu ON qu.k = dl.k""",
    "status_summary": f"""WITH {V_FILE}, s AS (SELECT gds, name, CASE WHEN l_partkey % 100 < 1 THEN 'failed' WHEN l_partkey % 100 < 10 THEN 'warning' WHEN l_partkey % 100 < 20 THEN 'skipped' ELSE 'ok' END AS status FROM v_file)
      SELECT gds, count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'warning') AS warning, count(*) FILTER (WHERE status = 'skipped') AS skipped,
        count(*) FILTER (WHERE status = 'failed') AS failed FROM s GROUP BY gds""",
    "failed_files": f"WITH {V_FILE} SELECT gds, name FROM v_file WHERE l_partkey % 100 < 1",
    "pipeline_raster": f"""WITH {_CSV},
      k AS (SELECT *, split_part(ord, '-', 4) AS delivery, CAST(split_part(ord, '-', 4) AS BIGINT) % 4 = 0 AS odd FROM c
        WHERE gds <> 'SB_DSM_PUNKTWOLKE' AND ext IN ('.tif', '.tiff', '.tfw')),
      g AS (SELECT delivery, count(*) FILTER (WHERE odd AND gds <> 'SB_DSM') AS retag, count(*) FILTER (WHERE odd AND gds = 'SB_DSM') AS error,
          count(*) FILTER (WHERE odd) > 0 AS stop, count(*) AS documents FROM k WHERE ext <> '.tfw' GROUP BY delivery),
      r AS (SELECT delivery, count(*) AS rows, min(line) AS first_row FROM k JOIN csv ON csv.ord = k.ord AND csv.part = 0 GROUP BY delivery)
      SELECT g.delivery, retag, error, stop, CASE WHEN NOT stop THEN documents END AS documents, CASE WHEN NOT stop THEN rows END AS rows,
        CASE WHEN NOT stop THEN first_row END AS first_row FROM g LEFT JOIN r ON r.delivery = g.delivery""",
    "pipeline_documents": f"""WITH {_RASTERS},
      k AS (SELECT * REPLACE (CAST(delivery AS VARCHAR) AS delivery, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS ord), printf('%.10g', (abs(px) + abs(py)) / 2) AS size,
          list_filter(string_split(nodata, ' '), lambda x: x <> '') AS vs
        FROM ra WHERE gds <> 'SB_DSM_PUNKTWOLKE' AND regexp_matches(lower(name), '\\.tiff?$') AND l_suppkey % 4 <> 0),
      h AS (SELECT *, {", ".join(f"first_value({x}) OVER w AS f_{x}" for x in ("size", "block", "width", "height"))},
          CASE WHEN len(vs) = 1 THEN list_transform(range(0, bands), lambda i: vs[1]) WHEN len(vs) = bands THEN vs END AS fit
        FROM k WINDOW w AS (PARTITION BY delivery, gds ORDER BY ord))
      SELECT delivery, ord, name, CASE gds {" ".join(f"WHEN '{g}' THEN '{t}'" for g, t in rules.CUSTOM_ATTRIBUTE.items())} END AS commentary, array_to_string(fit, ' ') AS nodata_tag,
        CASE WHEN gds <> 'SB_DSM' AND fit IS NOT NULL AND l_suppkey % 3 <> 0 THEN 'make' ELSE 'none' END AS mask_action,
        {", ".join(f"CAST(CASE WHEN gds = 'SB_DSM' THEN {x} ELSE f_{x} END AS VARCHAR) AS {y}" for x, y in (("size", "cell_size"), ("block", "block"), ("width", "width"), ("height", "height")))} FROM h""",
    "pipeline_surface": f"""WITH {_CSV},
      k AS (SELECT *, split_part(ord, '-', 4) AS delivery, CAST(split_part(ord, '-', 4) AS BIGINT) % 4 = 0 AS odd,
          CAST(split_part(ord, '-', 4) AS BIGINT) % 3 = 0 AND CAST(split_part(ord, '-', 3) AS BIGINT) % 4 = 1 AND ext <> '.tfw' AND NOT shade AS wrong
        FROM c WHERE gds = 'SB_DSM' AND ext IN ('.tif', '.tiff', '.tfw')),
      p AS (SELECT * FROM k WHERE delivery NOT IN (SELECT delivery FROM k WHERE wrong)),
      g AS (SELECT delivery, 0 AS retag, count(*) FILTER (WHERE odd) AS error, count(*) FILTER (WHERE odd) > 0 AS stop, count(*) AS documents FROM p WHERE ext <> '.tfw' GROUP BY delivery),
      r AS (SELECT delivery, count(*) AS rows, min(line) AS first_row FROM p JOIN csv ON csv.ord = p.ord AND csv.part = 0 GROUP BY delivery)
      SELECT g.delivery, retag, error, stop, CASE WHEN NOT stop THEN documents END AS documents, CASE WHEN NOT stop THEN rows END AS rows,
        CASE WHEN NOT stop THEN first_row END AS first_row FROM g LEFT JOIN r ON r.delivery = g.delivery""",
    "pipeline_line": f"""WITH {V_FILE},
      n AS (SELECT CAST(l_suppkey AS VARCHAR) AS delivery, l_suppkey % 4 = 0 AS odd, replace(name, '1005', lpad(CAST(l_partkey % 2400 AS VARCHAR), 4, '0')) AS name
        FROM v_file WHERE gds = 'SB_DOP' AND l_partkey % 3 = 0),
      k AS (SELECT *, {_EXT} AS ext, 'NV\\' || name || ';' || md5(name) || ';' || {_KEY} || ';add;' AS line FROM n)
      SELECT delivery, count(*) FILTER (WHERE odd AND ext IN ('.tif', '.tiff')) AS retag, 0 AS error, bool_or(odd) AS stop,
        CASE WHEN NOT bool_or(odd) THEN count(*) FILTER (WHERE ext IN ('.tif', '.tiff', '.laz')) END AS documents,
        CASE WHEN NOT bool_or(odd) THEN nullif(count(*) FILTER (WHERE ext = '.tif'), 0) END AS rows,
        CASE WHEN NOT bool_or(odd) THEN min(line) FILTER (WHERE ext = '.tif') END AS first_row
      FROM k GROUP BY delivery HAVING count(*) FILTER (WHERE ext IN ('.tif', '.tiff')) > 0""",
    "pipeline_nodata": f"SELECT tile, sum(false_px) AS false_px, sum(shadow_px) AS shadow_px FROM ({RASTER['false_nodata_fix']}) GROUP BY tile",
    "correction_summary": f"""WITH {V_SCAN}, t AS (SELECT DISTINCT tile, e, n FROM v_pix),
      g AS (SELECT count(*) AS edge_tiles FROM t WHERE (SELECT count(*) FROM t u WHERE abs(u.e - t.e) <= 1 AND abs(u.n - t.n) <= 1) < 9)
      SELECT count(DISTINCT tile) AS files, sum(false_px) AS false_px, sum(shadow_px) AS shadow_px, 0 AS empty_tiles, any_value(edge_tiles) AS edge_tiles
      FROM ({RASTER['false_nodata_fix']}), g""",
    "pipeline_points": f"""WITH {_COARSE} SELECT name, count(*) AS points, CAST(sum(round_even(z / 10.0::DOUBLE, 0) * 10) AS BIGINT) AS sum_zq,
      min(x) AS minx, max(y) AS maxy FROM tiled WHERE name IS NOT NULL GROUP BY name""",
}
