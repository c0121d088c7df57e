"""Queries over the pixels of whole deliveries: retiled, masked, rescaled and repaired, with all values."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.operators import raster as R

from . import pipelines
from .catalog_queries import _meta, _raster_files
from .derive import V_SCAN, v_scan
from .raster_queries import _RGB, _rgb

CELL = 40


def _tile_files(scan, gds, name):
    """A raster of each tile, in seven deliveries, of which those that four divides are stopped by their coordinate systems."""
    t = scan.select("tile", "e", "n").distinct().withColumn("l_suppkey", F.pmod("tile", F.lit(7)).cast("long"))
    return t.select(
        "tile", "e", "n", "l_suppkey", F.col("tile").cast("long").alias("l_partkey"), F.col("tile").cast("long").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.lit(gds).alias("gds"), name.alias("name"), F.lit("255").alias("nodata"), F.lit(3).alias("bands"),
    )


def pipeline_pixels(spark, sf_dir):
    """Three bands of deliveries that pass their gate, cut to cells of 40 x 40 pixels, cells without data left out, NoData masked."""
    scan = _rgb(spark, sf_dir)
    f = _tile_files(scan, "SB_DOP", F.concat(F.lit("2020_BERN_DOP_1005NRGB_"), F.col("tile").cast("string"), F.lit("_1_LV95.tif")))
    files = _raster_files(f)
    at = f.select("tile", F.col("l_suppkey").cast("string").alias("delivery"), "name", ((F.col("e") - 2600) * 64).alias("x0"), ((F.col("n") - 1100) * 50).alias("y0"))
    lines = scan.join(at.select("tile", "delivery", "name"), "tile").select("delivery", "name", "row", F.array("r", "g", "b").alias("bands"))
    images = pipelines.Images(lines, at, CELL, [255, 255, 255])
    out = pipelines.raster_delivery(files, _meta(files), rules.kept_extensions(spark), rules.products(spark), images=images)["pixels"]
    text = lambda k: F.array_join(F.col("bands")[k], ",")
    return out.select("delivery", "cx", "cy", "row", text(0).alias("r"), text(1).alias("g"), text(2).alias("b"), F.size(F.filter("mask", lambda m: m)).cast("long").alias("valid"))


def pipeline_surface_pixels(spark, sf_dir):
    """Surface models that pass type and coordinate-system gates: hillshades rescaled to 225, heights with -9999 repaired."""
    scan = v_scan(spark, sf_dir)
    shade = F.when(F.pmod("tile", F.lit(2)) == 0, "hillshade").otherwise("DSM")
    f = _tile_files(scan, "SB_DSM", F.concat(F.lit("2020_BERN_"), shade, F.lit("_50cm_"), F.col("tile").cast("string"), F.lit("_1_LV95_LN02.tif")))
    files = _raster_files(f).withColumn("dtype", F.lit("Float32"))
    at = f.select("tile", F.col("l_suppkey").cast("string").alias("delivery"), "name")
    height = F.transform("band", lambda v: F.when((v == 255) & (F.pmod("tile", F.lit(2)) == 1), -9999).otherwise(v).cast("float"))
    lines = scan.withColumn("band", height).join(at, "tile").select("delivery", "name", "row", "band")
    out = pipelines.surface_delivery(files, _meta(files), rules.kept_extensions(spark), rules.products(spark), lines)["pixels"]
    low = F.transform("band", lambda v: F.when(v < -1e38, "low").otherwise(v.cast("int").cast("string")))
    return out.select("delivery", "name", "row", F.array_join(low, ",").alias("band"))


def pyramid_levels(spark, sf_dir):
    """Four levels of averages of each tile, 50 x 64 pixels at first."""
    levels = R.pyramid(v_scan(spark, sf_dir), 4)
    return levels.select("tile", "level", "r", F.posexplode("values").alias("c", "value"))


QUERIES = {f.__name__: f for f in (pipeline_pixels, pipeline_surface_pixels, pyramid_levels)}

ORACLE = {
    "pipeline_pixels": f"""WITH {_RGB},
        p AS (SELECT tile % 7 AS d, (e - 2600) * 64 + col AS x, (n - 1100) * 50 + row AS y, val, r, g, b FROM rgb WHERE tile % 7 % 4 <> 0),
        c AS (SELECT DISTINCT d, x // {CELL} AS cx, y // {CELL} AS cy FROM p WHERE val <> 255),
        k AS (SELECT d, cx, cy, r.r AS row, k.k AS col FROM c, range(0, {CELL}) r(r), range(0, {CELL}) k(k))
      SELECT CAST(k.d AS VARCHAR) AS delivery, CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy, CAST(row AS INTEGER) AS row,
        {", ".join(f"string_agg(CASE WHEN val <> 255 THEN p.{c} ELSE 0 END, ',' ORDER BY col) AS {c}" for c in "rgb")}, count(*) FILTER (val <> 255) AS valid
      FROM k LEFT JOIN p ON p.d = k.d AND p.x = cx * {CELL} + col AND p.y = cy * {CELL} + row GROUP BY k.d, cx, cy, row""",
    "pipeline_surface_pixels": f"""WITH {V_SCAN}, t AS (SELECT tile, tile % 2 = 0 AND max(val) FILTER (val <> 255) > 225 AS todo FROM v_pix GROUP BY tile)
      SELECT CAST(tile % 7 AS VARCHAR) AS delivery, '2020_BERN_' || CASE WHEN tile % 2 = 0 THEN 'hillshade' ELSE 'DSM' END || '_50cm_' || tile || '_1_LV95_LN02.tif' AS name, row,
        string_agg(CASE WHEN tile % 2 = 1 AND val = 255 THEN 'low' WHEN todo AND val <> 255 THEN CAST(CAST(round_even(val * 225 / 254.0, 0) AS INTEGER) AS VARCHAR) ELSE CAST(val AS VARCHAR) END, ',' ORDER BY col) AS band
      FROM v_pix JOIN t USING (tile) WHERE tile % 7 % 4 <> 0 GROUP BY tile, row""",
    "pyramid_levels": f"""WITH {V_SCAN} SELECT tile, CAST(k AS INTEGER) AS level, CAST(row >> k AS INTEGER) AS r, CAST(col >> k AS INTEGER) AS c, avg(val) AS value
      FROM v_pix, range(1, 5) l(k) GROUP BY tile, k, row >> k, col >> k""",
}
