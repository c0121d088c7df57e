"""Point clouds from text to manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules

from . import pipelines
from .catalog_queries import _meta
from .derive import v_point, v_tile
from .point_queries import _COARSE


def _lines(spark, sf_dir):
    """Texts of 200 files, in metres with two decimals; lines without a height come last in each."""
    p = v_point(spark, sf_dir).withColumns({"x": 260_000_000 + F.pmod(F.col("x") * 7, F.lit(4_000_000)), "y": 110_000_000 + F.pmod(F.col("y") * 3, F.lit(4_000_000))})
    metres = lambda c: F.concat(F.expr(f"{c} div 100").cast("string"), F.lit("."), F.lpad(F.pmod(c, F.lit(100)).cast("string"), 2, "0"))
    short = F.pmod("z", F.lit(50)) == 0
    return p.select(
        F.col("file").cast("string").alias("file"), F.when(short, F.col("x") + 1_000_000_000).otherwise(F.col("x")).alias("line_no"),
        F.concat_ws(" ", metres("x"), metres("y"), F.when(~short, metres("z"))).alias("value"),
    )


def pipeline_text(spark, sf_dir):
    """Per tile its points, box, heights and manifest row, and that its document names the area."""
    cells = v_tile(spark, sf_dir).select(F.col("e").alias("ix"), F.col("n").alias("iy"), F.col("tile").alias("name"))
    meta = _meta(spark.createDataFrame([("d",)], "delivery string"))
    out = pipelines.text_conversion(_lines(spark, sf_dir), cells, meta, rules.products(spark), "d", 2020, "BERN")
    cm = lambda c: F.round(c * 100).cast("long")
    tiles = out["tiles"].groupBy("name").agg(cm(F.min("x")).alias("minx"), cm(F.max("y")).alias("maxy"), cm(F.sum("z")).alias("sum_z"))
    rows = out["rows"].filter("part = 1").select(F.col("ord").alias("name"), "line")
    docs = out["documents"].select("name", F.regexp_extract("xml", "<Area>(.*)</Area>", 1).alias("area"))
    return out["report"].select("name", "points", "status").join(tiles, "name").join(rows, "name").join(docs, "name")


def text_sources(spark, sf_dir):
    """Per text its kind, separator and counts of points and of lines left out."""
    return pipelines.text_sources(*pipelines.text_reading(_lines(spark, sf_dir))).select("file", "kind", "sep", "columns", "points", "ignored", "problem")


QUERIES = {f.__name__: f for f in (pipeline_text, text_sources)}

ORACLE = {
    "pipeline_text": f"""WITH {_COARSE}
      SELECT '2020_BERN_TIN_' || name || '_LV95_LN02.laz' AS name, count(*) AS points, 'ok' AS status, min(x) AS minx, max(y) AS maxy, CAST(sum(z) AS BIGINT) AS sum_z,
        'PreCalculatedFormats\\SB_DSM_PUNKTWOLKE\\SB_DSM_PUNKTWOLKE_LAZ_CHLV95_LN02_' || name || '.laz;;' || name || ';add;' AS line, 'BERN' AS area
      FROM tiled WHERE name IS NOT NULL AND z % 50 <> 0 GROUP BY name""",
    "text_sources": f"""WITH {_COARSE}, q AS (SELECT CAST(file AS VARCHAR) AS file, z FROM v_point)
      SELECT file, 'xyz' AS kind, ' ' AS sep, CAST(3 AS INTEGER) AS columns, count(*) FILTER (z % 50 <> 0) AS points, count(*) FILTER (z % 50 = 0) AS ignored, NULL::VARCHAR AS problem
      FROM q GROUP BY file""",
}
