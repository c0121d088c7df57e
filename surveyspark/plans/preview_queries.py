"""Queries of what is shown before a delivery runs: its first document, lists cut to the first entries, codes of order types."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import lines as L
from surveyspark.operators import manifest as M

from . import pipelines
from .catalog_queries import _meta, _raster_files
from .derive import V_FILE, table, v_file
from .header_queries import _RASTERS


def metadata_preview(spark, sf_dir):
    """What the document of each raster delivery's first file says."""
    files = _raster_files(v_file(spark, sf_dir).filter("gds <> 'SB_DSM_PUNKTWOLKE'"))
    files = M.cleanup(files, rules.kept_extensions(spark)).filter("keep")
    said = lambda tag, name: F.regexp_extract("xml", f"<{tag}>(.*)</{tag}>", 1).alias(name)
    docs = pipelines.preview(files, _meta(files), rules.products(spark))
    return docs.select("delivery", "name", said("CellSize", "cell_size"), said("BlockSize", "block"), said("Width", "width"), said("Height", "height"), said("Commentary", "commentary"))


def first_files(spark, sf_dir):
    """Of each product the number of files and the first five names."""
    first = M.first_names(v_file(spark, sf_dir), "gds", 5)
    return first.select("gds", "total", F.array_join("first", ",").alias("first"))


def order_codes(spark, sf_dir):
    """Orders by the code before the dash of their type's label."""
    o = table(spark, sf_dir, "orders").select(L.order_code(F.concat_ws(" - ", "o_orderpriority", "o_orderstatus")).alias("code"))
    return o.groupBy("code").agg(F.count("*").alias("orders"))


QUERIES = {f.__name__: f for f in (metadata_preview, first_files, order_codes)}

ORACLE = {
    "metadata_preview": f"""WITH {_RASTERS},
        k AS (SELECT * REPLACE (CAST(delivery AS VARCHAR) AS delivery, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS ord) FROM ra
          WHERE gds <> 'SB_DSM_PUNKTWOLKE' AND regexp_matches(lower(name), '\\.tiff?$')),
        f AS (SELECT *, row_number() OVER (PARTITION BY delivery ORDER BY name, ord) AS n FROM k)
      SELECT delivery, name, printf('%.10g', (abs(px) + abs(py)) / 2) AS cell_size, CAST(block AS VARCHAR) AS block, CAST(width AS VARCHAR) AS width, CAST(height AS VARCHAR) AS height,
        CASE gds {" ".join(f"WHEN '{g}' THEN '{t}'" for g, t in rules.CUSTOM_ATTRIBUTE.items())} END AS commentary FROM f WHERE n = 1""",
    "first_files": f"""WITH {V_FILE}, r AS (SELECT gds, name, row_number() OVER (PARTITION BY gds ORDER BY name) AS k FROM v_file)
      SELECT gds, count(*) AS total, string_agg(name, ',' ORDER BY name) FILTER (k <= 5) AS first FROM r GROUP BY gds""",
    "order_codes": "SELECT o_orderpriority AS code, count(*) AS orders FROM orders GROUP BY o_orderpriority",
}
