"""Queries over raster headers, files of flight lines and waiting packages."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark.operators import headers as H

from .derive import V_FILE, V_LINE, table, v_file, v_line


def raster_columns():
    size = (F.pmod("l_partkey", F.lit(50)) + 1) / 30.0
    return [
        size.alias("px"), (-size * (1000 + F.pmod("l_orderkey", F.lit(3))) / 1000.0).alias("py"), (256 * (1 + F.pmod("l_partkey", F.lit(2)))).cast("int").alias("block"),
        (1000 + F.pmod("l_orderkey", F.lit(9000))).cast("int").alias("width"), (1000 + F.pmod("l_partkey", F.lit(9000))).cast("int").alias("height"),
    ]


def _rasters(spark, sf_dir):
    return v_file(spark, sf_dir).select(
        F.col("l_suppkey").alias("delivery"), "gds", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), "name", *raster_columns(),
        F.element_at(F.array(F.lit("Float32"), F.lit("Float64"), F.lit(None), F.lit("Byte")), (F.pmod("l_partkey", F.lit(4)) + 1).cast("int")).alias("dtype"),
    )


def raster_header(spark, sf_dir):
    return H.document_headers(_rasters(spark, sf_dir))


def dsm_dtype_gate(spark, sf_dir):
    return H.dtype_deviations(_rasters(spark, sf_dir)).select("delivery", "ord", "name", "dtype")


def nodata_tags(spark, sf_dir):
    f, bit = v_file(spark, sf_dir), lambda k: F.pmod("l_suppkey", F.lit(k)) == 0
    return f.select("l_orderkey", "l_linenumber", *H.tags(F.col("gds"), F.col("nodata"), F.col("bands"), bit(3), bit(5), bit(7)))


def line_file_selection(spark, sf_dir):
    files = v_file(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.expr("replace(name, '1005', lpad(CAST(l_partkey % 2400 AS STRING), 4, '0'))").alias("name")
    )
    lines = v_line(spark, sf_dir).filter("camera = 'Leica ADS100'").select(F.expr("split(line_id, '_')[1]").alias("hhmm"))
    return H.files_of_lines(files, lines).select("l_orderkey", "l_linenumber", "name", "hhmm")


def package_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("catalog"), F.concat(F.lit("P"), (F.expr("o_custkey div 8")).cast("string")).alias("package"),
        F.concat(F.lit("NV/"), F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("xml_path"), (F.pmod("o_orderkey", F.lit(17)) == 0).alias("unreadable"),
    )
    return H.package_counts(docs)


QUERIES = {f.__name__: f for f in (raster_header, dsm_dtype_gate, nodata_tags, line_file_selection, package_counts)}

_RASTERS = f"""{V_FILE}, ra AS (
    SELECT l_suppkey AS delivery, gds, l_orderkey * 8 + l_linenumber AS ord, name, (l_partkey % 50 + 1) / 30.0::DOUBLE AS px,
      -(l_partkey % 50 + 1) / 30.0::DOUBLE * (1000 + l_orderkey % 3) / 1000.0::DOUBLE AS py, CAST(256 * (1 + l_partkey % 2) AS INTEGER) AS block,
      CAST(1000 + l_orderkey % 9000 AS INTEGER) AS width, CAST(1000 + l_partkey % 9000 AS INTEGER) AS height,
      ['Float32', 'Float64', NULL, 'Byte'][l_partkey % 4 + 1] AS dtype, nodata, bands, l_orderkey, l_linenumber, l_partkey, l_suppkey, string_split(regexp_replace(lower(name), '\\.[^.]*$', ''), '_') AS parts
    FROM v_file)"""

ORACLE = {
    "raster_header": f"""WITH {_RASTERS}, c AS (SELECT *, printf('%.10g', (abs(px) + abs(py)) / 2) AS size FROM ra),
      h AS (SELECT *, {", ".join(f"first_value({x}) OVER w AS f_{x}" for x in ("size", "block", "width", "height"))} FROM c
        WINDOW w AS (PARTITION BY delivery, gds ORDER BY ord, name, size, block, width, height))
      SELECT delivery, gds, ord, name, {", ".join(f"CASE WHEN gds = 'SB_DSM' THEN {x} ELSE f_{x} END AS {y}" for x, y in (("size", "cell_size"), ("block", "block"), ("width", "width"), ("height", "height")))} FROM h""",
    "dsm_dtype_gate": f"""WITH {_RASTERS} SELECT delivery, ord, name, dtype FROM ra
      WHERE gds = 'SB_DSM' AND regexp_matches(lower(name), '\\.tiff?$') AND NOT list_contains(parts, 'hillshade') AND parts[-1] <> 'hs'
        AND dtype IS DISTINCT FROM 'Float32'""",
    "nodata_tags": f"""WITH {V_FILE}, v AS (SELECT *, list_filter(string_split(nodata, ' '), lambda x: x <> '') AS vs FROM v_file),
      t AS (SELECT *, CASE WHEN len(vs) = 1 THEN list_transform(range(0, bands), lambda i: vs[1]) WHEN len(vs) = bands THEN vs END AS fit FROM v)
      SELECT l_orderkey, l_linenumber, array_to_string(fit, ' ') AS nodata_tag,
        CASE WHEN gds NOT IN ('SB_DSM', 'SB_DSM_PUNKTWOLKE') AND l_suppkey % 5 <> 0 AND fit IS NOT NULL AND (l_suppkey % 7 = 0 OR l_suppkey % 3 <> 0)
          THEN 'make' ELSE 'none' END AS mask_action FROM t""",
    "line_file_selection": f"""WITH {V_FILE}, {V_LINE}, f AS (
        SELECT l_orderkey, l_linenumber, replace(name, '1005', lpad(CAST(l_partkey % 2400 AS VARCHAR), 4, '0')) AS name FROM v_file),
      g AS (SELECT *, regexp_extract(name, '(?i)([0-9]{{4}})NRGB', 1) AS hhmm FROM f)
      SELECT l_orderkey, l_linenumber, name, hhmm FROM g WHERE hhmm <> '' AND hhmm IN
        (SELECT string_split(line_id, '_')[2] FROM v_line WHERE camera = 'Leica ADS100')""",
    "package_counts": """SELECT o_orderpriority AS catalog, 'P' || (o_custkey // 8) AS package, count(*) AS n_xml, count(*) FILTER (WHERE o_orderkey % 17 = 0) AS n_unreadable,
      coalesce(string_agg('NV/' || o_orderkey || '.xml', ',' ORDER BY 'NV/' || o_orderkey || '.xml') FILTER (WHERE o_orderkey % 17 = 0), '') AS unreadable
      FROM orders GROUP BY ALL""",
}
