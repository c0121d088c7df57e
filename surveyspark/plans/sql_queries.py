"""Queries in SQL text alone, with the scalar rules as SQL functions."""

from __future__ import annotations

from surveyspark.functions import sqlfunctions
from surveyspark.rules import DMC

from .derive import V_FILE, V_LINE, table, v_file, v_line
from .file_queries import _EXT, _KEY, _OUT, _SHADE, _SRC, _area
from .line_queries import _ISO, _STAC, _parsed

LINES = """
    SELECT ord, survey_is_valid(line_id, camera) AS valid, survey_band_id(line_id, camera) AS band, survey_area_key(line_id, camera) AS area_key,
      survey_iso8601(survey_acquisition(line_id, camera)) AS iso, survey_stac_time(survey_acquisition(raw_id, '')) AS stac
    FROM {lines}"""

FILES = """
    SELECT survey_area(name, gds) AS area, count(*) AS files, count_if(survey_tile_key(name) = 'UNKNOWN') AS without_tile,
      count_if(survey_is_hillshade(name)) AS shades, sum(survey_tile_numbers(survey_tile_key(name)).e) AS sum_e,
      max(survey_nodata_output(gds, survey_nodata_source(name, gds, nodata))) AS nodata, min(survey_dsm_folder(name)) AS folder
    FROM {files} WHERE survey_extension(name) IN ('.tif', '.laz') GROUP BY 1"""

CELLS = """
    SELECT c_nationkey AS nation, sum(survey_thresholds(px, px).area_px) AS area_px, count_if(survey_off_grid(c_acctbal, px)) AS off,
      round(sum(survey_requantised(c_acctbal, 0.5D)), 2) AS requantised, count_if(survey_classify_bbox(x, x + 1, 1000000, 1000001) = 'LV95') AS lv95,
      max(survey_footprint(array(c_custkey, 0.5D, 0, 5, 0, -0.5D), 10, 20)) AS footprint
    FROM (SELECT *, (c_custkey % 7 + 1) / 8.0D AS px, c_custkey * 20000.0D AS x FROM {customers}) GROUP BY c_nationkey"""


def sql_lines(spark, sf_dir):
    sqlfunctions.register(spark)
    return spark.sql(LINES, lines=v_line(spark, sf_dir))


def sql_files(spark, sf_dir):
    sqlfunctions.register(spark)
    return spark.sql(FILES, files=v_file(spark, sf_dir))


def sql_cells(spark, sf_dir):
    sqlfunctions.register(spark)
    return spark.sql(CELLS, customers=table(spark, sf_dir, "customer"))


QUERIES = {f.__name__: f for f in (sql_lines, sql_files, sql_cells)}

ORACLE = {
    "sql_lines": f"""WITH {V_LINE}, a AS (SELECT ord, raw_id AS x FROM v_line),
        b AS (SELECT ord, CASE WHEN camera = '{DMC}' THEN substr(line_id, 1, 8) || '_' || substr(line_id, 25, 6) ELSE line_id END AS x FROM v_line),
        pa AS (SELECT ord, {_STAC} AS stac FROM {_parsed("a")}), pb AS (SELECT ord, {_ISO} AS iso FROM {_parsed("b")})
      SELECT ord, true AS valid, CASE WHEN camera = '{DMC}' THEN substr(line_id, 25, 4) ELSE substr(line_id, 10, 4) END AS band,
        CASE WHEN camera = '{DMC}' THEN substr(line_id, 1, 19) END AS area_key, iso, stac FROM v_line JOIN pa USING (ord) JOIN pb USING (ord)""",
    "sql_files": f"""WITH {V_FILE}, s AS (SELECT *, {_SRC} AS src, [x FOR x IN string_split({_SRC}, ' ') IF x <> ''] AS t FROM v_file WHERE {_EXT} IN ('.tif', '.laz')),
        k AS (SELECT *, {_area(", 'i'", "lower(name) LIKE '%hillshade%'")} AS area, {_KEY} AS key, {_SHADE} AS shade, {_OUT} AS o FROM s)
      SELECT area, count(*) AS files, count(*) FILTER (key = 'UNKNOWN') AS without_tile, count(*) FILTER (shade) AS shades,
        CAST(sum(CASE WHEN regexp_matches(key, '^[+-]?[0-9]+_[+-]?[0-9]+$') THEN CAST(split_part(key, '_', 1) AS INTEGER) END) AS BIGINT) AS sum_e,
        max(o) AS nodata, min(CASE WHEN shade THEN 'HILLSHADE' ELSE 'DSM' END) AS folder FROM k GROUP BY area""",
    "sql_cells": """WITH c AS (SELECT *, CAST(c_acctbal AS DOUBLE) AS v, (c_custkey % 7 + 1) / 8.0::DOUBLE AS px, c_custkey * 20000 AS x,
          format('{:.3f}', c_custkey::DOUBLE) AS x0, format('{:.3f}', c_custkey + 5::DOUBLE) AS x1 FROM customer)
      SELECT c_nationkey AS nation, CAST(sum(greatest(1, round_even(900 / (px * px), 0))) AS BIGINT) AS area_px,
        count(*) FILTER (abs(v / px - round(v / px)) > 1e-6) AS off, round(sum(round_even((v - 0.5) / 0.01, 0) * 0.01 + 0.5), 2) AS requantised,
        count(*) FILTER (x >= 2400000 AND x + 1 <= 2900000) AS lv95,
        max('POLYGON ((' || x0 || ' -5.000, ' || x1 || ' -5.000, ' || x1 || ' 5.000, ' || x0 || ' 5.000, ' || x0 || ' -5.000))') AS footprint
      FROM c GROUP BY c_nationkey""",
}
