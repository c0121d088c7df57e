"""Queries over flight lines and deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyspark import rules
from surveyspark.functions import lines as L
from surveyspark.operators import deliveries as D
from surveyspark.rules import DMC

from .derive import V_LINE, table, v_line



def line_parse(spark, sf_dir):
    d = v_line(spark, sf_dir).withColumn("t", L.parse_line_id(F.col("raw_id")))
    return d.select("ord", "raw_id", *[F.col("t")[f].alias(f) for f in L.TIME_FIELDS], L.iso8601(F.col("t")).alias("iso"), L.stac_time(F.col("t")).alias("stac"))


def line_delivery_fields(spark, sf_dir):
    return D.delivery_fields(v_line(spark, sf_dir))


def line_normalize(spark, sf_dir):
    return D.normalize(v_line(spark, sf_dir))


def line_foreign_area(spark, sf_dir):
    return D.foreign_lines(v_line(spark, sf_dir))


def line_keys(spark, sf_dir):
    c, i = F.col("camera"), F.col("line_id")
    p = L.dmc_fields(i)
    return v_line(spark, sf_dir).select(
        "ord", L.is_valid(i, c).alias("valid"), L.is_valid(F.col("raw_id"), c).alias("raw_valid"), L.area_key(i, c).alias("area_key"),
        L.band_id(i, c).alias("band_id"), p["group"].alias("grp"), p["serial"].alias("serial"), p["line_no"].alias("line_no"),
    )


def delivery_items(spark, sf_dir):
    """Catalog item ids: DMC by the earliest line (a dash when groups are mixed), ADS by the first entered."""
    rows = v_line(spark, sf_dir).groupBy("delivery", "camera").agg(F.array_sort(F.collect_list(F.struct("ord", "line_id"))).alias("r"))
    rows = rows.withColumn("stac", L.delivery_stac_time(F.transform("r", lambda x: x["line_id"]), F.col("camera")))
    item = L.item_id(F.lit(rules.ORDER_TYPES[0]), F.col("stac"))
    return rows.select("delivery", "camera", "stac", item.alias("item"), L.item_id_valid(item).alias("item_valid"))


def camera_by_year(spark, sf_dir):
    """Range join of order years, shifted by the customer, with the cameras' years."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.year("o_orderdate") + F.pmod("o_custkey", F.lit(30)) - 5).cast("int").alias("year"))
    c = F.broadcast(rules.camera_years(spark))
    return o.join(c, F.col("year").between(F.col("first_year"), F.col("last_year")), "left").select("o_orderkey", "year", "camera")


def delivery_validation(spark, sf_dir):
    """Errors of deliveries made of orders: product, camera, ids and values vary with the keys."""
    o = table(spark, sf_dir, "orders")
    pick = lambda items, at: F.element_at(F.array(*[F.lit(x) for x in items]), (at + 1).cast("int"))
    k = F.col("o_orderkey")
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    ids = F.when(F.pmod(k, F.lit(11)) == 0, F.array().cast("array<string>")).when(
        F.pmod(k, F.lit(7)) == 0, F.array(F.concat(stamp, F.lit("_0822_41216_003_082221")))
    ).otherwise(F.array(F.concat(stamp, F.lit("_0921_12501")), F.concat(stamp, F.lit("_1021_12502"))))
    rows = o.select(
        k.alias("delivery"), pick(rules.PRODUCTS, F.pmod(k, F.lit(4))).alias("gds"),
        pick((rules.ADS100, rules.ADS80, rules.DMC), F.pmod("o_custkey", F.lit(3))).alias("camera"), ids.alias("line_ids"),
        pick(("0 0 0", "255 255 255", "0 0 0 0", "9"), F.pmod("o_custkey", F.lit(4))).alias("nodata"),
        pick(("BERN", "A B", "X-1"), F.pmod(k, F.lit(3))).alias("area"), F.when(F.pmod(k, F.lit(13)) != 0, F.substring(stamp, 1, 4)).alias("year"),
        (F.pmod(k, F.lit(5)) == 0).alias("has_ascii"), (F.pmod(k, F.lit(2)) == 0).alias("has_laz"), (F.pmod(k, F.lit(3)) == 0).alias("has_grid"),
    )
    return D.validate(rows, rules.products(spark)).select("delivery", F.size("errors").alias("n_errors"), F.array_join("errors", ";").alias("errors"))


QUERIES = {
    f.__name__: f
    for f in (line_parse, line_delivery_fields, line_normalize, line_foreign_area, line_keys, delivery_items, camera_by_year, delivery_validation)
}

_ISO = "CASE WHEN y IS NULL THEN 'UNKNOWN' ELSE printf('%04d-%02d-%02dT%02d:%02d:%02d.%02d', y, mo, da, hh, mi, ss, hu) END"
_STAC = "CASE WHEN y IS NULL THEN 'UNKNOWN' ELSE printf('%04d-%02d-%02dt%02d%02d%02d%02d', y, mo, da, hh, mi, ss, hu) END"


def _parsed(src: str) -> str:
    """SQL that parses column x of src."""
    return f"""(
      SELECT *, CAST(substr(x, 1, 4) AS INTEGER) AS y, CAST(substr(x, 5, 2) AS INTEGER) AS mo, CAST(substr(x, 7, 2) AS INTEGER) AS da,
        CAST(substr(t, 1, 2) AS INTEGER) AS hh, CAST(substr(t, 3, 2) AS INTEGER) AS mi,
        CASE WHEN length(t) >= 6 THEN CAST(substr(t, 5, 2) AS INTEGER) ELSE 0 END AS ss,
        CASE length(t) WHEN 8 THEN CAST(substr(t, 7, 2) AS INTEGER)
          WHEN 9 THEN least(CAST(round_even(CAST(substr(t, 7, 3) AS INTEGER) / 10.0, 0) AS INTEGER), 99) ELSE 0 END AS hu
      FROM (SELECT *, split_part(x, '_', 2) AS t FROM {src}))"""


_NORM = f"""{V_LINE},
  n_once AS (SELECT delivery, camera, line_id, min(ord) AS ord,
      CASE WHEN camera = '{DMC}' THEN substr(line_id, 1, 19) END AS area_key,
      CASE WHEN camera = '{DMC}' THEN substr(line_id, 1, 8) || substr(line_id, 25, 6) || substr(line_id, 21, 3)
        ELSE substr(line_id, 1, 8) || substr(line_id, 10, 4) || line_id END AS k
    FROM v_line GROUP BY ALL),
  n_exp AS (SELECT *, first_value(area_key) OVER (PARTITION BY delivery ORDER BY ord) AS expected FROM n_once),
  n_norm AS (SELECT delivery, camera, line_id, area_key, row_number() OVER (PARTITION BY delivery ORDER BY k) AS pos
    FROM n_exp WHERE area_key IS NOT DISTINCT FROM expected)"""

ORACLE = {
    "line_parse": f"""WITH {V_LINE}
      SELECT ord, raw_id, y AS year, mo AS month, da AS day, hh, mi AS mm, ss, hu AS hundredths, {_ISO} AS iso, {_STAC} AS stac
      FROM {_parsed("(SELECT ord, raw_id, raw_id AS x FROM v_line)")}""",
    "line_normalize": f"WITH {_NORM} SELECT * FROM n_norm",
    "line_foreign_area": f"""WITH {V_LINE},
      k AS (SELECT *, substr(line_id, 1, 19) AS area_key FROM v_line WHERE camera = '{DMC}'),
      e AS (SELECT *, first_value(area_key) OVER (PARTITION BY delivery ORDER BY ord) AS expected FROM k)
      SELECT delivery, expected, count(*) AS n_foreign, string_agg(line_id, ',' ORDER BY ord) AS "foreign"
      FROM e WHERE area_key <> expected GROUP BY ALL""",
    "line_delivery_fields": f"""WITH {_NORM},
      each AS (SELECT delivery, camera, line_id, pos AS ord, substr(line_id, 1, 8) || '_' || substr(line_id, 25, 6) AS x FROM n_norm WHERE camera = '{DMC}'
        UNION ALL SELECT delivery, camera, line_id, ord, line_id AS x FROM v_line WHERE camera <> '{DMC}'),
      t AS (SELECT *, {_ISO} AS iso, {_STAC} AS stac,
          CASE WHEN camera = '{DMC}' THEN substr(line_id, 25, 4) ELSE substr(line_id, 10, 4) END AS band FROM {_parsed("each")})
      SELECT delivery, camera, string_agg(line_id, ',' ORDER BY ord) AS line_ids, string_agg(iso, ',' ORDER BY ord) AS acquisition_times,
        arg_min(iso, ord) AS first_acquisition, arg_min(stac, ord) AS stac_time, arg_min(band, ord) AS band_id, substr(arg_min(line_id, ord), 1, 4) AS year
      FROM t GROUP BY delivery, camera""",
    "line_keys": f"""WITH {V_LINE}
      SELECT ord, true AS valid, false AS raw_valid, CASE WHEN camera = '{DMC}' THEN substr(line_id, 1, 19) END AS area_key,
        CASE WHEN camera = '{DMC}' THEN substr(line_id, 25, 4) ELSE substr(line_id, 10, 4) END AS band_id,
        CASE WHEN camera = '{DMC}' THEN substr(line_id, 10, 4) END AS grp, CASE WHEN camera = '{DMC}' THEN substr(line_id, 15, 5) END AS serial,
        CASE WHEN camera = '{DMC}' THEN substr(line_id, 21, 3) END AS line_no
      FROM v_line""",
    "delivery_items": f"""WITH {V_LINE},
      g AS (SELECT delivery, camera, count(DISTINCT substr(line_id, 1, 19)) AS n_groups, arg_min(line_id, ord) AS first,
          min(substr(line_id, 1, 8) || substr(line_id, 25, 6)) AS earliest FROM v_line GROUP BY ALL),
      s AS (SELECT *, CASE WHEN camera = '{DMC}' AND n_groups > 1 THEN '—'
          WHEN camera = '{DMC}' THEN substr(earliest, 1, 4) || '-' || substr(earliest, 5, 2) || '-' || substr(earliest, 7, 2) || 't' || substr(earliest, 9, 6) || '00'
          ELSE substr(first, 1, 4) || '-' || substr(first, 5, 2) || '-' || substr(first, 7, 2) || 't' || substr(first, 10, 4) || '0000' END AS stac FROM g)
      SELECT delivery, camera, stac, 'kry-' || stac AS item, stac <> '—' AS item_valid FROM s""",
    "camera_by_year": f"""
      SELECT o_orderkey, yr AS year, CASE WHEN yr BETWEEN 2008 AND 2016 THEN '{rules.ADS80}' WHEN yr BETWEEN 2017 AND 2025 THEN '{rules.ADS100}'
        WHEN yr >= 2026 THEN '{DMC}' END AS camera
      FROM (SELECT o_orderkey, CAST(year(o_orderdate) + o_custkey % 30 - 5 AS INTEGER) AS yr FROM orders)""",
    "delivery_validation": f"""
      WITH d AS (SELECT o_orderkey AS k, o_custkey AS c, {str(list(rules.PRODUCTS))}[o_orderkey % 4 + 1] AS gds,
          ['{rules.ADS100}', '{rules.ADS80}', '{DMC}'][o_custkey % 3 + 1] AS camera FROM orders),
      e AS (SELECT k, [x FOR x IN [
          CASE WHEN gds = 'SB_DOP_16' AND camera = '{DMC}' THEN 'camera has no single lines' END,
          CASE WHEN k % 11 = 0 THEN 'no line id' END,
          CASE WHEN k % 11 <> 0 AND ((k % 7 = 0) <> (camera = '{DMC}')) THEN 'line id format' END,
          CASE WHEN k % 5 = 0 AND k % 2 = 0 THEN 'text and LAZ mixed' END,
          CASE WHEN camera = '{rules.ADS80}' AND gds <> 'SB_DSM' AND k % 3 <> 0 THEN 'grid missing' END,
          CASE WHEN gds = 'SB_DOP' AND camera = '{DMC}' AND c % 4 <> 2 OR gds = 'SB_DOP' AND camera <> '{DMC}' AND c % 4 > 1
            OR gds = 'SB_DOP_16' AND c % 4 <> 2 THEN 'nodata value' END,
          CASE WHEN k % 3 = 1 THEN 'area characters' END,
          CASE WHEN k % 13 = 0 THEN 'year' END] IF x IS NOT NULL] AS errors FROM d)
      SELECT k AS delivery, len(errors) AS n_errors, array_to_string(errors, ';') AS errors FROM e""",
}
