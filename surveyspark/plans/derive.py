"""Survey tables as views over the driver's tables: the same rows by DataFrame here and by SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.rules import ADS100, DMC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """delivery, camera, ord, line_id, raw_id from events. Views and clicks are DMC deliveries, a day each."""
    e = table(spark, sf_dir, "events")
    day, hhmm, hhmmss = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmm"), F.date_format("ts", "HHmmss")
    e = e.select(
        "event_id", "event_type", day.alias("day"), hhmm.alias("hhmm"), hhmmss.alias("hhmmss"),
        F.date_format("ts", "ssSSSSSS").alias("rest"), F.lpad(F.pmod("user_id", F.lit(100000)).cast("string"), 5, "0").alias("serial"),
    )
    groups = e.groupBy("day", "event_type").agg(F.min("hhmm").alias("grp"))
    e = e.join(groups, ["day", "event_type"])
    dmc = F.col("event_type").isin("view", "click")
    odd = F.when(F.pmod("event_id", F.lit(97)) == 0, "1759").otherwise(F.col("grp"))
    line_no = F.lpad(F.pmod("event_id", F.lit(1000)).cast("string"), 3, "0")
    lengths = F.element_at(F.array(*[F.lit(n) for n in (0, 2, 4, 5, 1, 6)]), (F.pmod("event_id", F.lit(6)) + 1).cast("int"))
    return e.select(
        F.concat_ws("/", "day", "event_type").alias("delivery"),
        F.when(dmc, DMC).otherwise(ADS100).alias("camera"),
        F.col("event_id").alias("ord"),
        F.when(dmc, F.concat_ws("_", "day", odd, F.lit("41216"), line_no, "hhmmss"))
        .otherwise(F.concat_ws("_", "day", "hhmm", "serial"))
        .alias("line_id"),
        F.concat("day", F.lit("_"), "hhmm", F.substring("rest", F.lit(1), lengths)).alias("raw_id"),
    )


V_LINE = f"""
  v_ev AS (
    SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H%M') AS hhmm,
      strftime(ts, '%H%M%S') AS hhmmss, strftime(ts, '%S%f') AS rest, lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') AS serial
    FROM events),
  v_grp AS (SELECT day, event_type, min(hhmm) AS grp FROM v_ev GROUP BY ALL),
  v_line AS (
    SELECT day || '/' || event_type AS delivery,
      CASE WHEN event_type IN ('view', 'click') THEN '{DMC}' ELSE '{ADS100}' END AS camera, event_id AS ord,
      CASE WHEN event_type IN ('view', 'click')
        THEN day || '_' || CASE WHEN event_id % 97 = 0 THEN '1759' ELSE grp END || '_41216_'
          || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '_' || hhmmss
        ELSE day || '_' || hhmm || '_' || serial END AS line_id,
      day || '_' || hhmm || substr(rest, 1, [0, 2, 4, 5, 1, 6][event_id % 6 + 1]) AS raw_id
    FROM v_ev JOIN v_grp USING (day, event_type))"""

AREAS = ("PLAINE_MORTE", "BERN", "SILVRETTA", "RHONE", "AROSA")
KINDS = (
    ("SB_DOP", "_DOP_1005NRGB_", "_LV95"), ("SB_DSM", "_DSM_50cm_", "_LV95_LN02"), ("SB_DSM", "_hillshade_50cm_", "_LV95_LN02"),
    ("SB_DSM_PUNKTWOLKE", "_TIN_", "_LV95_LN02"), ("SB_DOP_16", "_dop_16_", "_lv95"), ("SB_DSM", "_DSM_1m_raw_", "_LV95_LN02_wf_HS"),
)
EXTENSIONS = (".tif", ".tfw", ".xml", ".laz", ".ovr", ".TIF", "", ".tiff")


def v_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, gds, name, length, nodata, bands, cents from lineitem: one file a row."""
    li = table(spark, sf_dir, "lineitem")
    pick = lambda items, at: F.element_at(F.array(*[F.lit(x) for x in items]), (at + 1).cast("int"))
    k = F.pmod("l_orderkey", F.lit(len(KINDS)))
    key = F.concat_ws("_", (2600 + F.pmod("l_suppkey", F.lit(100))).cast("string"), (1100 + F.pmod("l_partkey", F.lit(100))).cast("string"))
    name = F.concat(
        (2015 + F.pmod("l_partkey", F.lit(12))).cast("string"), F.lit("_"), pick(AREAS, F.pmod("l_suppkey", F.lit(len(AREAS)))),
        pick([x[1] for x in KINDS], k), F.when(F.pmod("l_partkey", F.lit(13)) == 0, "").otherwise(key), pick([x[2] for x in KINDS], k),
        pick(EXTENSIONS, F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(EXTENSIONS)))),
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    nodata = pick(("0 0 0", "255 255 255", "255", "0 0 0 0", ""), F.pmod("l_partkey", F.lit(5)))
    return li.select(
        pick([x[0] for x in KINDS], k).alias("gds"), name.alias("name"), cents.alias("length"), nodata.alias("nodata"),
        (3 + F.pmod("l_suppkey", F.lit(2))).cast("int").alias("bands"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def _list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


V_FILE = f"""
  v_file AS (
    SELECT {_list(x[0] for x in KINDS)}[l_orderkey % {len(KINDS)} + 1] AS gds,
      CAST(2015 + l_partkey % 12 AS VARCHAR) || '_' || {_list(AREAS)}[l_suppkey % {len(AREAS)} + 1]
        || {_list(x[1] for x in KINDS)}[l_orderkey % {len(KINDS)} + 1]
        || CASE WHEN l_partkey % 13 = 0 THEN '' ELSE CAST(2600 + l_suppkey % 100 AS VARCHAR) || '_' || CAST(1100 + l_partkey % 100 AS VARCHAR) END
        || {_list(x[2] for x in KINDS)}[l_orderkey % {len(KINDS)} + 1]
        || {_list(EXTENSIONS)}[(l_orderkey + l_linenumber) % {len(EXTENSIONS)} + 1] AS name,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS length,
      ['0 0 0', '255 255 255', '255', '0 0 0 0', ''][l_partkey % 5 + 1] AS nodata, CAST(3 + l_suppkey % 2 AS INTEGER) AS bands,
      l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem)"""


def v_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, x, y, z (whole centimetres), cls, red from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.pmod("l_orderkey", F.lit(200)).alias("file"),
        (260_000_000 + F.col("l_partkey") * 713 + F.col("l_linenumber") * 7).alias("x"),
        (110_000_000 + F.col("l_suppkey") * 4999 + F.pmod(F.round(F.col("l_extendedprice") * 100).cast("long"), F.lit(99_991))).alias("y"),
        F.pmod(F.round(F.col("l_extendedprice") * 100).cast("long"), F.lit(500_000)).alias("z"),
        (1 + F.pmod("l_orderkey", F.lit(7))).cast("int").alias("cls"),
        F.pmod(F.col("l_partkey") * 257, F.lit(65_536)).cast("int").alias("red"),
    )


V_POINT = """
  v_point AS (
    SELECT l_orderkey % 200 AS file, 260000000 + l_partkey * 713 + l_linenumber * 7 AS x,
      110000000 + l_suppkey * 4999 + CAST(round(l_extendedprice * 100) AS BIGINT) % 99991 AS y,
      CAST(round(l_extendedprice * 100) AS BIGINT) % 500000 AS z, CAST(1 + l_orderkey % 7 AS INTEGER) AS cls,
      CAST(l_partkey * 257 % 65536 AS INTEGER) AS red
    FROM lineitem)"""


def v_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tiles: tile, e, n (km), minx, miny, maxx, maxy (m). Some are a little too wide."""
    li = table(spark, sf_dir, "lineitem")
    e, n = F.col("l_suppkey").cast("int"), F.expr("CAST(l_partkey div 40 AS INT)")
    t = li.select(e.alias("i"), n.alias("j")).distinct().filter(F.pmod(F.col("i") * 7 + F.col("j") * 3, F.lit(5)) != 0)
    x, y = (2600 + F.col("i")) * 1000.0, (1100 + F.col("j")) * 1000.0
    wide = F.when(F.pmod(F.col("i").cast("long") * F.col("j"), F.lit(11)) == 3, 150.0).otherwise(0.0)
    return t.select(
        F.concat_ws("_", 2600 + F.col("i"), 1100 + F.col("j")).alias("tile"), (2600 + F.col("i")).alias("e"), (1100 + F.col("j")).alias("n"),
        x.alias("minx"), y.alias("miny"), (x + 1000 + wide).alias("maxx"), (y + 1000 + wide).alias("maxy"),
    )


V_TILE = """
  v_tile AS (
    SELECT (2600 + i) || '_' || (1100 + j) AS tile, 2600 + i AS e, 1100 + j AS n, (2600 + i) * 1000.0::DOUBLE AS minx,
      (1100 + j) * 1000.0::DOUBLE AS miny, (2600 + i) * 1000.0::DOUBLE + 1000 + w AS maxx, (1100 + j) * 1000.0::DOUBLE + 1000 + w AS maxy
    FROM (SELECT i, j, CASE WHEN i * j % 11 = 3 THEN 150.0::DOUBLE ELSE 0.0::DOUBLE END AS w FROM
      (SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS i, CAST(l_partkey // 40 AS INTEGER) AS j FROM lineitem)
      WHERE (i * 7 + j * 3) % 5 <> 0))"""


def v_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile, e, n, row, band (64 ints, 255 is NoData) from embeddings: 50 rows a tile."""
    v = table(spark, sf_dir, "embeddings").select(
        F.expr("CAST(vec_id div 50 AS INT)").alias("tile"), F.pmod("vec_id", F.lit(50)).cast("int").alias("row"), "embedding"
    )
    return v.select(
        "tile", (2600 + F.pmod("tile", F.lit(4))).cast("int").alias("e"), F.expr("CAST(1100 + tile div 4 AS INT)").alias("n"), "row",
        F.expr("""transform(embedding, (e, c) -> CASE
          WHEN e > 0.1 OR (tile % 3 = 0 AND row < 12) OR (tile % 3 = 1 AND c < 20 AND e > -0.16) OR (tile % 3 = 2 AND e > -0.03)
          THEN 255 ELSE CAST(least(254, floor((CAST(e AS DOUBLE) + 1) * 128)) AS INT) END)""").alias("band"),
    )


V_SCAN = """
  v_emb AS (SELECT CAST(vec_id // 50 AS INTEGER) AS tile, CAST(vec_id % 50 AS INTEGER) AS row, embedding FROM embeddings),
  v_pix AS (
    SELECT tile, CAST(2600 + tile % 4 AS INTEGER) AS e, CAST(1100 + tile // 4 AS INTEGER) AS n, row, CAST(c - 1 AS INTEGER) AS col,
      CASE WHEN v > 0.1 OR (tile % 3 = 0 AND row < 12) OR (tile % 3 = 1 AND c - 1 < 20 AND v > -0.16) OR (tile % 3 = 2 AND v > -0.03)
      THEN 255 ELSE CAST(least(254, floor((CAST(v AS DOUBLE) + 1) * 128)) AS INTEGER) END AS val
    FROM (SELECT tile, row, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS c FROM v_emb))"""
