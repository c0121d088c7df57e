"""Queries over files that Spark writes from the tables: header inventory by ranges, checksums in chunks."""

from __future__ import annotations

import struct
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from surveyspark.sources import files, las, layout, ranged, sinks
from surveyspark.sources.runlog import RunLog
from surveyspark.sources.shared import shared_dir

from .derive import V_POINT, table, v_point


#: Bytes of the files that are made before they go on.
BATCH_BYTES = 4 << 20


def point_files(batches):
    """Rows (key, points, low, high) to files of points in LAS 1.4: a header and records of zeros; every tenth is cut short."""
    for b in batches:
        names, contents, held = [], [], 0
        for k, n, low, high in zip(*(b.column(c).to_pylist() for c in ("key", "points", "low", "high")), strict=True):
            raw = bytearray(375 + 30 * n)
            raw[:4], raw[24], raw[25], raw[104] = b"LASF", 1, 4, 0x80 | 6
            struct.pack_into("<H", raw, 6, 17)
            struct.pack_into("<H", raw, 94, 375)
            struct.pack_into("<H", raw, 105, 30)
            struct.pack_into("<6d", raw, 131, 0.01, 0.01, 0.01, 0.0, 0.0, 0.0)
            struct.pack_into("<6d", raw, 179, high, low, 2.0, 1.0, 4.0, 3.0)
            struct.pack_into("<Q", raw, 247, n)
            names.append(f"{k}.{'laz' if k % 3 else 'LAS'}")
            contents.append(bytes(raw[:100] if k % 10 == 0 else raw))
            held += len(contents[-1])
            if held > BATCH_BYTES:
                yield files_batch(names, contents)
                names, contents, held = [], [], 0
        if names:
            yield files_batch(names, contents)


def files_batch(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "content": pa.array(contents, pa.binary())})


def las_inventory(spark, sf_dir):
    """Point files of suppliers, found by name and read by their first 375 bytes."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("key")).agg(
        F.count("*").alias("points"), F.min(F.col("l_extendedprice").cast("double")).alias("low"), F.max(F.col("l_extendedprice").cast("double")).alias("high")
    )
    folder = f"{shared_dir(spark)}/point-files-{uuid.uuid4().hex}"
    sinks.write_files(li.mapInArrow(point_files, "name string, content binary"), folder)
    return las.inventory(spark, folder).drop("path", "scale", "offset", "miny", "maxy", "minz", "maxz")


def file_checksums(spark, sf_dir):
    """A text file of each supplier's line items, checked in chunks of 1000 bytes."""
    line = F.concat_ws(";", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", line.alias("line")))), lambda x: x["line"]), "\n")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(text.alias("content"))
    folder = f"{shared_dir(spark)}/line-files-{uuid.uuid4().hex}"
    sinks.write_files(rows.select(F.concat(F.col("l_suppkey").cast("string"), F.lit(".csv")).alias("name"), "content"), folder)
    return files.checksums(spark, folder, chunk=1000).drop("path")


def file_scan(spark, sf_dir):
    """The same files by name, length and extension, without opening any."""
    names = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.element_at(F.array(*map(F.lit, (".tif", ".LAZ", "", ".xml"))), (F.pmod("c_custkey", F.lit(4)) + 1).cast("int"))).alias("name"), F.col("c_name").alias("content")
    )
    folder = f"{shared_dir(spark)}/named-files-{uuid.uuid4().hex}"
    sinks.write_files(names, folder)
    return ranged.scan(spark, folder).filter(F.col("extension").isin(".laz", ".xml")).select("name", "extension", "length")


def manifest_log(spark, sf_dir):
    """Orders as lines of a manifest, a run for each priority, one of them repeated, compacted between."""
    o = table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("run"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("ord"), F.lit(0).alias("part"),
        F.when(F.pmod("o_custkey", F.lit(10)) == 0, " ").otherwise(F.concat_ws(";", "o_orderkey", "o_custkey")).alias("line"),
    )
    log = RunLog(spark, f"{shared_dir(spark)}/manifest-log-{uuid.uuid4().hex}")
    for k in "123234":
        log.commit(f"delivery-{k}", o.filter(F.col("run") == k))
        if k == "3":
            log.compact()
    log.commit("delivery-5", o.filter("run = '5'"))
    return log.read()


def points_in_box(spark, sf_dir):
    """Points laid out along a Morton curve, then those of a box, from its files only."""
    path = f"{shared_dir(spark)}/points-{uuid.uuid4().hex}"
    layout.write_points(v_point(spark, sf_dir), path, 100, 20_000)
    return layout.read_box(spark, path, 260_100_000, 110_050_000, 260_500_000, 110_200_000)


QUERIES = {f.__name__: f for f in (las_inventory, file_checksums, file_scan, manifest_log, points_in_box)}

ORACLE = {
    "las_inventory": """SELECT l_suppkey || CASE WHEN l_suppkey % 3 = 0 THEN '.LAS' ELSE '.laz' END AS name, CASE WHEN g THEN 375 + 30 * n ELSE 100 END AS length,
        CASE WHEN g THEN 4::INTEGER END AS minor_version, CASE WHEN g THEN 6::INTEGER END AS format, CASE WHEN g THEN n END AS points,
        CASE WHEN g THEN 375::INTEGER END AS header_size, CASE WHEN g THEN 30::INTEGER END AS point_length, CASE WHEN g THEN 17::INTEGER END AS encoding,
        CASE WHEN g THEN low END AS minx, CASE WHEN g THEN high END AS maxx, CASE WHEN NOT g THEN 'no LAS header' END AS problem
      FROM (SELECT l_suppkey, l_suppkey % 10 <> 0 AS g, count(*) AS n, min(l_extendedprice)::DOUBLE AS low, max(l_extendedprice)::DOUBLE AS high FROM lineitem GROUP BY ALL)""",
    "file_checksums": """SELECT l_suppkey || '.csv' AS name, strlen(t) AS length, md5(t) AS md5 FROM (SELECT l_suppkey,
        string_agg(concat_ws(';', l_orderkey, l_linenumber, l_partkey, l_returnflag), chr(10) ORDER BY l_orderkey, l_linenumber, concat_ws(';', l_orderkey, l_linenumber, l_partkey, l_returnflag)) AS t FROM lineitem GROUP BY l_suppkey)""",
    "file_scan": """SELECT c_custkey || e AS name, lower(e) AS extension, strlen(c_name) AS length
      FROM (SELECT *, ['.tif', '.LAZ', '', '.xml'][c_custkey % 4 + 1] AS e FROM customer) WHERE e IN ('.LAZ', '.xml')""",
    "manifest_log": """SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS run, lpad(o_orderkey::VARCHAR, 12, '0') AS ord, 0 AS part, o_orderkey || ';' || o_custkey AS line
      FROM orders WHERE o_custkey % 10 <> 0""",
    "points_in_box": f"WITH {V_POINT} SELECT * FROM v_point WHERE x BETWEEN 260100000 AND 260500000 AND y BETWEEN 110050000 AND 110200000",
}
