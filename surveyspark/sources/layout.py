"""Point clouds laid out along a Morton curve: files of bounded size, and boxes that read only their files.

Points get the interleaved bits of their sub-cell's numbers and are dealt by ranges of this code, so a dense cell takes many files and
empty land none, and a file's points lie close together. A table beside the files has each one's box and count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a file, on average; bits of a sub-cell's number on each axis.
FILE_ROWS, BITS = 2_000_000, 31
#: Shifts and masks that spread 31 bits over every second place of a long.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def morton(ix: Column, iy: Column) -> Column:
    """Interleaved bits of two numbers from 0 to 2^31 - 1, those of ``iy`` above those of ``ix``."""

    def spread(c: Column) -> Column:
        c = c.cast("long").bitwiseAND((1 << BITS) - 1)
        for step, mask in SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, step)).bitwiseAND(mask)
        return c

    return spread(ix).bitwiseOR(F.shiftleft(spread(iy), 1))


def write_points(points: DataFrame, path: str, cell: float, file_rows: int = FILE_ROWS) -> int:
    """Write points (x, y, ..) in order of their sub-cells of side ``cell``. Returns the number of files.

    ``cell`` should be small enough that few points share one: equal codes stay together. Points without x or y are left out.
    """
    kept = points.filter("x IS NOT NULL AND y IS NOT NULL")
    ends = kept.agg(F.count("*").alias("n"), F.min(F.floor(F.col("x") / cell)).alias("ix"), F.min(F.floor(F.col("y") / cell)).alias("iy")).first()
    code = morton(F.floor(F.col("x") / cell) - (ends.ix or 0), F.floor(F.col("y") / cell) - (ends.iy or 0))
    dealt = kept.withColumn("morton", code).repartitionByRange(max(1, math.ceil(ends.n / file_rows)), "morton").sortWithinPartitions("morton")
    dealt.drop("morton").write.mode("overwrite").parquet(path)
    written = points.sparkSession.read.schema(points.schema).parquet(path).select("x", "y", F.col("_metadata.file_path").alias("file"))
    boxes = written.groupBy("file").agg(F.count("*").alias("points"), *[f(c).alias(f"{n}{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))])
    boxes.write.mode("overwrite").parquet(f"{path}/_boxes")
    return boxes.sparkSession.read.schema(boxes.schema).parquet(f"{path}/_boxes").count()


def files_of_box(spark: SparkSession, path: str, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """The files (file, points, minx, maxx, miny, maxy) whose boxes meet the box, borders included."""
    boxes = spark.read.parquet(f"{path}/_boxes")
    return boxes.filter((F.col("maxx") >= minx) & (F.col("minx") <= maxx) & (F.col("maxy") >= miny) & (F.col("miny") <= maxy))


def read_box(spark: SparkSession, path: str, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """The points in a box, borders included. Only names of files come to the driver, and only their files are opened."""
    schema = spark.read.parquet(path).schema
    names = [r.file for r in files_of_box(spark, path, minx, miny, maxx, maxy).select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    inside = F.col("x").between(minx, maxx) & F.col("y").between(miny, maxy)
    return spark.read.schema(schema).parquet(*names).filter(inside)
