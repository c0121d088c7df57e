"""Deliveries against waiting packages."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from surveyspark.operators import catalog as C

PACKAGE = "catalog string, package string, item string, area string, unreadable boolean"


def test_own_repeated_and_other_packages(spark):
    p = [
        ("A", "p", "i", "x", False), ("A", "p", "i", "x", False), ("A", "p", "i", "y", False), ("B", "p", "i", "x", False), ("A", "q", "i", None, False),
        ("A", "r", "i", "z", True), (None, "p", "i", "w", False), ("A", None, "i", "v", False), ("A", "p", None, "u", False), ("A", "p", "k", "t", False),
    ]
    d = [("own", "i", "A", "p"), ("other", "i", "A", "s"), ("none", "j", "A", "p"), ("null", None, "A", "p"), ("far", "i", "C", "p"), ("alone", "k", "A", "p"), ("open", "i", None, "p")]
    out = C.queue_conflicts(spark.createDataFrame(d, "delivery string, item string, catalog string, package string"), spark.createDataFrame(p, PACKAGE))
    assert {tuple(r) for r in out.collect()} == {
        ("own", "conflict", 3, "w,x"), ("other", "conflict", 6, "w,x,y"), ("none", "ok", 0, ""), ("null", "ok", 0, ""), ("far", "ok", 6, "w,x,y"), ("alone", "ok", 0, ""),
        ("open", "ok", 6, "w,x,y"),
    }


def test_many_deliveries_and_packages_of_one_item(spark):
    n = 60_000
    d = spark.range(n).select(F.col("id").alias("delivery"), F.lit("i").alias("item"), F.lit("A").alias("catalog"), F.col("id").cast("string").alias("package"))
    p = d.select("catalog", "package", "item", F.pmod("delivery", F.lit(7)).cast("string").alias("area"), F.lit(False).alias("unreadable"))
    began = time.monotonic()
    out = C.queue_conflicts(d, p).groupBy("status", "hits", "areas").count().collect()
    assert [tuple(r) for r in out] == [("conflict", n - 1, "0,1,2,3,4,5,6", n)]
    assert time.monotonic() - began < 60  # all pairs would be 3.6 billion rows
