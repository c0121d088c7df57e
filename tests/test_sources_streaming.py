"""Files on disk, LAS headers, package XML and the queue stream."""

from __future__ import annotations

import datetime as dt
import hashlib
import time

from pyspark.sql import functions as F

from surveyspark.functions import xmlout
from surveyspark.plans.point_queries import las_header
from surveyspark.sources import files, las
from surveyspark.streaming import queue


def test_manifest_and_copies(spark, tmp_path):
    for name, data in (("a.tif", b"one"), ("b.TIF", b"two"), ("c.txt", b"x")):
        (tmp_path / name).write_bytes(data)
    m = files.manifest(spark, str(tmp_path), (".tif",))
    assert sorted((r.name, r.length) for r in m.collect()) == [("a.tif", 3), ("b.TIF", 3)]
    assert "content" not in m.columns
    sums = files.checksums(spark, str(tmp_path))
    assert {r.name: r.md5 for r in sums.collect()}["a.tif"] == hashlib.md5(b"one").hexdigest()
    (tmp_path / "copy").mkdir()
    (tmp_path / "copy" / "a.tif").write_bytes(b"0ne")
    got = {r.name: r.problem for r in files.compare_copies(sums, files.checksums(spark, str(tmp_path / "copy"))).collect()}
    assert got == {"a.tif": "checksum", "b.TIF": "missing", "c.txt": "missing"}


def test_las_headers(spark):
    df = spark.createDataFrame([("short", b"LASF"), ("none", None), ("other", b"x" * 400)], "name string, content binary")
    assert {r.problem for r in las.headers(df).collect()} == {"no LAS header"}
    got = las_header(spark, "/root/testdata/sf0.001").filter("problem IS NULL").first()
    assert got.header_size == 375 and got.encoding == 17


def test_xml_document(spark):
    doc = xmlout.document([("A", F.lit("a&b")), ("B", F.lit("")), ("C", F.lit(None).cast("string"))])
    assert spark.range(1).select(doc).first()[0].split("\n")[2:] == ["    <A>a&amp;b</A>", "    <B/>", "</MetaObject>"]


DOC = "<MetaObject><Auftragstyp>kry</Auftragstyp><StacItemIdDatetime>2026-08-13t08222100</StacItemIdDatetime><Area>A</Area></MetaObject>"


class Arrivals:
    """A folder that files arrive in, and runs of the stream with the same checkpoint."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def add(self, *packages):
        now = dt.datetime(2026, 8, 13)
        rows = [("SB_DOP", p, f"b/SB_DOP/{p}/NV/{name}", xml, now) for p, name, xml in packages]
        self.spark.createDataFrame(rows, queue.SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def run(self, settle):
        q = queue.into_queue(queue.arriving(self.spark, f"{self.path}/in"), f"{self.path}/out", f"{self.path}/state", settle, "0 seconds")
        queue.until_idle(q, 120)
        return self.rows()

    def rows(self):
        if not (self.path / "out").exists():
            return []
        return sorted((r.package, r.path.split("/NV/")[1], r.unreadable, r.item) for r in self.spark.read.parquet(f"{self.path}/out").collect())


def test_one_row_a_package_over_batches_and_restarts(spark, tmp_path):
    a = Arrivals(spark, tmp_path)
    a.add(("p1", "b.xml", DOC), ("p1", "b.xml", DOC), ("p2", "x.xml", "<Meta"), ("p3", "deep/er/no.xml", DOC), ("p3", "note.txt", DOC))
    assert a.run("1 day") == []  # they wait
    a.add(("p1", "a.xml", DOC.replace("kry", "abc")), ("p1", "0/first.xml", DOC))
    assert a.run("1 day") == []
    a.add(("p1", "c.xml", DOC), ("p2", "y.xml", DOC))
    wanted = [("p1", "a.xml", False, "abc-2026-08-13t08222100"), ("p2", "x.xml", True, "-")]
    assert a.run("0 seconds") == wanted  # the wait is over
    a.add(("p1", "0.xml", DOC))
    assert a.run("0 seconds") == wanted  # too late, and no second row
    assert a.run("0 seconds") == wanted


def test_a_timer_ends_the_wait(spark, tmp_path):
    a = Arrivals(spark, tmp_path)
    a.add(("p1", "b.xml", DOC))
    assert a.run("2 seconds") in ([], [("p1", "b.xml", False, "kry-2026-08-13t08222100")])
    time.sleep(2.5)
    a.add(("p2", "z.xml", DOC))
    assert a.run("2 seconds")[0] == ("p1", "b.xml", False, "kry-2026-08-13t08222100")  # without further files of its own


class Progress:
    """A query that reports batches: number, rows, whether a batch ran."""

    isActive, stopped = True, False

    def __init__(self, *batches):
        self.batches = iter(batches)

    @property
    def lastProgress(self):
        self.number, rows, ran = next(self.batches)
        return {"batchId": self.number, "numInputRows": rows, "durationMs": {"addBatch": 1, "triggerExecution": 1} if ran else {"triggerExecution": 1}}

    def stop(self):
        self.stopped = True


def test_a_repeated_batch_is_no_end_of_arrivals():
    q = Progress((2, 0, True), (2, 0, True), (3, 1, True), (4, 0, True))  # a file is read after the repeated batch
    queue.until_idle(q, 60)
    assert q.number == 4 and q.stopped


def test_a_run_without_batches_ends():
    q = Progress((3, 0, False))
    queue.until_idle(q, 60)
    assert q.number == 3 and q.stopped
