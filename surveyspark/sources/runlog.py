"""A manifest as a log of runs: appends that survive repeated, failed and concurrent jobs.

A run writes its rows to a folder of its own, in parallel, and then takes the next free number: only one writer can create the
file of a number (``log/<number>``, where links are made at once, else an empty ``claims/<number>`` and then the text by renaming). Rows without such a file are not part of the manifest, so a job that fails midway leaves nothing
behind that is seen, and nobody's rows are overwritten. Numbers give the order of runs. A repeated run, by its name, adds nothing;
the same name with other rows is refused. ``compact`` writes the rows of all runs so far together; readers take the latest such
table and the runs after it.

Works on local folders (exclusive creation) and on stores where Hadoop's ``createNewFile`` is atomic, as on HDFS.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "ord string, part int, line string"


class RunConflict(ValueError):
    """A run's name is taken by other rows."""


class RunLog:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- small files ---

    def _local(self) -> str | None:
        path = re.sub(r"^file:(//(?=/))?", "", self.folder)
        return None if "://" in path else path

    def _hadoop(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _create(self, name: str, text: str) -> bool:
        """Create a marker with this text unless there is one of this name."""
        if (local := self._local()) is not None:
            os.makedirs(f"{local}/log", exist_ok=True)
            part = f"{local}/log/.{uuid.uuid4().hex}"
            with open(part, "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(part, f"{local}/log/{name}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(part)
        store, claim = self._hadoop(f"{self.folder}/claims/{name}")
        try:
            if not store.createNewFile(claim):
                return False
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        part, at = (self._hadoop(f"{self.folder}/log/{n}")[1] for n in (f".{uuid.uuid4().hex}", name))
        out = store.create(part)
        out.write(bytearray(text.encode()))
        out.close()
        return bool(store.rename(part, at))

    def _names(self, part: str) -> list[str]:
        if (local := self._local()) is not None:
            return [n for n in (os.listdir(f"{local}/{part}") if os.path.isdir(f"{local}/{part}") else []) if n[0] != "."]
        store, at = self._hadoop(f"{self.folder}/{part}")
        names = [x.getPath().getName() for x in store.listStatus(at)] if store.exists(at) else []
        return [n for n in names if n[0] != "."]

    def _text(self, name: str) -> str:
        if (local := self._local()) is not None:
            with open(f"{local}/log/{name}", encoding="utf-8") as f:
                return f.read()
        store, at = self._hadoop(f"{self.folder}/log/{name}")
        return self.spark._jvm.org.apache.commons.io.IOUtils.toString(store.open(at), "UTF-8")

    def _markers(self) -> dict[str, dict]:
        return {n: json.loads(self._text(n)) for n in self._names("log")}

    def _next(self) -> int:
        """The first number that nobody has taken. A writer that stops before it moves its text uses its number up, no more."""
        return 1 + max((int(n) for part in ("log", "claims") for n in self._names(part) if n.isdigit()), default=-1)

    # --- runs ---

    def runs(self) -> list[dict]:
        """Committed runs in order: number, name, path, rows, digest. Of runs of one name the first counts."""
        out: dict[str, dict] = {}
        for n, m in sorted(self._markers().items()):
            if n.isdigit():
                out.setdefault(m["name"], {"number": int(n)} | m)
        return sorted(out.values(), key=lambda m: m["number"])

    def commit(self, name: str, rows: DataFrame) -> int:
        """Append rows (ord, part, line) as one run, blank lines left out. Returns the run's number."""
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        kept = rows.filter(F.trim("line") != "").select(F.col("ord").cast("string").alias("ord"), F.col("part").cast("int").alias("part"), "line")
        kept.write.parquet(path)
        written = self.spark.read.schema(ROWS).parquet(path)
        own = written.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("ord", "part", "line").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest")).first()
        while not (same := [m for m in self.runs() if m["name"] == name]):
            self._create(f"{self._next():09d}", json.dumps({"name": name, "path": path, "rows": own.n, "digest": own.digest}))
        if (same[0]["rows"], same[0]["digest"]) != (own.n, own.digest):
            raise RunConflict(f"run {name} was committed with other rows")
        return same[0]["number"]

    def read(self) -> DataFrame:
        """run, ord, part, line of all committed runs."""
        tables = sorted((int(n.split("-")[1]), m["path"]) for n, m in self._markers().items() if n.startswith("compact-"))
        upto, done = tables[-1] if tables else (-1, None)
        parts = [self.spark.read.schema(f"run int, {ROWS}").parquet(done)] if done else []
        for m in self.runs():
            if m["number"] > upto:
                parts.append(self.spark.read.schema(ROWS).parquet(m["path"]).select(F.lit(m["number"]).cast("int").alias("run"), "ord", "part", "line"))
        empty = self.spark.createDataFrame([], f"run int, {ROWS}")
        return reduce(DataFrame.unionByName, parts) if parts else empty

    def compact(self) -> int:
        """Write the rows of all runs so far as one table in their order. Runs that come meanwhile stay as they are."""
        known = self.runs()
        if not known:
            return -1
        last, path = known[-1]["number"], f"{self.folder}/data/{uuid.uuid4().hex}"
        self.read().filter(F.col("run") <= last).repartitionByRange("run", "ord", "part").sortWithinPartitions("run", "ord", "part").write.parquet(path)
        self._create(f"compact-{last:09d}", json.dumps({"path": path}))  # an equal one may be there already
        return last

    def export(self, path: str) -> None:
        """The manifest as text in order: the files of the folder, by name."""
        self.read().orderBy("run", "ord", "part").select(F.col("line").alias("value")).write.mode("errorifexists").text(path)
