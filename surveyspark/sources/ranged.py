"""A data source of files that reads ranges of them: heads of files, and checksums in chunks. No file is held in a row.

    spark.read.format("survey_files").option("head", 375).option("checksum", "true").load(folder)

Columns: path, name, extension (lower-cased, with its dot), length, modified; ``head`` (at most so many first bytes) and ``md5``
(of the whole file, read in chunks) if asked for. Filters on ``extension`` are taken before any file is opened if
``spark.sql.python.filterPushdown.enabled`` is set in the session and the option ``pushdown`` says so, as ``scan`` does; the
option ``extensions`` (comma-separated) does without.

Files come sorted by path and are dealt to tasks by the bytes that are read of them. MD5 is a sequential hash, so a file's checksum
is one task's work, but in constant memory. Paths are local (the same on all machines) or of any store that Arrow knows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

#: Bytes of a chunk, what opening a file and what naming one that stays closed cost in bytes, and the bytes of a task.
CHUNK, OPEN_COST, NAME_COST, TASK_BYTES = 8 << 20, 4 << 20, 4 << 10, 512 << 20
#: Files in a batch of rows.
ROWS = 256


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    local = re.sub(r"^file:(//(?=/))?", "", path)
    return fs.FileSystem.from_uri(path) if "://" in local else (fs.LocalFileSystem(), local)


def extension_of(name: str) -> str:
    return (m[1].lower() if (m := re.search(r"[^.](\.[^.]*)$", name)) else "")


def md5_of(stream, chunk: int = CHUNK) -> str:
    """Hex MD5 of what is left of a stream; at most ``chunk`` bytes are held."""
    state = hashlib.md5()
    while data := stream.read(chunk):
        state.update(data)
    return state.hexdigest()


class Files(InputPartition):
    def __init__(self, rows: list[tuple]) -> None:
        self.rows = rows


class FileReader(DataSourceReader):
    def __init__(self, options: dict, schema) -> None:
        get = lambda k, d: options.get(k, d)
        self.path, self.columns = options["path"], schema.names
        self.recursive = str(get("recursive", "false")).lower() == "true"
        self.head, self.chunk = int(get("head", 0)), int(get("chunk", CHUNK))
        self.task_bytes = int(get("taskBytes", TASK_BYTES))
        named = [x.strip().lower() for x in str(get("extensions", "")).split(",") if x.strip()]
        self.extensions = set(named) if named else None

    def partitions(self) -> list[Files]:
        store, at = filesystem(self.path)
        found = store.get_file_info(at)
        infos = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=self.recursive))
        rows = sorted(
            (i.path, i.base_name, extension_of(i.base_name), i.size, i.mtime) for i in infos
            if i.type == fs.FileType.File and (self.extensions is None or extension_of(i.base_name) in self.extensions)
        )
        parts: list[list[tuple]] = [[]]
        cost = 0
        opened = not {"head", "md5"}.isdisjoint(self.columns)
        for row in rows:
            reads = OPEN_COST + (row[3] if "md5" in self.columns else min(row[3], self.head)) if opened else NAME_COST
            if parts[-1] and cost + reads > self.task_bytes:
                parts.append([])
                cost = 0
            parts[-1].append(row)
            cost += reads
        return [Files(p) for p in parts]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        for k in range(0, len(partition.rows), ROWS):
            some = partition.rows[k : k + ROWS]
            cols = dict(zip(("path", "name", "extension", "length", "modified"), map(list, zip(*some, strict=True)), strict=True))
            for c in ("head", "md5"):
                if c in self.columns:
                    cols[c] = [self.value(store, row[0], c) for row in some]
            kinds = {"length": pa.int64(), "modified": pa.timestamp("us", tz="UTC"), "head": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(cols[c], kinds.get(c, pa.string())) for c in self.columns], names=self.columns)

    def value(self, store: fs.FileSystem, path: str, column: str) -> bytes | str:
        if column == "head":
            with store.open_input_file(path) as f:
                return f.read_at(min(self.head, f.size()), 0)
        with store.open_input_stream(path) as f:
            return md5_of(f, self.chunk)


class PushingReader(FileReader):
    """Spark refuses a reader of this kind unless pushing filters to Python sources is enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 (the interface's name)
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("extension",):
                self.extensions = set(values) if self.extensions is None else self.extensions & set(values)
            elif not isinstance(f, IsNotNull):  # no column has nulls
                yield f


class FileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "survey_files"

    def schema(self) -> str:
        kind = "path string, name string, extension string, length long, modified timestamp"
        kind += ", head binary" if int(self.options.get("head", 0)) else ""
        return kind + (", md5 string" if str(self.options.get("checksum", "false")).lower() == "true" else "")

    def reader(self, schema) -> FileReader:
        kind = PushingReader if str(self.options.get("pushdown", "false")).lower() == "true" else FileReader
        return kind(dict(self.options), schema)


def scan(spark: SparkSession, path: str, **options) -> DataFrame:
    """Files of a folder by the source above."""
    spark.dataSource.register(FileSource)
    options = {"pushdown": spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"), **options}
    return spark.read.format(FileSource.name()).options(**{k: str(v) for k, v in options.items()}).load(path)
