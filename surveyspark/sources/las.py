"""LAS and LAZ header inventory. The header is not compressed, so its bytes are enough."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ranged

#: Bytes of the longest header.
HEAD = 375

SCHEMA = (
    "name string, minor_version int, format int, points long, header_size int, point_length int, encoding int, "
    "scale array<double>, offset array<double>, minx double, maxx double, miny double, maxy double, minz double, maxz double, problem string"
)
FIELDS = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]


def header(name: str, raw: bytes | None) -> dict:
    """Values of one header; problem says why there are none."""
    out: dict = dict.fromkeys(FIELDS)
    out["name"] = name
    if raw is None or len(raw) < 227 or raw[:4] != b"LASF":
        return out | {"problem": "no LAS header"}
    le = lambda kind, at: struct.unpack_from(f"<{kind}", raw, at)
    minor = raw[25]
    points = le("Q", 247)[0] if minor >= 4 and len(raw) >= 255 else le("I", 107)[0]
    maxx, minx, maxy, miny, maxz, minz = le("6d", 179)
    return out | {
        "minor_version": minor, "format": raw[104] & 0x3F, "points": points, "header_size": le("H", 94)[0], "point_length": le("H", 105)[0],
        "encoding": le("H", 6)[0], "scale": list(le("3d", 131)), "offset": list(le("3d", 155)),
        "minx": minx, "maxx": maxx, "miny": miny, "maxy": maxy, "minz": minz, "maxz": maxz,
    }


def inventory(spark: SparkSession, path: str, recursive: bool = False, **options) -> DataFrame:
    """name, path, length and header values of the LAS and LAZ files of a folder. Only the first bytes of each file are read."""
    files = ranged.scan(spark, path, head=HEAD, extensions=".las,.laz", recursive=recursive, **options)
    return headers(files.withColumnRenamed("head", "content"), ("name", "path", "length"))


def headers(files: DataFrame, keep: tuple[str, ...] = ("name",)) -> DataFrame:
    """files (name, content, ..) -> one row of header values each, with the columns ``keep``. Only the first bytes go to Python;
    ``inventory`` doesn't read more than these either."""
    kept = files.select(*keep).schema
    kinds = {"problem": pa.string(), "points": pa.int64(), "scale": pa.list_(pa.float64()), "offset": pa.list_(pa.float64())}
    ints = ("minor_version", "format", "header_size", "point_length", "encoding")
    fields = FIELDS[1:]
    schema = pa.schema([(f, kinds.get(f, pa.int32() if f in ints else pa.float64())) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [header(n, r) for n, r in zip(b.column("name").to_pylist(), b.column("head").to_pylist(), strict=True)]
            values = pa.RecordBatch.from_pylist([{f: r[f] for f in fields} for r in rows], schema=schema)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *values.columns], names=[*keep, *fields])

    out = T.StructType([*kept, *T.StructType.fromDDL(SCHEMA)[1:]])
    return files.select(*keep, F.substring("content", 1, HEAD).alias("head")).mapInArrow(run, out)
