"""Sinks: documents, manifests, tiles, reports and the archive log. Paths may be on any file system that Spark writes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranged


#: Bytes of the files that a task is handed at a time.
BATCH_BYTES = 4 << 20


def write_files(files: DataFrame, folder: str) -> int:
    """files (name, content): a file of exactly this name for each row, written beside it and then moved, so that readers see whole
    files and a repeated task replaces its own. Returns their number. Names must differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = ranged.filesystem(folder)
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content"), strict=True):
                with store.open_output_stream(f"{at}/.{name}.part") as f:
                    f.write(content.as_buffer() or b"")  # not copied
                store.move(f"{at}/.{name}.part", f"{at}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    store, at = ranged.filesystem(folder)
    store.create_dir(at, recursive=True)
    conf, most = files.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(most).rstrip("b")) <= BATCH_BYTES:
        conf.set(most, f"{BATCH_BYTES}b")
    return files.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_documents(documents: DataFrame, path: str) -> None:
    """documents (name, xml): a text file per tile, in a folder of the tile's name (Spark names the file itself)."""
    documents.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("tile"), F.col("xml").alias("value")).write.partitionBy("tile").mode("overwrite").text(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    """rows (run, ord, part, line) as text in order: the files of the folder, by name. ``runlog`` appends to a manifest in use."""
    rows.filter(F.trim("line") != "").orderBy("run", "ord", "part").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def read_manifest(spark, path: str) -> DataFrame:
    """run 0 rows of an existing manifest, in the order of its files and lines, for ``manifest.append``."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = texts.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("k", "line"))
    order = F.concat_ws("/", "file", F.lpad(F.col("k").cast("string"), 9, "0"))
    return lines.filter(F.trim("line") != "").select(F.lit(0).alias("run"), order.alias("ord"), F.lit(0).alias("part"), "line")


def write_tiles(tiled: DataFrame, path: str) -> None:
    """Points or scanlines with a tile ``name``, a folder each. Rows of a tile are brought together first, in files of bounded size."""
    dealt = tiled.withColumn("tile_key", F.col("name")).hint("rebalance", "tile_key")
    dealt.write.partitionBy("tile_key").option("maxRecordsPerFile", 5_000_000).mode("overwrite").parquet(path)


def write_report(groups: DataFrame, path: str) -> None:
    """Group report or diagnosis as CSV with semicolons."""
    groups.orderBy("tile", "root_row", "root_c").write.mode("overwrite").csv(path, sep=";", header=True)


def log_import(log_path: str, imports: DataFrame) -> None:
    """imports (stamp, gds, area, line, link): one appended row each."""
    text = F.concat(F.col("stamp"), F.lit("  "), F.concat_ws("_", "gds", "area", "line"), F.lit(" = "), F.col("link"))
    imports.select(text.alias("value")).write.mode("append").text(log_path)
