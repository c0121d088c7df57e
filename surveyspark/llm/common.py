"""Shared helpers of the training-data operators: inputs, the shared folder and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from surveyspark.sources.shared import saved, shared_dir  # noqa: F401 (shared_dir is used by the operators)

#: Bytes up to which a stashed table may be broadcast (in Spark's rows, not in the file); beyond it joins shuffle.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut and survives lost executors."""
    return saved(df, name)


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows take at most ``limit`` bytes, else as it is (a shuffled join then).

    ``df`` should read a stashed table, as its rows are counted here. A row's size is estimated from its type; strings,
    arrays and binaries are measured.
    """
    wide = [c for c in df.schema if isinstance(c.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))]
    size = F.lit(16 + 8 * len(df.columns))
    for c in wide:
        kind = c.dataType
        own = F.octet_length(c.name) if isinstance(kind, (T.StringType, T.BinaryType)) else F.octet_length(F.to_json(c.name))
        size = size + F.coalesce(own, F.lit(0))
    total = df.select(F.sum(size.cast("long")).alias("b")).first().b or 0
    return F.broadcast(df) if total <= limit else df


def own(df: DataFrame, id_col: str, text_col: str, **extra: str) -> DataFrame:
    """Only the columns an operator works on, so that further columns of the input cannot clash with its own."""
    return df.select(
        df[id_col].alias("doc_id"), df[text_col].alias("text"), *[df[v].alias(k) for k, v in extra.items()]
    )


def frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """A batch in pandas. Integer columns with nulls keep exact integers."""
    cols = {}
    for name, col in zip(batch.schema.names, batch.columns, strict=True):
        exact = pa.types.is_integer(col.type) and col.null_count
        cols[name] = col.to_pandas(types_mapper={col.type: pd.Int64Dtype()}.get) if exact else col.to_pandas()
    return pd.DataFrame(cols)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in parts, so that few texts are held as Python objects at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def trim() -> None:
    """Give a worker's free memory back, as workers live on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


#: Bytes of a batch that goes to a Python worker, so that neither side holds many texts at once.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_BYTES``, whose workers give their memory back in the end.

    The session's own batch size stays if it is smaller.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH).rstrip("b")) <= BATCH_BYTES:
        conf.set(_BATCH, f"{BATCH_BYTES}b")

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(them)
        trim()

    return df.mapInArrow(batches, schema)


def map_pandas(
    df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: T.StructType | str
) -> DataFrame:
    """``mapInPandas`` that keeps long ids exact where some are null."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in kind])
    arrow = to_arrow_schema(kind)

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pdf in run(frame(b) for b in sliced(them)):
            yield pa.RecordBatch.from_pandas(pdf[arrow.names], schema=arrow, preserve_index=False)

    return map_arrow(df, batches, kind)
