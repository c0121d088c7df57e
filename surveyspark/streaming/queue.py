"""Waiting packages as a stream: one row a package, of its first XML by name, however its files arrive.

State is kept for each package: the first document so far (files of NV itself before those of its folders, then by path) and when the
package was first seen. A timer ends the wait after ``settle``; then the row goes out, once, and the package stays known for
``remember``, so files that come later, and restarts, give no second row.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from surveyspark.sources.files import package_documents, package_xml

SCHEMA = "catalog string, package string, path string, xml string, arrived timestamp"
ROW, STATE = "catalog string, package string, path string, xml string", "depth int, path string, xml string, first_ms long, done boolean"


def arriving(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """Rows of Parquet files as they appear in a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def milliseconds(text: str) -> int:
    return int(pd.Timedelta(text).total_seconds() * 1000)


def first_documents(stream: DataFrame, settle: str = "10 minutes", remember: str = "60 days") -> DataFrame:
    """catalog, package, path, xml of each package's first document, ``settle`` after the package was first seen."""
    wait, keep = milliseconds(settle), milliseconds(remember)

    def choose(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        depth, path, xml, first, done = state.get if state.exists else (None, None, None, now, False)
        if state.hasTimedOut and done:
            state.remove()
            return
        for rows in batches:
            for d, p, x in zip(rows.depth.tolist(), rows.path.tolist(), rows.xml.tolist(), strict=True):
                if not done and (path is None or (d, p) < (depth, path)):
                    depth, path, xml = d, p, x
        if not done and (state.hasTimedOut or now >= first + wait):
            yield pd.DataFrame({"catalog": [key[0]], "package": [key[1]], "path": [path], "xml": [xml]})
            xml, done = "", True
        state.update((depth, path, xml, first, done))
        state.setTimeoutDuration(max(1, first + wait + (keep if done else 0) - now))

    found = package_documents(stream).select("catalog", "package", "path", "xml", "depth")
    return found.groupBy("catalog", "package").applyInPandasWithState(choose, ROW, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def into_queue(stream: DataFrame, table_path: str, checkpoint: str, settle: str = "10 minutes", every: str = "1 minute") -> StreamingQuery:
    """Packages whose wait is over, written under the number of their batch, so a repeated batch replaces itself.

    Timers also end waits while nothing arrives, so the query runs on until it is stopped (``until_idle``).
    """

    def write(batch: DataFrame, number: int) -> None:
        package_xml(batch).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    out = first_documents(stream, settle).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return out.trigger(processingTime=every).start()


def until_idle(query: StreamingQuery, seconds: float = 600) -> None:
    """Stop the query after a batch without input, when all arrivals were read and due timers had their turn.

    The first batch of a run doesn't tell: it may repeat one that an earlier run was stopped in, with the files and the time of then.
    """
    end, first = time.monotonic() + seconds, None
    try:
        while query.isActive and time.monotonic() < end:
            if last := query.lastProgress:
                first = last["batchId"] if first is None else first
                repeated = last["batchId"] == first and "addBatch" in last["durationMs"]  # without addBatch no batch ran, as nothing is new
                if last["numInputRows"] == 0 and not repeated:
                    return
            time.sleep(0.2)
        raise query.exception() or TimeoutError(f"input after {seconds} seconds")
    finally:
        query.stop()
