"""Exact deduplication by composable polynomial fingerprints.

A text's UTF-8 bytes are cut into chunks; each chunk is hashed on its own as a polynomial modulo two primes, and the
hashes of neighbours combine by length-shifted arithmetic: ``h(AB) = h(A) * B**len(B) + h(B)``. Texts over
``huge_bytes`` are cut into rows first, so that their chunks are hashed by many tasks. Rows with equal fingerprint and
length are then compared chunk by chunk with their group's representative; a row that differs (a collision) is grouped
by its SHA-256 instead, so the result is exact.

Defined cases: a null text counts as empty; empty texts are equal to each other; a table without rows gives no rows;
of repeated rows (same id and text) exactly one is kept; a null id is less than any other; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_broadcast, map_pandas, own, stash

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_220_703_125)
CHUNK = 1 << 16
HUGE_BYTES = 8 << 20
#: Members of a group that meet a copy of its representative in one task.
SHARE = 256


def power_tables(chunk: int = CHUNK) -> list[np.ndarray]:
    """Per prime, ``base**(chunk-1) .. base**0``."""
    tables = []
    for p, b in zip(PRIMES, BASES, strict=True):
        t = np.empty(chunk, np.uint64)
        x = 1
        for i in range(chunk - 1, -1, -1):
            t[i] = x
            x = x * b % p
        tables.append(t)
    return tables


def chunk_hash(data: bytes, tables: list[np.ndarray]) -> tuple[int, int]:
    """Hash of one chunk of at most ``CHUNK`` bytes. A byte counts as its value plus one, so zeros count."""
    c = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    if not len(c):
        return 0, 0
    return tuple(int((c * t[-len(c) :]).sum(dtype=np.uint64)) % p for t, p in zip(tables, PRIMES, strict=True))


def combine(left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
    """Fingerprint of two neighbours from theirs."""
    return tuple(
        (a * pow(b, right_len, p) + c) % p for a, c, b, p in zip(left, right, BASES, PRIMES, strict=True)
    )


def fingerprint(data: bytes, tables: list[np.ndarray]) -> int:
    """Both residues of all of ``data`` in one non-negative long."""
    h = (0, 0)
    for i in range(0, len(data), CHUNK):
        part = data[i : i + CHUNK]
        h = combine(h, chunk_hash(part, tables), len(part))
    return h[0] << 31 | h[1]


def same_text(a: bytes, b: bytes) -> bool:
    """Chunkwise comparison; stops at the first chunk that differs."""
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = power_tables()
    for pdf in batches:
        yield pdf.assign(fp=[fingerprint(t.encode(), tables) for t in pdf.text])


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = power_tables()
    for pdf in batches:
        fps = [fingerprint(bytes(x), tables) for x in pdf.piece]
        yield pdf.drop(columns="piece").assign(h=fps)


def _join_pieces(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
    """One huge text: a row for each of its pieces (a few bytes for each ``HUGE_BYTES`` of text)."""
    h = (0, 0)
    for x, n in pdf.sort_values("k")[["h", "len"]].itertuples(index=False):
        h = combine(h, (int(x) >> 31, int(x) & 0x7FFFFFFF), int(n))
    return pd.DataFrame({"text_sha256": [key[0]], "fp": [h[0] << 31 | h[1]]})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        same = [same_text(a.encode(), b.encode()) for a, b in zip(pdf.text, pdf.rep_text, strict=True)]
        yield pdf.loc[~np.array(same, bool), ["fp", "n_bytes", "text_sha256"]]


def with_fingerprints(docs: DataFrame, huge_bytes: int = HUGE_BYTES) -> DataFrame:
    """doc_id, text, n_bytes, text_sha256, fp."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumns({"n_bytes": F.octet_length("text").cast("long"), "text_sha256": F.sha2("text", 256)})
    schema = T.StructType([*base.schema.fields, T.StructField("fp", T.LongType())])
    small = map_pandas(base.filter(F.col("n_bytes") <= huge_bytes), _whole, schema)
    huge = base.filter(F.col("n_bytes") > huge_bytes)
    cut = (
        huge.select("text_sha256", F.encode("text", "utf-8").alias("raw"))
        .dropDuplicates(["text_sha256"])
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.expr(f"int((octet_length(raw) - 1) / {huge_bytes})"))))
        .select("text_sha256", "k", F.expr(f"substring(raw, k * {huge_bytes} + 1, {huge_bytes})").alias("piece"))
        .withColumn("len", F.octet_length("piece").cast("long"))
        .repartition("text_sha256", "k")
    )
    cut = map_pandas(cut, _pieces, "text_sha256 string, k int, len long, h long")
    whole = cut.groupBy("text_sha256").applyInPandas(_join_pieces, "text_sha256 string, fp long")
    return small.unionByName(huge.join(whole, "text_sha256").select(small.columns))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge_bytes: int = HUGE_BYTES
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = with_fingerprints(own(docs, id_col, text_col), huge_bytes)
    marks = stash(texts.select("doc_id", "n_bytes", "fp", "text_sha256"), "exact-marks")
    key = ["fp", "n_bytes"]
    groups = stash(
        marks.groupBy(key).agg(F.count("*").alias("n"), F.max("doc_id").alias("rep_id"))
        .filter("n > 1")
        .select(*key, "rep_id", F.ceil(F.col("n") / SHARE).cast("int").alias("salts")),
        "exact-groups",
    )
    members = texts.join(bounded_broadcast(groups), key)
    reps = members.filter("doc_id <=> rep_id").groupBy(*key, "salts").agg(F.min("text").alias("rep_text"))
    # a large group's representative goes to many tasks, each with its share of the members
    reps = reps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    members = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    differing = stash(
        map_pandas(
            members.filter("NOT (doc_id <=> rep_id)").select("text", "text_sha256", "salt", *key).join(reps, [*key, "salt"]),
            _compare,
            "fp long, n_bytes long, text_sha256 string",
        ),
        "exact-collisions",
    )
    odd = bounded_broadcast(differing.distinct().withColumn("odd", F.col("text_sha256")))
    marks = marks.join(odd, ["fp", "n_bytes", "text_sha256"], "left")
    key = ["fp", "n_bytes", "odd"]
    marks = marks.withColumn("odd", F.coalesce("odd", F.lit("")))
    sizes = marks.groupBy(key).agg(F.count("*").alias("n"), F.max("doc_id").alias("rep_id")).filter("n > 1")
    # of rows with the largest id, only those that share it have to be told apart
    ties = marks.join(bounded_broadcast(stash(sizes, "exact-sizes")), key, "left")
    ties = ties.withColumns({"group_size": F.coalesce("n", F.lit(1).cast("long")), "keep_id": F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("rep_id"))})
    last = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rest = ties.filter(~last).withColumn("kept", F.lit(False))
    first = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("fp"))
    return rest.unionByName(ties.filter(last).withColumn("kept", first == 1)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with all their columns."""
    marks = stash(exact_groups(docs, id_col, text_col), "exact-result")
    rows = marks.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(
        F.count("*").alias("__n"), F.max("kept").alias("__kept")
    )
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.sha2(F.coalesce(docs[text_col], F.lit("")), 256) == F.col("__sha"))
    gone = bounded_broadcast(stash(rows.filter("NOT __kept OR __n > 1").select("__id", "__sha"), "exact-gone"))
    # rows that are there several times, of which one stays
    again = bounded_broadcast(stash(rows.filter("__kept AND __n > 1").select("__id", "__sha"), "exact-again"))
    once = docs.join(again, same, "left_semi").withColumn("__s", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    return docs.join(gone, same, "left_anti").unionByName(once.dropDuplicates([id_col, "__s"]).drop("__s"))
