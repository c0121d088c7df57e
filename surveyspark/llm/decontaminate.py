"""Benchmark decontamination with DataFrame operations only.

The benchmark's normalised 13-word windows form a hash set that is broadcast while its size is within a bound and joined by
shuffle otherwise. Documents are cut into the same windows; a window whose hash is in the set is verified word by word, and
the words inside verified windows are counted as the union of their spans.

Defined cases: a null text or item has no words; an item of fewer words than a window, but at least one, is one window;
repeated items and repeated document rows each count as they stand; an empty benchmark hits nothing; further columns of
the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, bounded_broadcast, own, stash

WINDOW = 13
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The ASCII characters that no word has.
BETWEEN = "".join(map(chr, range(128))).translate(str.maketrans("", "", UPPER + LOWER + "0123456789"))


def signature(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("sig"), F.hash(text).alias("sig2")]


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _starts(words: str, size: Column | str) -> Column:
    """0-based window starts; none where the text is shorter."""
    return F.expr(f"CASE WHEN size({words}) >= {size} THEN sequence(0, size({words}) - {size}) ELSE array() END")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, len, h (hash), words of each distinct window."""
    words = (
        benchmark.select("item", words_of(F.col("text")).alias("w"))
        .filter(F.size("w") > 0)
        .withColumn("len", F.least(F.size("w"), F.lit(window)))
    )
    return (
        words.withColumn("at", F.explode(_starts("w", "len")))
        .select(
            "item",
            "len",
            F.expr("xxhash64(slice(w, at + 1, len))").alias("h"),
            F.expr("slice(w, at + 1, len)").alias("words"),
        )
        .distinct()
    )


def window_hits(docs: DataFrame, windows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """sig, sig2, at, len, item of every verified occurrence; docs: text; windows: stashed.

    ``sig, sig2`` are 96 bits of hash of the text; rows with the same text share their hits. limit: bytes up to which the
    hash set is broadcast.
    """
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())  # at most as many as words in a window
    docs = docs.select("text", *signature(F.col("text"))).withColumn("w", words_of(F.col("text")))
    by_len = [
        F.expr(
            f"CASE WHEN size(w) >= {n} THEN transform(sequence(0, size(w) - {n}), "
            f"i -> struct(i AS at, {n} AS len, xxhash64(slice(w, i + 1, {n})) AS h)) "
            "ELSE CAST(array() AS array<struct<at:int,len:int,h:bigint>>) END"
        )
        for n in lengths
    ]
    if not by_len:
        by_len = [F.expr("CAST(array() AS array<struct<at:int,len:int,h:bigint>>)")]
    keys = bounded_broadcast(windows.select("h", "len").distinct(), limit)
    found = (
        docs.select("sig", "sig2", F.inline(F.concat(*by_len)))
        .join(keys, ["h", "len"])
        .select("sig", "sig2", "at", "len", "h")
    )
    found = stash(found.distinct(), "decon-found")
    texts = docs.select("sig", "sig2", "text").join(
        bounded_broadcast(found.select("sig", "sig2").distinct(), limit), ["sig", "sig2"], "left_semi"
    )
    texts = texts.dropDuplicates(["sig", "sig2"]).select("sig", "sig2", words_of(F.col("text")).alias("e"))
    spans = found.join(texts, ["sig", "sig2"]).select(
        "sig", "sig2", "at", "len", "h", F.expr("slice(e, at + 1, len)").alias("words")
    )
    items = bounded_broadcast(windows, limit)
    return spans.join(items, ["h", "len", "words"]).select("sig", "sig2", "at", "len", "item")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the maximal runs of hit words as (start, end), end exclusive. A document is contaminated if at least a
    twentieth of its words are hit.
    """
    docs = own(docs, id_col, text_col)
    items = benchmark.select(
        benchmark[item_col].cast("string").alias("item"), benchmark[item_text_col].alias("text")
    )
    windows = stash(benchmark_windows(items, window), "decon-windows")
    hits = stash(window_hits(docs, windows), "decon-hits")
    key = ["sig", "sig2"]
    before = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.groupBy(*key, "at").agg(F.max("len").alias("len")).withColumn("end", F.expr("at + len"))
    runs = ends.withColumn("open", F.coalesce(F.max("end").over(before), F.lit(-1)))
    islands = runs.withColumn(
        "run",
        F.sum((F.col("at") > F.col("open")).cast("int")).over(Window.partitionBy(key).orderBy("at")),
    )
    spans = islands.groupBy(*key, "run").agg(F.min("at").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy(key).agg(
        F.sum(F.expr("end - start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    named = (
        hits.select(*key, "item")
        .distinct()
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select(*key, F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    found = bounded_broadcast(stash(spans.join(named, key), "decon-docs"))
    counted = docs.select("doc_id", *signature(F.col("text")), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return (
        counted.join(found, key, "left")
        .withColumns(
            {
                "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
                "n_items": F.coalesce("n_items", F.lit(0)).cast("long"),
                "items_sha256": F.coalesce("items_sha256", F.sha2(F.lit(""), 256)),
            }
        )
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
        .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", *key)
    )


def _same_text(text: Column) -> Column:
    return (F.xxhash64(text) == F.col("__sig")) & (F.hash(text) == F.col("__sig2"))


def _marks(rows: DataFrame, *more: str) -> DataFrame:
    names = ["sig", "sig2", *more]
    marks = rows.dropDuplicates(["sig", "sig2"]).select([F.col(c).alias(f"__{c}") for c in names])
    return bounded_broadcast(stash(marks, "decon-marks"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The input rows that are not contaminated, with all their columns."""
    bad = _marks(contamination(docs, benchmark, id_col, text_col, **kw).filter("contaminated"))
    return docs.join(bad, _same_text(docs[text_col]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The input rows with the hit words taken out of the text; texts without a hit stay as they are.

    The kept words of a text with hits are joined by one space.
    """
    bad = _marks(contamination(docs, benchmark, id_col, text_col, **kw).filter("n_hit > 0"), "spans")
    words = F.regexp_extract_all(docs[text_col], F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    joined = docs.withColumn("__w", words).join(bad, _same_text(docs[text_col]), "left")
    kept = F.expr("array_join(filter(__w, (x, i) -> NOT exists(__spans, s -> i >= s.start AND i < s.end)), ' ')")
    return joined.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(kept)).select(docs.columns)
