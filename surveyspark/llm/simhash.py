"""SimHash near-duplicates by pigeonhole blocks.

1. *Fingerprints.* Each shingle of a text gives 64 bits; a bit of the fingerprint is 1 if it is set in over half of them.
   Equal fingerprints are one point from here on, so copies cost nothing more.
2. *Blocks.* If two fingerprints differ in at most ``distance`` bits and the bits are split into ``distance + 1`` blocks, one
   block is equal in both. So every point goes to one bucket for each block, that of the block's value, and linked points
   share a bucket.
3. *Recursion.* A bucket of more than ``leaf`` points is split by the same rule on the bits that are still free in it: the
   pairs in it differ by at most ``distance`` of these too. Sizes are counted before any row is sent, so no task gets a
   large bucket. Each turn leaves three quarters of the bits free, and a bucket has at most 2^free points, so it ends.
4. *Verification.* In a small bucket all pairs are compared by Hamming distance, in arrays; only a forest of the links that
   were found leaves the task (at most one link less than points), not the pairs.
5. *Components* of the links, named by the least id.

Defined cases: null, empty and blank texts have no shingle and the fingerprint zero, which is linked like any other; fewer words
than a shingle make one shingle; rows that share an id are rows of their own with that id; a null id is linked like any
other, and its component is the least id reachable, null if there is none; a table without rows gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, own, sliced, stash
from .jaccard_join import components

WORDS, DISTANCE, SEED = 3, 3, 42
#: Points of a bucket that is compared in one task.
LEAF = 512
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 15


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of a text in UTF-8, unsigned. A-Z are lower-cased, words are split at ASCII white space."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    k = min(words, len(parts))
    n = len(parts) - k + 1
    shingles = map(b" ".join, zip(*(parts[i : i + n] for i in range(k)), strict=True))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, AT_ONCE):
        raw = h[i : i + AT_ONCE].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(words: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            point = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(point)], names=["doc_id", "point"])

    return run


def finer(mask: int, parts: int) -> list[int]:
    """``mask`` with each block of its free bits: these are dealt to ``parts`` blocks of nearly equal width."""
    free = [b for b in range(64) if not mask >> b & 1]
    ends = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(ends, ends[1:], strict=False)]


def bucket_forest(bucket: np.ndarray, point: np.ndarray, distance: int) -> np.ndarray:
    """Pairs of indices that link the points of the same bucket within ``distance``, a forest. Rows are sorted by bucket.

    Each point is compared with the next, the one after it and so on, for all buckets at once.
    """
    n = len(point)
    root = np.arange(n)
    found = []
    at, step = np.arange(n), 1
    while True:
        at = at[at + step < n]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            return np.array(found, np.int64).reshape(-1, 2)
        near = at[np.bitwise_count(point[at] ^ point[at + step]) <= distance]
        near = near[root[near] != root[near + step]]
        for a, b in zip(near.tolist(), (near + step).tolist(), strict=True):
            x, y = a, b
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((a, b))
        if len(near):
            while (up := root[root]).tolist() != root.tolist():
                root = up
        step += 1


def _verify(distance: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (mask, key, point) sorted by bucket to links a, b. The last bucket of a batch waits for the next one."""

    def links(mask: np.ndarray, key: np.ndarray, point: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])
        pairs = bucket_forest(np.cumsum(new), point.view(np.uint64), distance)
        return pa.RecordBatch.from_arrays([pa.array(point[pairs[:, 0]]), pa.array(point[pairs[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("mask", "key", "point"), strict=True)]
            mask, key, _ = held
            cut = int(np.argmax((key == key[-1]) & (mask == mask[-1])))
            if cut:
                yield links(*[h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(*held)

    return run


def near_links(points: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> list[DataFrame]:
    """Links a, b between the distinct ``points`` (long) within ``distance`` bits: all that connects them, in forests of buckets."""
    leaf = max(leaf, 1 << distance)  # so a larger bucket has more free bits than ``distance``, one for each block at least
    spark = points.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks, rows, links = [0], points.select(F.lit(0).cast("long").alias("mask"), "point"), []
    while True:
        signed = lambda m: m - (1 << 64) if m >> 63 else m
        steps = [(signed(m), signed(x)) for m in masks for x in finer(m, distance + 1)]
        # at most (distance + 1) ** turns rows; the turns are bounded by the number of bits
        table = F.broadcast(spark.createDataFrame(steps, "mask long, next long"))
        dealt = rows.join(table, "mask").select(F.col("next").alias("mask"), F.col("next").bitwiseAND(F.col("point")).alias("key"), "point")
        if len({x for _, x in steps}) < len(steps):  # else no row comes twice
            dealt = dealt.distinct()
        sizes = dealt.groupBy("mask", "key").count().filter("count > 1")
        sizes = stash(sizes.select("mask", "key", (F.col("count") > leaf).alias("large")), "simhash-buckets")
        told = dealt.join(bounded_broadcast(sizes), ["mask", "key"])
        small = told.filter("NOT large").repartition(n_parts, "mask", "key").sortWithinPartitions("mask", "key", "point")
        links.append(stash(map_arrow(small.select("mask", "key", "point"), _verify(distance), "a long, b long"), "simhash-links"))
        large = sizes.filter("large").select("mask").distinct().collect()  # masks, not buckets: bounded as above
        if not large:
            return links
        masks = [x.mask % (1 << 64) for x in large]
        rows = stash(told.filter("large").select("mask", "point"), "simhash-large")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE, seed: int = SEED, leaf: int = LEAF
) -> DataFrame:
    """One row per input row: doc_id, point (its fingerprint as a signed long), copies (rows with this fingerprint), component_id."""
    docs = own(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stash(map_arrow(docs, _fingerprints(words, seed), f"doc_id {kind}, point long"), "simhash-rows")
    points = stash(rows.groupBy("point").agg(F.min("doc_id").alias("name"), F.count("*").alias("copies")), "simhash-points")
    edges, *more = near_links(points, distance, leaf)
    for x in more:
        edges = edges.unionByName(x)
    named = components(edges, points.select(F.col("point").alias("node"), "name"))
    home = points.join(named, points.point == named.node, "left").filter("copies > 1 OR node IS NOT NULL")
    home = stash(home.select("point", "copies", F.coalesce("component", "name").alias("component")), "simhash-home")
    return rows.join(bounded_broadcast(home), "point", "left").select(
        "doc_id", "point", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), F.coalesce("component", "doc_id").alias("component_id")
    )
