"""Exact n-gram Jaccard join in the metric space of shingle sets: pivots, Voronoi regions, windows, recursion.

The distance of two documents is 1 less the Jaccard similarity of their sets of word shingles; linked are documents
within ``r``. Equal sets are one point. Points are joined in these steps.

1. *Regions.* In this space nearly all documents lie at distance 1 from each other, so document pivots alone would
   replicate everything everywhere. The outer pivots are therefore the one-shingle sets, in one fixed order (common
   shingles, found by counting, come last; then by hash). A point's Voronoi region is that of its nearest pivot, its first
   shingle. The window: if all of ``x``'s shingles before ``s`` are not in ``y``, then d(x, y) >= (their number) / |x|; so
   ``x`` is replicated to the regions of its leading shingles up to the share ``r``, and every pair within ``r`` meets in
   the region of its first common shingle.
2. *Small regions* (at most ``SMALL`` points) are compared directly; a bound by coordinates (the numbers of shingles in
   ``BUCKETS`` fixed reference sets) spares most exact comparisons.
3. *Large regions* get a document as pivot, the point with the fewest uncommon shingles (a copy with few edits lies in the
   middle of its family). Regions with the same pivot become one. All points are compared with the pivot; those within
   ``r`` of it form its ball and are linked to it, so pairs inside the ball are not needed. The other points are open.
4. *Recursion.* A region of more than ``LEAF`` points with open ones takes a further pivot ``q`` among these and is cut at a
   distance ``c`` from it into a near and a far region. By the triangle inequality only the points with
   c - r <= d(x, q) < c + r can be linked across the cut: these boundary points are replicated into a third region. The
   near region's ball is that of ``q``. Each part is a region again; the cut is where the parts make the least work, and
   where no cut helps (all points of a family lie at one distance), the region is a leaf.
5. *Leaves.* Open points are compared with each other and with the ball, in blocks of about ``BLOCK`` shingles against
   slices of ``SLICE``, so no task holds a whole region. A block's comparison is exact and gives a forest of links (each
   point one link to what it is linked with, and one where two trees meet), not all pairs.

The order of the shingles is free, so the list of common shingles may be bounded (``MAX_COMMON``) without any effect on the
result. A leaf costs in proportion to its open points times its points: families whose members lie just outside ``r`` of each
other, with no member or cut between, are compared within blocks in full.

Defined cases: null, empty and blank texts have empty sets and are linked with nothing; fewer words than a shingle make
one shingle; rows with equal sets are linked; rows that share an id are one document; a null id is linked like any other, and
its component is that of the least id reachable, null if there is none; a table without rows gives no rows; further columns of
the input are ignored. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, map_pandas, own, sliced, stash

WORDS, PERCENT = 5, 80
#: Prefix postings from which a shingle counts as common, and the most shingles in that list (8 bytes each).
COMMON, MAX_COMMON = 16, 200_000
SMALL, BUCKETS = 8, 256
#: Points of a region that is not split further, and turns of the recursion.
LEAF, DEPTH = 4096, 8
#: Shingles of a leaf's open points in a block, and of its points in a slice.
BLOCK, SLICE = 1 << 18, 1 << 20
#: Parts in which the points of a region meet its pivot.
SALTS = 16
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * ODD[1]
    h = (h ^ (h >> np.uint64(32))) * ODD[3]
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes. Lower-cased are A-Z, words are split at ASCII white space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, n)
    k = min(words, n)
    s = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        s = (s ^ h[i : n - k + 1 + i]) * ODD[i % 5]
        s ^= s >> np.uint64(31)
    return np.unique(mix(s).view(np.int64))


def point_id(s: np.ndarray) -> int:
    """Identity of a set."""
    u = s.view(np.uint64)
    with np.errstate(over="ignore"):
        x = np.array([mix(u).sum() ^ np.uint64(len(u)), mix(u ^ ODD[0]).sum()], np.uint64)
        return int((mix(x[:1]) + x[1:])[0].astype(np.int64))


def coordinates(s: np.ndarray) -> bytes:
    """Numbers of shingles in each reference set, at most 255."""
    return np.minimum(np.bincount(s.view(np.uint64) & np.uint64(BUCKETS - 1), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def window(n: int, percent: int) -> int:
    """Leading shingles whose regions a set of n shingles must reach."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def spread(percent: int) -> Column:
    """Largest symmetric difference of two linked sets of n and nq shingles."""
    return F.expr(f"n + nq - 2 * (({percent} * (n + nq) + {percent + 99}) div {percent + 100})")


def _leads(words: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All leading shingles by hash order, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([s[: window(len(s), percent)] for s in sets]))], names=["h"])

    return run


def _postings(words: int, percent: int, common: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf.text:
                s = shingle_set(t, words)
                k = window(len(s), percent)
                late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s if len(common) else np.zeros(len(s), bool)
                first = s[~late][:k]
                rows.append((point_id(s), len(s), len(s) - int(late.sum()), coordinates(s), first, s[late][: k - len(first)]))
            yield pd.DataFrame(rows, columns=["node", "n", "uncommon", "coords", "rare", "often"]).assign(doc_id=pdf.doc_id, sig=pdf.sig)

    return run


REGION = "kind int, h long, a long, b long, na long, nb long"


def _regions(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (often, h, n, node) to pairs of small regions (kind 0) and members of large ones (kind 1: a, na, and
    nb the number of uncommon shingles).

    State between batches: the points of one unfinished small region, or the key of a large one.
    """
    schema = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("h", "a", "b", "na", "nb")]])

    def table(kind: int, h, a, b, na, nb) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), kind, np.int32)), *map(pa.array, (h, a, b, na, nb))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = np.zeros((5, 0), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.vstack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("often", "h", "n", "node", "uncommon")])
            rows = np.hstack([held, rows])
            yield from emit(rows, large)
            held, large = rest(rows, large)
        if held.shape[1]:
            yield from finish(held)

    def bounds(rows: np.ndarray) -> np.ndarray:
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
        return np.append(np.nonzero(new)[0], rows.shape[1])

    def rest(rows: np.ndarray, large):
        """The last region may go on in the next batch."""
        start = bounds(rows)[-2]
        last = rows[:, start:]
        key = (int(last[0, 0]), int(last[1, 0]))
        if key == large or last[0, 0] or last.shape[1] > SMALL:
            return np.zeros((5, 0), np.int64), key
        return last, None

    def emit(rows: np.ndarray, large) -> Iterator[pa.RecordBatch]:
        at = bounds(rows)
        size = np.diff(at)
        key = (int(rows[0, at[-2]]), int(rows[1, at[-2]]))
        big = (size > SMALL) | (rows[0, at[:-1]] == 1)
        if large is not None and (int(rows[0, 0]), int(rows[1, 0])) == large:
            big[0] = True
        done = np.ones(len(size), bool)
        done[-1] = bool(big[-1]) or key == large
        yield from write(rows, size, big, done)

    def finish(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = np.array([rows.shape[1]])
        yield from write(rows, size, size > SMALL, np.ones(1, bool))

    def write(rows: np.ndarray, size: np.ndarray, big: np.ndarray, done: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = np.repeat(np.arange(len(size)), size)
        m = rows[:, big[of]]
        if m.shape[1]:
            yield table(1, m[1], m[3], m[3], m[2], m[4])
        few = rows[:, (done & ~big & (size > 1))[of]]
        for k in range(1, SMALL):
            if few.shape[1] <= k:
                break
            x, y = few[:, :-k], few[:, k:]
            ok = (x[1] == y[1]) & (x[0] == y[0]) & (x[3] != y[3]) & (100 * x[2] >= percent * y[2])
            if ok.any():
                x, y = x[:, ok], y[:, ok]
                yield table(0, x[1], np.minimum(x[3], y[3]), np.maximum(x[3], y[3]), np.where(x[3] < y[3], x[2], y[2]), np.where(x[3] < y[3], y[2], x[2]))

    return run


def shingle_sets(docs: DataFrame, points: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, n, s (sorted shingles) of these nodes; stashed. docs: doc_id, sig, text; points: node, rep."""
    used = stash(nodes.distinct().join(points.select("node", "rep"), "node").select("node", "rep.doc_id", "rep.sig"), "jaccard-used")
    near = bounded_broadcast(used.select(F.col("node"), F.col("doc_id").alias("__id"), F.col("sig").alias("__sig")))
    texts = docs.join(near, docs["doc_id"].eqNullSafe(F.col("__id")) & (docs["sig"] == F.col("__sig"))).select("node", "text")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = [shingle_set(t, words) for t in pdf.text]
            yield pd.DataFrame({"node": pdf.node, "n": [len(x) for x in s], "s": s})

    found = stash(map_pandas(texts, sets, "node long, n long, s array<long>"), "jaccard-sets")
    # repeated rows have the same id and text
    return found if found.count() == used.count() else stash(found.dropDuplicates(["node"]), "jaccard-sets-once")


def beside(rows: DataFrame, values: DataFrame, col: str, salts: int) -> DataFrame:
    """rows (node, q; stashed, narrow) with ``col`` of both as x and y. While they are few, the rows go to the values instead
    of the values to them. A pivot's value goes to ``salts`` tasks, so no region is one task."""
    pivots = bounded_broadcast(stash(rows.select("q").distinct(), "jaccard-q"))
    q = values.select(F.col("node").alias("q"), F.col(col).alias("y")).join(pivots, "q")
    q = q.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = bounded_broadcast(rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")))
    return values.select("node", F.col(col).alias("x")).join(salted, "node").join(q, ["q", "salt"]).drop("salt")


def with_bound(rows: DataFrame, points: DataFrame, salts: int = 1) -> DataFrame:
    """rows (node, q, n, nq) with low, the least possible symmetric difference by coordinates."""

    @F.pandas_udf("long")
    def low(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(v), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for v in (a, b))
        return pd.Series(np.abs(x - y).sum(1).astype(np.int64))

    return beside(rows, points, "coords", salts).withColumn("low", low("x", "y")).drop("x", "y")


def with_overlap(rows: DataFrame, sets: DataFrame, salts: int = 1) -> DataFrame:
    """rows (node, q) with i, the number of common shingles."""
    return beside(rows, sets, "s", salts).withColumn("i", F.size(F.array_intersect("x", "y")).cast("long")).drop("x", "y")


def linked(percent: int) -> Column:
    return 100 * F.col("i") >= percent * (F.col("n") + F.col("nq") - F.col("i"))


def best_cut(counts: list[int], percent: int) -> int:
    """Cell of the distance at which a region is cut, or -1. counts: points by distance, in steps of 0.05."""
    c, reach = np.asarray(counts, float), (100 - percent + 4) // 5
    total = c.sum()
    cost = [c[:k].sum() ** 2 + c[k:].sum() ** 2 + c[max(0, k - reach) : k + reach].sum() ** 2 for k in range(1, len(c))]
    k = int(np.argmin(cost))
    return k + 1 if cost[k] <= 0.7 * total**2 else -1


def split(docs: DataFrame, points: DataFrame, region: DataFrame, words: int, percent: int, leaf: int, turn: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """One turn of the recursion: (links to the new pivots, regions that are leaves, parts), or None if all are leaves."""
    share = region.groupBy("p").agg(F.count("*").alias("n_all"), F.min(F.when(F.col("open"), F.struct("u", "node", "n"))).alias("q"))
    large = stash(share.filter((F.col("n_all") > leaf) & F.col("q").isNotNull()).select("p", F.col("q.node").alias("q"), F.col("q.n").alias("nq")), f"jaccard-large-{turn}")
    if large.isEmpty():
        return None
    large = bounded_broadcast(large)
    rows = stash(region.join(large, "p").drop("d"), f"jaccard-rows-{turn}")
    sets = shingle_sets(docs, points, rows.select("node"), words)
    rows = with_overlap(rows, sets, SALTS).withColumns({"d": 1 - F.col("i") / (F.col("n") + F.col("nq") - F.col("i")), "linked": linked(percent)})
    rows = stash(rows, f"jaccard-split-{turn}")
    cell = F.least(F.floor(F.col("d") * 20), F.lit(20))
    counts = rows.groupBy("p").agg(F.array(*[F.count_if(cell == k) for k in range(21)]).alias("counts"))

    @F.pandas_udf("int")
    def cut_of(counts: pd.Series) -> pd.Series:
        return pd.Series([best_cut(x, percent) for x in counts], dtype="int32")

    cuts = stash(counts.select("p", cut_of("counts").alias("cut")), f"jaccard-cuts-{turn}")
    placed = rows.join(bounded_broadcast(cuts), "p")
    c, r = F.col("cut") / 20, 1 - percent / 100 + 1e-9
    parts = F.array(
        F.when(F.col("d") < c, F.lit(1)),
        F.when(F.col("d") >= c, F.lit(2)),
        F.when((F.col("d") >= c - r) & (F.col("d") < c + r), F.lit(3)),
    )
    cells = placed.filter("cut > 0").withColumn("part", F.explode(F.filter(parts, lambda x: x.isNotNull())))
    near = (F.col("part") == 1) & (F.col("node") != F.col("q"))
    parts = cells.filter((F.col("part") > 1) | near).select(
        F.xxhash64("p", "part").alias("p"), "node", "n", "u", F.when(F.col("part") == 1, ~F.col("linked")).otherwise(F.col("open")).alias("open")
    )
    links = rows.filter("linked AND node <> q").select(F.col("node").alias("a"), F.col("q").alias("b"))
    uncut = placed.filter("cut < 0").withColumn("d", F.lit(None).cast("double")).select(region.columns)
    fine = region.join(large.select("p"), "p", "left_anti").unionByName(uncut)
    return links, fine, stash(parts.withColumn("d", F.lit(None).cast("double")), f"jaccard-parts-{turn}")


class Block:
    """The sets of a block, for exact overlaps with other sets."""

    def __init__(self, node: np.ndarray, n: np.ndarray, values: np.ndarray, cells: int = 1 << 22) -> None:
        self.node, self.n, self.cells = node, n, cells
        owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
        order = np.argsort(values, kind="stable")
        self.owner = owner[order]
        self.keys, self.at, self.count = np.unique(values[order], return_index=True, return_counts=True)
        often = np.argsort(-self.count, kind="stable")[: max(1, 2 * cells // max(1, len(n)))]
        often = often[self.count[often] >= 16]
        self.row = np.full(len(self.keys), -1, np.int64)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), len(n)), np.float32)
        where, of = spans(self.at[often], self.count[often])
        self.dense[of, self.owner[where]] = 1

    def overlaps(self, n: np.ndarray, values: np.ndarray) -> np.ndarray:
        """len(n) x block: common shingles."""
        of = np.repeat(np.arange(len(n)), n)
        k = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        hit = self.keys[k] == values
        of, k = of[hit], k[hit]
        out = np.zeros((len(n), len(self.n)), np.float32)
        row = self.row[k]
        many = row >= 0
        if many.any():
            x = np.zeros((len(n), len(self.dense)), np.float32)
            x[of[many], row[many]] = 1
            out += x @ self.dense
        of, k = of[~many], k[~many]
        if len(k):
            where, back = spans(self.at[k], self.count[k])
            flat = np.bincount(of[back] * len(self.n) + self.owner[where], minlength=out.size)
            out += flat.reshape(out.shape)
        return out


def spans(at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the stretches at..at+count, and the stretch of each."""
    of = np.repeat(np.arange(len(at)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at, count), of


class Forest:
    """Links within a block's cell, without those that close a circle of the block's points."""

    def __init__(self, block: Block, percent: int) -> None:
        self.block, self.percent = block, percent
        self.tree = np.arange(len(block.n))

    def add(self, node: np.ndarray, n: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        b = self.block
        ends = np.cumsum(n)
        step = max(1, b.cells // max(1, len(b.n)))
        for lo in range(0, len(n), step):
            some = slice(lo, lo + step)
            v = values[ends[lo] - n[lo] : ends[min(lo + step, len(n)) - 1]]
            i = b.overlaps(n[some], v)
            linked = 100 * i >= self.percent * (n[some][:, None] + b.n[None, :] - i)
            linked &= node[some][:, None] != b.node[None, :]
            for k in np.nonzero(linked.any(1))[0]:
                to = np.nonzero(linked[k])[0]
                trees, first = np.unique(self.tree[to], return_index=True)
                out += [(int(node[lo + k]), int(b.node[to[f]])) for f in first]
                if len(trees) > 1:
                    self.tree[np.isin(self.tree, trees)] = trees[0]
        return out


def _leaves(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (p, block, part), the block's own points (mine) first, to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine, forest = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.vstack([batch.column(c).to_numpy() for c in ("p", "block", "part")])
            cuts = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(0))[0] + 1
            own_points = batch.column("mine").to_numpy()
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                key = tuple(keys[:, lo])
                if key != at:
                    if forest is None and mine:
                        _, out = start(at, mine)
                        yield links(out)
                    at, mine, forest = key, [], None
                middle = lo + int(own_points[lo:hi].sum())
                if middle > lo:
                    mine.append(columns(batch, lo, middle))
                if hi > middle and mine:
                    if forest is None:
                        forest, out = start(at, mine)
                        yield links(out)
                    for k in range(middle, hi, 512):
                        yield links(forest.add(*columns(batch, k, min(hi, k + 512))))
        if forest is None and mine:
            yield links(start(at, mine)[1])

    def columns(batch: pa.RecordBatch, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = batch.slice(lo, hi - lo)
        return some.column("node").to_numpy(), some.column("n").to_numpy(), some.column("s").flatten().to_numpy()

    def start(key: tuple, mine: list) -> tuple[Forest, list]:
        node, n, values = (np.concatenate(x) for x in zip(*mine, strict=True))
        forest = Forest(Block(node, n, values), percent)
        return forest, forest.add(node, n, values) if key[2] == 0 else []

    def links(out: list[tuple[int, int]]) -> pa.RecordBatch:
        a = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    return run


def _candidates(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (p, block, part), the block's own points (mine) first, to the points that the coordinates allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.vstack([batch.column(c).to_numpy() for c in ("p", "block", "part")])
            node, n, own_points = (batch.column(c).to_numpy() for c in ("node", "n", "mine"))
            coords = np.frombuffer(b"".join(batch.column("coords").to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16)
            cuts = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(0))[0] + 1
            found: list[tuple] = []
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if tuple(keys[:, lo]) != at:
                    at, mine = tuple(keys[:, lo]), []
                middle = lo + int(own_points[lo:hi].sum())
                if middle > lo:
                    mine.append((node[lo:middle], n[lo:middle], coords[lo:middle]))
                if mine:
                    b_node, b_n, b_coords = mine[0] if len(mine) == 1 else (np.concatenate(x) for x in zip(*mine, strict=True))
                    mine = [(b_node, b_n, b_coords)]
                    hit = np.zeros(len(b_node), bool)
                    # own points meet in the first part only
                    for i in range(lo if at[2] == 0 else middle, hi):
                        ok = (100 * np.minimum(b_n, n[i]) >= percent * np.maximum(b_n, n[i])) & (b_node != node[i])
                        k = np.nonzero(ok)[0]
                        both = b_n[k] + n[i]
                        k = k[np.abs(b_coords[k] - coords[i]).sum(1) <= both - 2 * ((percent * both + percent + 99) // (percent + 100))]
                        if len(k):
                            hit[k] = True
                            found.append((at[0], node[i]))
                    found += [(at[0], x) for x in b_node[hit]]
            some = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(some[:, 0]), pa.array(some[:, 1])], names=["p", "node"])

    return run


def leaf_links(docs: DataFrame, points: DataFrame, region: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """Links between the open points of leaves, and from these to the others (p, node, n, d, open); stashed."""
    w = F.when(F.col("open"), F.col("n"))
    share = region.groupBy("p").agg(F.sum(w).alias("w_open"), F.sum("n").alias("w_all"), F.min(F.when(F.col("open"), F.col("d"))).alias("d0"), F.count("*").alias("k"))
    share = share.filter("w_open IS NOT NULL AND k > 1").select("p", "d0", F.ceil(F.col("w_open") / BLOCK).alias("blocks"), F.ceil(F.col("w_all") / SLICE).alias("parts"))
    # the window: a point of the ball this far inside is out of reach of every open point
    r = 1 - percent / 100 + 1e-9
    rows = region.join(bounded_broadcast(stash(share, f"{name}-share")), "p").filter(F.col("open") | F.col("d").isNull() | F.col("d0").isNull() | (F.col("d0") - F.col("d") <= r))
    home = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # two open points meet in the lower of their blocks
    last = F.when(F.col("open"), home).otherwise(F.col("blocks") - 1)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    mine = F.col("open") & (home == F.col("block"))
    part = F.when(mine, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))))
    cells = stash(rows.select("p", "block", F.explode(part).alias("part"), "node", "n", mine.cast("int").alias("mine")), f"{name}-cells")
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda x: x.repartition(n_parts, "p", "block", "part").sortWithinPartitions("p", "block", "part", F.desc("mine"), "node")
    met = dealt(points.select("node", "coords").join(bounded_broadcast(cells), "node")).select("p", "block", "part", "node", "n", "mine", "coords")
    close = stash(map_arrow(met, _candidates(percent), "p long, node long").distinct(), f"{name}-close")
    sets = shingle_sets(docs, points, close.select("node"), words)
    few = stash(cells.join(bounded_broadcast(close), ["p", "node"]), f"{name}-few")
    full = dealt(sets.select("node", "s").join(bounded_broadcast(few), "node"))
    return stash(map_arrow(full.select("p", "block", "part", "node", "n", "mine", "s"), _leaves(percent), "a long, b long"), name)


def _links(docs: DataFrame, points: DataFrame, found: DataFrame, words: int, percent: int, leaf: int) -> list[DataFrame]:
    """Links that decide the components: of small regions, of pivots, and of the leaves; each stashed."""
    small = found.filter("kind = 0").select(F.col("a").alias("node"), F.col("b").alias("q"), F.col("na").alias("n"), F.col("nb").alias("nq")).distinct()
    near = stash(with_bound(stash(small, "jaccard-small"), points).filter(F.col("low") <= spread(percent)).drop("low"), "jaccard-near")
    state = found.filter("kind = 1").select("h", F.col("a").alias("node"), F.col("na").alias("n"), F.col("nb").alias("u"))
    pivots = state.groupBy("h").agg(F.min(F.struct("u", "node", "n")).alias("q"))
    pivots = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = state.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(pivots, ["h", "salt"])
    met = stash(met.select(F.col("q.node").alias("q"), F.col("q.n").alias("nq"), "node", "n", "u").distinct().filter("node <> q"), "jaccard-met")
    star = stash(with_bound(met, points, SALTS), "jaccard-star")
    around = stash(star.filter(F.col("low") <= spread(percent)).select("node", "q", "n", "nq"), "jaccard-around")
    sets = shingle_sets(docs, points, near.unionByName(around).select(F.explode(F.array("node", "q")).alias("node")), words)
    edge = [F.col("node").alias("a"), F.col("q").alias("b")]
    links = [stash(with_overlap(near, sets).filter(linked(percent)).select(edge), "jaccard-small-links")]
    exact = with_overlap(around, sets, SALTS).select("q", "node", (1 - F.col("i") / (F.col("n") + F.col("nq") - F.col("i"))).alias("exact"), linked(percent).alias("near"))
    # distances to the pivot: exact within the ball and near it, else a lower bound
    both = F.col("n") + F.col("nq")
    far = 1 - (both - F.col("low")) / (both + F.col("low"))
    region = star.join(exact, ["q", "node"], "left").select(
        F.col("q").alias("p"), "node", "n", "u", F.coalesce("exact", far).alias("d"), (~F.coalesce("near", F.lit(False))).alias("open")
    )
    region = stash(region, "jaccard-member")
    links.append(region.filter("NOT open").select(F.col("node").alias("a"), F.col("p").alias("b")))
    for turn in range(DEPTH):
        if (turned := split(docs, points, region, words, percent, leaf, turn)) is None:
            break
        more, fine, region = turned
        links += [more, leaf_links(docs, points, fine, words, percent, f"jaccard-leaves-{turn}")]
    links.append(leaf_links(docs, points, region, words, percent, "jaccard-leaves"))
    return links


def components(edges: DataFrame, names: DataFrame) -> DataFrame:
    """(node, component): the least name reachable, for nodes with edges. edges: a, b; names: node, name."""
    edges = stash(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = stash(edges.select(F.col("a").alias("node")).distinct().join(names, "node").select("node", "name", F.col("name").alias("component")), "cc-0")
    turn = 0
    while True:
        turn += 1
        heard = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("heard"))
        new = labels.join(heard, labels.node == heard.a, "left").select("node", "name", F.least("component", "heard").alias("next"), "component")
        # pointer jumping: the label's own label
        jump = new.select(F.col("name").alias("next"), F.col("next").alias("beyond")).groupBy("next").agg(F.min("beyond").alias("beyond"))
        new = new.join(jump, "next", "left").select("node", "name", F.least("next", "beyond").alias("component"), (~F.least("next", "beyond").eqNullSafe(F.col("component"))).alias("moved"))
        new = stash(new, f"cc-{turn}")
        labels = new.drop("moved")
        if new.filter("moved").isEmpty():
            return labels.select("node", "component")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, common: int = COMMON, leaf: int = LEAF
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    docs = own(docs, id_col, text_col).withColumn("sig", F.coalesce(F.xxhash64("text"), F.lit(0)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = map_arrow(docs.select("text"), _leads(words, percent), "h long").groupBy("h").count().filter(F.col("count") >= common)
    top = counts.orderBy(F.desc("count"), "h").limit(MAX_COMMON).select("h").collect()
    often = np.sort(np.array([x.h for x in top], np.int64))
    schema = f"doc_id {kind}, sig long, node long, n long, uncommon long, coords binary, rare array<long>, often array<long>"
    rows = stash(map_pandas(docs, _postings(words, percent, often), schema), "jaccard-points")
    points = stash(
        rows.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "sig")).alias("rep"), F.min("doc_id").alias("name"), F.max("coords").alias("coords"), F.count("*").alias("copies")),
        "jaccard-nodes",
    )
    copied = bounded_broadcast(points.filter("copies > 1").select("node", "rep"))
    single = rows.filter("n > 0").join(copied, "node", "left").filter("rep IS NULL OR rep = struct(doc_id, sig)")
    postings = single.select(
        "node", "n", "uncommon", F.inline(F.expr("concat(transform(rare, h -> struct(0 AS often, h)), transform(often, h -> struct(1 AS often, h)))"))
    )
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = postings.repartition(n_parts, "h", F.expr("CASE WHEN often = 1 THEN pmod(xxhash64(node), 64) ELSE 0 END"))
    found = stash(map_arrow(dealt.sortWithinPartitions("often", "h", "n", "node"), _regions(percent), REGION), "jaccard-regions")
    links = _links(docs, points, found, words, percent, leaf)
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    named = components(edges, points.select("node", "name"))
    home = points.select("node", "name").join(named, "node", "left").select("node", F.coalesce("component", "name").alias("component"))
    ids = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(home, "node", "left")
    return ids.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of each component stays, that of the least id, with all its columns; rows without an id stay."""
    found = jaccard_components(docs, id_col, text_col, **kw)
    gone = stash(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct(), "jaccard-gone")
    return docs.join(bounded_broadcast(gone), docs[id_col] == F.col("__id"), "left_anti")
