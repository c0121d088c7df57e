"""Prefix trie of conversations, rolled up by centroid decomposition of its forest of parent edges.

A node stands for a distinct sequence of first turns; its members are the conversations that begin with it. Turns are known by
the SHA-256 of role and text, a node by 128 bits, the exclusive or of hashes of its turns at their places. That is a running
aggregate which splits into blocks, so a conversation of any length is dealt to many tasks.

1. *Places* of turns: rows are sorted by range of (conversation, turn), numbered in their partitions, and the sizes of a
   conversation's earlier partitions are added.
2. *Nodes* are grouped rows (conversation, depth, node). Below the last node that it shares, a conversation is a chain of its
   own, a component whose total (one leaf, nothing saved) needs no splitting; what is left is the shared forest.
3. *Splitting.* A component of more than ``part`` nodes is split at its centroid: the deepest node with half of the
   component's weight at or below it, where a node weighs its members. The weight below a node is the number of shared
   turns that its members have from there on, so it comes from grouping, and the rounds grow with its logarithm. What hangs
   below the centroid is found by members: a node lies below another if its least member is a member of that one at a
   smaller depth. The component's total from the centroid down is added to each node on the way from the centroid to the top;
   what is left above it, and each subtree of a child of it, is a component again.
4. *Small components* are decomposed in the same way in tasks, each component whole and alone.

Every value is added to every node above it exactly once: where a centroid between the two, or one of them, is taken.

Defined cases: null role and text are empty; turns are ordered with null first, equal ones by the SHA-256 of role and text; rows
without a conversation's id are left out; a conversation whose rebuilt sequence is empty is a member of the root alone; a
table without conversations gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, stash

#: Turns of a block of the running node hash, nodes of a component that one task decomposes, and the width of a chunk of ids.
BLOCK, PART, CHUNK = 1024, 4096, 4096
KEY = ["k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def salted(salt: int, *values: Column) -> Column:
    return F.xxhash64(F.lit(salt), *values)


def numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, place (from 1), digest (of role and text), bytes (of the text) of every turn."""
    t = turns.select(
        turns[conv].cast("long").alias("conv"), turns[turn].alias("turn"), F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"), F.coalesce(turns[text].cast("string"), F.lit("")).alias("text")
    ).filter("conv IS NOT NULL")
    content = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    narrow = t.select("conv", "turn", F.sha2(content, 256).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    n_parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "digest"]
    # the partitions must stay as they are, so they are written
    rows = stash(narrow.repartitionByRange(n_parts, *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    sizes = rows.groupBy("conv", "part").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.select("conv", "part", before.alias("before"))
    k = F.row_number().over(Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("turn"), "digest"))
    return rows.withColumn("k", k).join(before, ["conv", "part"]).select("conv", (F.col("before") + F.col("k")).alias("place"), "digest", "bytes")


def rebuilt(turns: DataFrame, heads: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another one.

    turns: conv, place, digest, bytes; heads: conv, base, head (turns taken from base, ``most`` at most). Returns rows (conv,
    place, digest, bytes) and the conversations (conv, length) with their numbers of turns.
    """
    sizes = stash(turns.groupBy("conv").agg(F.count("*").alias("own")), "trie-sizes")
    convs = sizes.join(heads, "conv")
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_turns", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
    convs = stash(convs.select("conv", "base", "head", "taken", "length"), "trie-convs")
    first = turns.filter(F.col("place") <= most).withColumnRenamed("conv", "base")
    taken = first.join(convs, "base").filter("place <= taken").select("conv", "place", "digest", "bytes", "length")
    rest = turns.join(convs, "conv").filter("place > head")
    rest = rest.select("conv", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "digest", "bytes", "length")
    return taken.unionByName(rest), convs.select("conv", "length")


def prefixes(rows: DataFrame) -> DataFrame:
    """rows (conv, place, digest, bytes, ..) with the node (k1, k2) of the turns up to each one and the node above (p1, p2)."""
    block = F.floor((F.col("place") - 1) / BLOCK)
    r = rows.withColumns({"block": block, "t1": salted(1, F.col("place"), F.col("digest")), "t2": salted(2, F.col("digest"), F.col("place"))})
    sums = r.groupBy("conv", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "block", *[F.coalesce(F.bit_xor(b).over(earlier), F.lit(0)).alias(b) for b in ("b1", "b2")])
    here = Window.partitionBy("conv", "block").orderBy("place")
    r = r.withColumns({f"x{i}": F.bit_xor(f"t{i}").over(here) for i in (1, 2)}).join(sums, ["conv", "block"])
    r = r.withColumns({f"k{i}": F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)})
    r = r.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")) for i in (1, 2)})
    return r.drop("block", "digest", "t1", "t2", "x1", "x2", "b1", "b2")


# --- decomposition of small components, in tasks -------------------------------------------------------------------------


def rollup(parent: list[int], values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (a row for each node) over subtrees by centroid decomposition. parent: index of the node above, -1 at
    tops; a node comes after its parent."""
    n = len(parent)
    children: list[list[int]] = [[] for _ in range(n)]
    tops = []
    for i, p in enumerate(parent):
        (children[p] if p >= 0 else tops).append(i)
    total = np.zeros_like(values)
    gone = bytearray(n)
    size = [0] * n
    while tops:
        top = tops.pop()
        order = [top]
        for x in order:
            order.extend(c for c in children[x] if not gone[c])
        for x in reversed(order):
            size[x] = 1 + sum(size[c] for c in children[x] if not gone[c])
        centroid = top
        while (heavy := next((c for c in children[centroid] if not gone[c] and 2 * size[c] > size[top]), None)) is not None:
            centroid = heavy
        below = [centroid]
        for x in below:
            below.extend(c for c in children[x] if not gone[c])
        found = values[below].sum(axis=0)
        x = centroid
        while True:
            total[x] += found
            if x == top:
                break
            x = parent[x]
        gone[centroid] = 1
        tops.extend(c for c in children[centroid] if not gone[c])
        if centroid != top:
            tops.append(top)
    return total


def _components() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by component (c1, c2) and depth: sums of leaves and saved below each node, added to what it has."""
    names = ("c1", "c2", "k1", "k2", "p1", "p2", "leaves", "saved", "sum_leaves", "sum_saved")

    def results(rows: list[np.ndarray]) -> pa.RecordBatch:
        _, _, k1, k2, p1, p2, leaves, saved, sum_leaves, sum_saved = rows
        at = {k: i for i, k in enumerate(zip(k1.tolist(), k2.tolist(), strict=True))}
        total = rollup([at.get(p, -1) for p in zip(p1.tolist(), p2.tolist(), strict=True)], np.stack([leaves, saved], axis=1))
        return pa.RecordBatch.from_arrays(
            [pa.array(k1), pa.array(k2), pa.array(sum_leaves + total[:, 0]), pa.array(sum_saved + total[:, 1])], names=["k1", "k2", "n_leaves", "saved_tokens"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            # several components at once are a forest too; the last one waits for the next batch
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names, strict=True)]
            cut = int(np.argmax((held[0] == held[0][-1]) & (held[1] == held[1][-1])))
            if cut:
                yield results([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield results(held)

    return run


# --- splitting of large components, by joins -------------------------------------------------------------------------------


def split(nodes: DataFrame, rows: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """One round: components of ``nodes`` at their centroids. Returns the centroids, which are done, and the other nodes in
    their new components. rows: conv, place, node and node above of the shared turns."""
    tops = nodes.filter("k1 = c1 AND k2 = c2").select("c1", "c2", F.col("weight").alias("whole"), F.col("depth").alias("top_depth"))
    heavy = nodes.join(bounded_broadcast(stash(tops, f"trie-tops-{turn}")), ["c1", "c2"]).filter(2 * F.col("weight") >= F.col("whole"))
    best = F.max_by(F.struct("k1", "k2", "conv", F.col("weight").alias("cut"), F.col("depth").alias("at"), "top_depth"), "depth")
    centroids = heavy.groupBy("c1", "c2").agg(best.alias("x")).select("c1", "c2", "x.conv", "x.cut", "x.at", "x.top_depth", F.col("x.k1").alias("x1"), F.col("x.k2").alias("x2"))
    centroids = stash(centroids, f"trie-centroids-{turn}")
    few = bounded_broadcast(centroids)
    hung = few.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), "c1", "c2")
    # the members of a centroid that go on, and their next nodes
    below = rows.join(hung, ["p1", "p2"]).select("c1", "c2", "conv", F.col("k1").alias("n1"), F.col("k2").alias("n2"))
    way = few.select("c1", "c2", "conv", "at", "top_depth")
    way = rows.join(way, "conv").filter("place BETWEEN top_depth AND at").select("c1", "c2", "k1", "k2", F.lit(True).alias("way"))
    root = centroids.filter("top_depth = 0").select("c1", "c2", F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.lit(True).alias("way"))
    told = nodes.join(few.select("c1", "c2", "x1", "x2", "at", "cut"), ["c1", "c2"]).join(below, ["c1", "c2", "conv"], "left").join(way.unionByName(root), ["c1", "c2", *KEY], "left")
    told = told.withColumns({"is_x": (F.col("k1") == F.col("x1")) & (F.col("k2") == F.col("x2")), "under": F.coalesce(F.col("n1").isNotNull() & (F.col("depth") > F.col("at")), F.lit(False))})
    told = stash(told, f"trie-told-{turn}")
    found = told.filter("is_x OR under").groupBy("c1", "c2").agg(F.sum("leaves").alias("f_leaves"), F.sum("saved").alias("f_saved"))
    told = told.join(bounded_broadcast(stash(found, f"trie-found-{turn}")), ["c1", "c2"])
    on_way = F.coalesce("way", F.lit(False))
    told = told.withColumns({
        "sum_leaves": F.col("sum_leaves") + F.when(on_way, F.col("f_leaves")).otherwise(0),
        "sum_saved": F.col("sum_saved") + F.when(on_way, F.col("f_saved")).otherwise(0),
        "weight": F.col("weight") - F.when(on_way & ~F.col("is_x"), F.col("cut")).otherwise(0),
        "c1": F.when(F.col("under"), F.col("n1")).otherwise(F.col("c1")), "c2": F.when(F.col("under"), F.col("n2")).otherwise(F.col("c2")),
    })
    told = stash(told.select("is_x", *nodes.columns), f"trie-nodes-{turn}")
    done = told.filter("is_x").select(*KEY, F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"))
    return done, told.filter("NOT is_x").drop("is_x")


def subtree_sums(shared: DataFrame, rows: DataFrame, part: int) -> DataFrame:
    """k1, k2, n_leaves, saved_tokens of the shared nodes (k1, k2, p1, p2, conv, depth, weight, leaves, saved)."""
    zero = F.lit(0).cast("long")
    nodes = shared.withColumns({"c1": zero, "c2": zero, "sum_leaves": zero, "sum_saved": zero})
    n_parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    finished, whole, turn = [], [], 0
    while True:
        large = stash(nodes.groupBy("c1", "c2").count().filter(F.col("count") > part).select("c1", "c2"), f"trie-large-{turn}")
        if large.isEmpty():
            whole.append(nodes)
            break
        listed = bounded_broadcast(large)
        whole.append(nodes.join(listed, ["c1", "c2"], "left_anti"))
        done, nodes = split(nodes.join(listed, ["c1", "c2"], "left_semi"), rows, turn)
        finished.append(done)
        turn += 1
    small = whole[0]
    for more in whole[1:]:
        small = small.unionByName(more)
    sent = small.select("c1", "c2", *KEY, "p1", "p2", "leaves", "saved", "sum_leaves", "sum_saved", "depth")
    sent = sent.repartition(n_parts, "c1", "c2").sortWithinPartitions("c1", "c2", "depth").drop("depth")
    out = map_arrow(sent, _components(), "k1 long, k2 long, n_leaves long, saved_tokens long")
    for more in finished:
        out = out.unionByName(more)
    return out


# --- the members that end at a node ----------------------------------------------------------------------------------------


def _digests() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks (k1, k2, ids) sorted by node and chunk to k1, k2, ends_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield rows(out)
        if node is not None:
            yield rows([(*node, state.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[*KEY, "ends_sha256"])

    return run


def ending(ends: DataFrame) -> DataFrame:
    """ends (k1, k2, conv; long ids) -> k1, k2, ends_sha256 of the ids in ascending order, comma-joined.

    Ids are joined in chunks of a range of ``CHUNK`` ids, so a node with many of them sends few rows to the task that hashes them
    in order, and these are read as a stream.
    """
    n_parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    chunks = ends.groupBy(*KEY, F.expr(f"conv div {CHUNK}").alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    dealt = chunks.repartition(n_parts, *KEY).sortWithinPartitions(*KEY, "chunk")
    return map_arrow(dealt.select(*KEY, "ids"), _digests(), "k1 long, k2 long, ends_sha256 string")


def conversation_trie(turns: DataFrame, heads: Callable[[Column], tuple[Column, Column]] | None = None, most: int = 8, part: int = PART,
                      conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``heads`` gives for a conversation's id (base, head): its first ``head`` turns (``most`` at most) are replaced by the first
    ``head`` turns of conversation ``base``. Ids are integers.
    """
    places = stash(numbered(turns, conv_col, turn_col, role_col, text_col), "trie-places")
    ids = places.select("conv").distinct()
    base, head = heads(F.col("conv")) if heads else (F.col("conv"), F.lit(0))
    rows, convs = rebuilt(places, ids.select("conv", base.alias("base"), head.cast("long").alias("head")), most)
    rows = stash(prefixes(rows), "trie-rows")
    zero = F.lit(0).cast("long")
    grouped = rows.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.max("place").alias("depth"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), "conv", zero.alias("depth"), "n_convs", zero.alias("bytes"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = stash(grouped.unionByName(root), "trie-nodes")
    own = nodes.filter("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("chains")
    )
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    first = nodes.filter("depth = 0").select(F.col("conv").alias("root_conv"))  # one row
    deeper = nodes.filter("depth > 1").join(above, ["p1", "p2"]).select(*nodes.columns, "parent_conv_id")
    upper = nodes.filter("depth <= 1").join(F.broadcast(first)).select(*nodes.columns, F.when(F.col("depth") == 1, F.col("root_conv")).alias("parent_conv_id"))
    full = stash(deeper.unionByName(upper).join(own, KEY, "left").fillna(0, ["n_children", "chains"]), "trie-full")

    # the shared forest: the root, and what two or more conversations begin with
    is_shared = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    common = stash(rows.join(nodes.filter("n_convs > 1").select(*KEY), KEY, "left_semi").select("conv", "place", *KEY, "p1", "p2"), "trie-shared")
    last = common.groupBy("conv").agg(F.max("place").alias("last"))
    weight = common.join(last, "conv").groupBy(*KEY).agg(F.sum(F.col("last") - F.col("place") + 1).alias("weight"))
    leaves = F.col("chains") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    shared = full.filter(is_shared).join(weight, KEY, "left").select(
        *KEY, F.when(F.col("depth") > 0, F.col("p1")).alias("p1"), F.when(F.col("depth") > 0, F.col("p2")).alias("p2"), "conv", "depth",
        F.col("weight").alias("weight"), leaves.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    # the root has no turn: all of the forest's weight, and 1 for itself
    all_of_it = common.agg((F.count("*") + 1).alias("all"))
    shared = stash(shared.join(F.broadcast(all_of_it)).withColumns({"weight": F.coalesce("weight", "all"), "p1": F.coalesce("p1", F.lit(-1)), "p2": F.coalesce("p2", F.lit(-1))}).drop("all"), "trie-forest")
    sums = stash(subtree_sums(shared, common, part), "trie-sums")

    at_end = rows.filter("place = length").select(*KEY, "conv").unionByName(convs.filter("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv"))
    return full.join(sums, KEY, "left").join(ending(at_end), KEY, "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        F.when(is_shared, F.col("n_leaves")).otherwise(1).alias("n_leaves"), F.when(is_shared, F.col("saved_tokens")).otherwise(0).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
