"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least ``least`` and ``times * q`` words,
which no neighbouring word extends. Texts are independent rows, so this is one pass without a shuffle. For each text:

1. *Stretches.* Words inside a run repeat: the k-grams of a run that end after its first q + k - 1 words occurred q words
   before. So a run ends in a stretch of such positions whose length bounds its period, and positions whose k-gram last
   occurred further back than this bound belong to no run of the stretch; without them the stretch falls apart, and so on
   until nothing changes. This is arithmetic on arrays, loses no run, and spares the automaton the words of plain prose.
2. *Automaton.* The words of a stretch (and those before it that a run may begin with) are appended to a suffix automaton. Its
   states with their suffix links form a tree; the state of a prefix and its ancestors are all suffixes of that prefix.
3. *Access.* Each appended word accesses the path from its prefix's state to the root and recolours it with the word's place.
   A preferred path (kept in a splay tree) has one colour, the last occurrence of all its strings. So the path falls into
   segments; at each, the suffix of the segment's length ``hi`` last ended ``d`` words before. If ``hi >= d`` this is a
   square of period d, and the stretch of the last hi + d words has the smallest period d and can't be extended to the left
   (a longer suffix last occurred elsewhere). It is a run if the next word doesn't continue it.
4. *Collapse.* Of each run its first period stays; the words after it are dropped.

Memory is that of the longest stretch, about 0.5 KB a word. Defined cases: null, empty and blank texts have no words and no
runs; of runs of the same length the one with the least start, then period, is reported first; rows that share an id, and
rows without an id, are each judged alone; a table without rows gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, own, sliced

LEAST, TIMES = 6, 4
#: Odd multiplier of the hash of k-grams. Equal hashes of different k-grams only widen the stretches.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]
SCHEMA = "doc_id {}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept binary"


def gram_width(least: int, times: int) -> int:
    """Words k of the k-grams of which every run has a repeated one, and the least length of a suffix that gives a run."""
    q = least // times
    return max(1, min(least - q, (times - 1) * (q + 1))) if q else max(1, times - 1)


def stretches(word: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(lo, u, v): every run ends in one of the stretches [u, v) and begins at its ``lo`` or later."""
    n, k = len(word), gram_width(least, times)
    if n < least:
        return []
    gram = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        gram = gram * MULTIPLIER + word[i : n - k + 1 + i] + np.uint64(1)
    order = np.argsort(gram, kind="stable")
    again = gram[order[1:]] == gram[order[:-1]]
    at = order[1:][again]
    back = at - order[:-1][again]
    by_place = np.argsort(at)
    at, back = at[by_place] + k - 1, back[by_place]  # by the k-gram's last word
    while len(at):
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1] + 1
        begin = np.nonzero(first)[0]
        size = np.diff(begin, append=len(at))
        most = (size + k - 1) // (times - 1)
        good = back <= np.repeat(most, size)
        if good.all():
            u = at[begin]
            lo = np.maximum(0, u - most - k + 1)
            return list(zip(lo.tolist(), u.tolist(), (u + size).tolist(), strict=True))
        at, back = at[good], back[good]
    return []


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: link and length of each state (the first is the root), and the state of each prefix."""
    nexts: list[dict[int, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for w in words:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nexts[p]:
            nexts[p][w] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(nexts)
                nexts.append(nexts[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(w) == q:
                    nexts[p][w] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
        prefix.append(new)
    return link, length, prefix


def segments(words: list[int], shortest: int) -> Iterator[list[tuple[int, int]]]:
    """For each appended word the segments of its access, as (length of the longest suffix, where it last ended).

    States of fewer than ``shortest`` words are left out of the tree. State s is node s + 1, 0 is none; ``up`` is the parent
    in the splay tree or, for its root, the node above the path. Only a splay tree's root has a valid colour.
    """
    link, length, prefix = automaton(words)
    n = len(link) + 1
    up = [0] * n
    for s, above in enumerate(link):
        if above > 0 and length[above] >= shortest:
            up[s + 1] = above + 1
    left, right, colour = [0] * n, [0] * n, [-1] * n
    for place, state in enumerate(prefix):
        if length[state] < shortest:
            yield []
            continue
        out = []
        x, below = state + 1, 0
        while x:
            # splay x to the root of its path's tree
            while (p := up[x]) and (left[p] == x or right[p] == x):
                g = up[p]
                if g and (left[g] == p or right[g] == p):
                    turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
                else:
                    turns = (x,)
                for y in turns:
                    p = up[y]
                    g = up[p]
                    if left[p] == y:
                        c = left[p] = right[y]
                        right[y] = p
                    else:
                        c = right[p] = left[y]
                        left[y] = p
                    if c:
                        up[c] = p
                    up[p], up[y] = y, g
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y
                    colour[y] = colour[p]
            if colour[x] >= 0:
                out.append((length[x - 1], colour[x]))
            if c := right[x]:
                colour[c] = colour[x]  # the path below keeps its last occurrence
            right[x] = below
            colour[x] = place
            below, x = x, up[x]
        yield out


def runs_of(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs (start, length, period) by start, then period."""
    ids: dict[bytes, int] = {}
    word = np.fromiter(map(ids.setdefault, words, range(len(words))), np.uint64, len(words))
    shortest, out = gram_width(least, times), []
    for lo, u, v in stretches(word, least, times):
        part = word[lo:v].tolist()
        n, after = len(part), words[v] if v < len(words) else None
        for r, found in enumerate(segments(part, shortest)):
            if lo + r < u:
                continue  # runs that end before are those of other stretches
            for hi, last in found:
                d = r - last
                if hi + d >= least and hi >= (times - 1) * d and (part[r + 1] != part[r + 1 - d] if r + 1 < n else after != words[lo + n - d]):
                    out.append((lo + r - hi - d + 1, hi + d, d))
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def _scan(least: int, times: int, edit: Callable[[int | None, list[bytes]], list[bytes]] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 200):
            sizes, found, kept = [], [], []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").split()
                if edit is not None:
                    words = edit(key, words)
                runs = runs_of(words, least, times)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                kept.append(collapsed(words, runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "runs", "kept"]
            )

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (by start, then period), longest (the run of greatest length, null if there is
    none), text (collapsed).

    Words are split at ASCII white space. ``least`` must be 2 or more, as must ``times``. ``edit`` may change the list of words of
    a row before it is scanned.
    """
    docs = own(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(docs, _scan(least, times, edit), SCHEMA.format(kind))
    first = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    longest = F.transform(first, lambda r: F.struct(r["start"].alias("start"), (-r["n"]).alias("length"), r["period"].alias("period")))
    return rows.select("doc_id", "n_words", "runs", F.get(longest, F.lit(0)).alias("longest"), F.col("kept").cast("string").alias("text"))
