"""Removal of repeated 200-byte strings by induced sorting of suffixes, as external Spark sorts.

Sorting every suffix would carry billions of tuples, so sorting is induced from sampled suffixes, level by level; a level
passes on only the suffixes whose order among equals is still open. Each level is one external sort of tuples (Spark's
sort keeps its queue on disk, so a shard may be far larger than memory), and each tuple carries a common-prefix value.

1. *Sampled suffixes.* Anchors are the positions whose ``GRAM`` bytes hash below a threshold, one in ``ONE_IN``; whether a
   position is one depends on those bytes only. A window of ``length`` bytes belongs to its first anchor ``n`` and thus
   holds a fixed prefix of the suffix at ``n`` (its core). Windows are handled in runs: all that share an anchor and a
   core length. A run's tuple has the core's fingerprint (common prefix: the core) and that of all bytes that the run's
   windows cover (common prefix: the run). Windows without an anchor near enough are runs of their own.
2. *Induction.* Sorted by (core, run): runs with an equal run repeat as a whole; a core that occurs once rules its run
   out; a core with several different runs leaves them open.
3. *Windows.* Of each different open run, the windows themselves are sorted (common prefix: the whole window), which
   decides them.

Equal tuples of one batch are merged before the shuffle, so a passage that many documents share travels once a batch.
Fingerprints have 64 bits. Texts longer than ``SEGMENT`` are handled in overlapping segments, so memory doesn't grow
with a text.

Defined cases: a null text is empty; texts shorter than a window lose nothing; copies of a text lose each other's
bytes, repeated rows included; a string that overlaps itself counts; a table without rows gives no rows; further columns
of the input are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_arrow, map_pandas, own, sliced, stash

LENGTH = 200
GRAM, ONE_IN = 16, 32
SEGMENT = 1 << 20
MULT = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULT, -1, 1 << 64)
M1, M2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)

TUPLES = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("f", "e", "sig", "lo")], ("run", pa.int32()), ("sure", pa.bool_())])
SPANS = pa.schema([("kind", pa.int32()), ("sig", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
COVER, OPEN, PROOF = 1, 2, 3


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * M1
    h = (h ^ (h >> np.uint64(29))) * M2
    return h ^ (h >> np.uint64(32))


class Prints:
    """Position-independent fingerprints of any stretch of a buffer, after one pass over it."""

    def __init__(self) -> None:
        self.letters = np.random.default_rng(20240501).integers(0, 2**64, 256, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        done = 1
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
            done += m
        return out

    def load(self, data: np.ndarray) -> None:
        if len(self.up) < len(data) + 1:
            self.up, self.down = self.powers(MULT, len(data) + 1), self.powers(INVERSE, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.down[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.up[start])


def cores(length: int) -> list[tuple[int, int]]:
    """(first, last) distance of a window's start to its anchor, for each core length ``length - last``."""
    far = min(length * 3 // 4, length - GRAM)  # an anchor's bytes lie in the window
    return [(0, far // 2 - 1), (far // 2, far)]


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges lo..hi, and the range of each."""
    n = np.maximum(hi - lo + 1, 0)
    of = np.repeat(np.arange(len(lo)), n)
    return lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n), of


def runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, prints: Prints, length: int, one_in: int) -> tuple:
    """Runs of windows of the texts data[start:end]: f, e, text, lo, hi (positions in data)."""
    prints.load(data)
    at = np.arange(max(0, len(data) - GRAM + 1))
    h = (prints.sums[GRAM:] - prints.sums[: len(at)]) * prints.up[: len(at)]
    anchors = at[mix(h) < np.uint64((1 << 64) // one_in - 1)]
    text = np.searchsorted(start, anchors, "right") - 1
    inside = (anchors >= start[text]) & (anchors + GRAM <= end[text])
    anchors, text = anchors[inside], text[inside]
    before = np.where(np.concatenate([[-1], text[:-1]]) == text, np.concatenate([[-1], anchors[:-1]]), start[text] - 1) if len(text) else anchors
    last = end[text] - length
    out = []
    far = cores(length)[-1][1]
    for tag, (near, most) in enumerate(cores(length), 1):
        lo = np.maximum(before + 1, anchors - most)
        hi = np.minimum(anchors - near, last)
        ok = lo <= hi
        n, lo, hi, t = anchors[ok], lo[ok], hi[ok], text[ok]
        f = mix(prints.of(n, n + length - most) + np.uint64(tag))
        e = mix(prints.of(lo, hi + length) + mix(((n - lo) * 512 + (hi - lo)).astype(np.uint64)) + np.uint64(tag))
        out.append((f, e, t, lo, hi))
    # windows too far from an anchor, and those behind a text's last one
    final = np.maximum.reduceat(np.append(anchors, -1), np.append(np.searchsorted(text, np.arange(len(start))), len(anchors))[:-1]) if len(start) else start
    has = np.bincount(text, minlength=len(start)) > 0
    tail_lo = np.where(has, final + 1, start)
    lo = np.concatenate([before + 1, tail_lo])
    hi = np.concatenate([np.minimum(anchors - far - 1, last), end - length])
    t = np.concatenate([text, np.arange(len(start))])
    lo, of = expand(lo, hi)
    f = mix(prints.of(lo, lo + length))
    out.append((f, f, t[of], lo, lo))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def batched(sigs: list[int], texts: list[bytes], length: int, limit: int = SEGMENT) -> Iterator[tuple]:
    """(data, start, end, sig, base) of up to about ``limit`` bytes; base: the place of start in its text."""
    data, start, end, sig, base, size = [], [], [], [], [], 0
    for s, t in zip(sigs, texts, strict=True):
        for at in range(0, max(1, len(t) - length + 1), limit):
            piece = t[at : at + limit + length - 1]
            if len(piece) < length:
                continue
            data.append(piece)
            start.append(size)
            size += len(piece)
            end.append(size)
            sig.append(s)
            base.append(at)
            if size >= limit:
                yield np.frombuffer(b"".join(data), np.uint8), *(np.array(x, np.int64) for x in (start, end, sig, base))
                data, start, end, sig, base, size = [], [], [], [], [], 0
    if size:
        yield np.frombuffer(b"".join(data), np.uint8), *(np.array(x, np.int64) for x in (start, end, sig, base))


def merged(sig: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of window starts whose bytes touch become one range (the bytes covered stay the same)."""
    if not len(sig):
        return sig, lo, hi
    o = np.lexsort((lo, sig))
    sig, lo, hi = sig[o], lo[o], hi[o]
    base = np.cumsum(np.concatenate([[0], (sig[1:] != sig[:-1]).astype(np.int64)])) * (1 << 40)
    reach = np.maximum.accumulate(base + hi)
    new = np.concatenate([[True], base[1:] + lo[1:] > reach[:-1] + length])
    first = np.nonzero(new)[0]
    return sig[first], lo[first], (reach - base)[np.append(first[1:], len(sig)) - 1]


def spans_batch(kind: int, sig, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (sig, lo, hi))], schema=SPANS)


def tuples_batch(kind: int, f, e, sig, lo, run, sure) -> pa.RecordBatch:
    cols = [np.full(len(f), kind, np.int32), f, e, sig, lo, np.asarray(run, np.int32), sure]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], schema=TUPLES)


def thinned(f, e, sig, lo, hi, length: int) -> Iterator[pa.RecordBatch]:
    """One tuple for each different run of a batch; what repeats within the batch is covered at once."""
    _, first, back, count = np.unique(e, return_index=True, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    if twice.any():
        s, a, b = merged(sig[twice], lo[twice], hi[twice], length)
        zero = np.zeros(len(s), np.int64)
        yield tuples_batch(COVER, mix(s.view(np.uint64)).view(np.int64), zero, s, a, b - a, np.ones(len(s), bool))
    yield tuples_batch(0, f[first].view(np.int64), e[first].view(np.int64), sig[first], lo[first], (hi - lo)[first], count > 1)


def _sampled(length: int, one_in: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Prints()
        for batch in sliced(batches):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            for data, start, end, sig, base in batched(batch.column("sig").to_pylist(), texts, length):
                f, e, t, lo, hi = runs(data, start, end, prints, length, one_in)
                shift = base[t] - start[t]
                yield from thinned(f, e, sig[t], lo + shift, hi + shift, length)

    return run


def _windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Open runs of texts to one tuple for each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Prints()
        for batch in sliced(batches):
            held, size = [], 0
            for row in zip(batch.column("sig").to_pylist(), batch.column("text").to_pylist(), batch.column("open").to_pylist(), strict=True):
                for piece in pieces(*row):
                    held.append(piece)
                    size += len(piece[1])
                    if size >= SEGMENT:
                        yield from write(held, prints)
                        held, size = [], 0
            if held:
                yield from write(held, prints)

    def pieces(sig: int, text: str, spans: list[dict]) -> Iterator[tuple]:
        """The stretches of a text that its open runs need."""
        raw = text.encode("utf-8", "surrogatepass")
        a = np.array([(x["lo"], x["hi"], x["kind"] == PROOF) for x in spans], np.int64)
        a = a[np.argsort(a[:, 0], kind="stable")]
        for k in range(0, len(a), 256):
            part = a[k : k + 256]
            # neighbouring runs lie close together; distant ones are cut out one by one
            cuts = np.nonzero(np.diff(part[:, 0]) > 4096)[0] + 1
            for some in np.split(part, cuts):
                low, high = int(some[0, 0]), int(some[:, 1].max()) + length
                yield sig, raw[low:high], low, some

    def write(held: list[tuple], prints: Prints) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(x[1] for x in held), np.uint8)
        at = np.cumsum([0, *(len(x[1]) for x in held)])[:-1]
        prints.load(data)
        lo = np.concatenate([x[3][:, 0] - x[2] + s for x, s in zip(held, at, strict=True)])
        hi = np.concatenate([x[3][:, 1] - x[2] + s for x, s in zip(held, at, strict=True)])
        n = [len(x[3]) for x in held]
        sig, shift = np.repeat([x[0] for x in held], n), np.repeat([x[2] - s for x, s in zip(held, at, strict=True)], n)
        proof = np.concatenate([x[3][:, 2] for x in held]).astype(bool)
        where, of = expand(lo, hi)
        f = prints.of(where, where + length)
        # what is proof only is known to be covered, so it needs no answer
        where = where + shift[of]
        _, first, back, count = np.unique(f, return_index=True, return_inverse=True, return_counts=True)
        twice = (count[back] > 1) & ~proof[of]
        if twice.any():
            s, a, b = merged(sig[of][twice], where[twice], where[twice], length)
            zero = np.zeros(len(s), np.int64)
            yield tuples_batch(COVER, mix(s.view(np.uint64)).view(np.int64), zero, s, a, b - a, np.ones(len(s), bool))
        k = f[first].view(np.int64)
        yield tuples_batch(0, k, k, sig[of][first], where[first], np.zeros(len(first)), (count > 1) | proof[of][first])

    return run


def _induced(length: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tuples sorted by (f, e) to covered and open runs. last: tuples are windows; a proof counts as an occurrence.

    From batch to batch only the first tuple of the run in progress is carried, with whether the run repeats and whether its
    core has other runs, so a core of any size is read in the memory of one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mixed = None, False
        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in TUPLES.names]
                passed = cols[0] == COVER
                if passed.any():
                    yield spans_batch(COVER, cols[3][passed], cols[4][passed], cols[4][passed] + cols[5][passed])
                cols = [c[~passed] for c in cols]
                if not len(cols[0]):
                    continue
                if held is not None:
                    cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
                out, held, mixed = decide(cols, mixed, False)
                yield from out
        if held is not None:
            yield from decide(held, mixed, True)[0]

    def decide(cols: list[np.ndarray], mixed: bool, end: bool) -> tuple[list[pa.RecordBatch], list[np.ndarray], bool]:
        """What is settled, the first tuple of the last run (sure: it repeats), and whether that run's core has other runs.

        mixed: the core of the first tuple has had other runs; end: the last run is whole."""
        _, f, e, sig, lo, more, sure = cols
        hi = lo + more
        new_f = np.concatenate([[True], f[1:] != f[:-1]])
        new_e = new_f | np.concatenate([[True], e[1:] != e[:-1]])
        of = np.cumsum(new_e) - 1
        core = (np.cumsum(new_f) - 1)[new_e]
        repeats = (np.bincount(of) > 1) | (np.bincount(of, sure) > 0)
        several = np.bincount(core) > 1
        several[0] |= mixed
        first, out = np.nonzero(new_e)[0], []
        cover = repeats[of] & ~sure
        if cover.any():
            out.append(spans_batch(COVER, *merged(sig[cover], lo[cover], hi[cover], length)))
        if not last:
            settled = several[core]
            settled[-1] &= end
            for kind, some in ((OPEN, first[settled & ~repeats]), (PROOF, first[settled & repeats])):
                if len(some):
                    out.append(spans_batch(kind, sig[some], lo[some], hi[some]))
        return out, [*(c[first[-1:]] for c in cols[:-1]), repeats[-1:]], bool(several[-1])

    return run


def _cut(length: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [removed(t, s, length) for t, s in zip(pdf.text, pdf.spans, strict=True)]
            cols = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), cols], axis=1)

    return run


def removed(text: str, spans, length: int) -> tuple:
    """Bytes, removed bytes, maximal removed runs, SHA-256 of the rest, and the runs as (start, end)."""
    raw = text.encode("utf-8", "surrogatepass")
    cut: list[list[int]] = []
    for lo, hi in sorted((int(x["lo"]), int(x["hi"]) + length) for x in spans):
        if cut and lo <= cut[-1][1]:
            cut[-1][1] = max(cut[-1][1], hi)
        else:
            cut.append([lo, hi])
    sha, at = hashlib.sha256(), 0
    for lo, hi in cut:
        sha.update(raw[at:lo])
        at = hi
    sha.update(raw[at:])
    return len(raw), sum(b - a for a, b in cut), len(cut), sha.hexdigest(), [(a, b) for a, b in cut]


def _free(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of plans that nobody holds any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame, length: int = LENGTH, one_in: int = ONE_IN) -> DataFrame:
    """sig, lo, hi: ranges of window starts to remove; docs: sig, text. Stashed."""
    order = ["f", "e"]
    tuples = docs.filter(F.octet_length("text") >= length).transform(map_arrow, _sampled(length, one_in), "kind int, f long, e long, sig long, lo long, run int, sure boolean")
    spans_type = "kind int, sig long, lo long, hi long"
    level = stash(tuples.repartition("f").sortWithinPartitions(*order).transform(map_arrow, _induced(length, False), spans_type), "suffix-runs")
    del tuples
    _free(docs)
    undecided = level.filter(F.col("kind") != COVER)
    by_text = undecided.groupBy("sig").agg(F.collect_list(F.struct("lo", "hi", "kind")).alias("open"))
    wanted = bounded_broadcast(stash(undecided.select("sig").distinct(), "suffix-wanted"))
    texts = docs.join(wanted, "sig", "left_semi").dropDuplicates(["sig"]).join(by_text, "sig").select("sig", "text", "open")
    windows = texts.transform(map_arrow, _windows(length), "kind int, f long, e long, sig long, lo long, run int, sure boolean")
    fine = stash(windows.repartition("f").sortWithinPartitions(*order).transform(map_arrow, _induced(length, True), spans_type), "suffix-windows")
    del windows, texts, by_text
    _free(docs)
    return level.filter(F.col("kind") == COVER).unionByName(fine).select("sig", "lo", "hi")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, one_in: int = ONE_IN) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte ranges)."""
    docs = own(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sig", F.xxhash64("text"))
    spans = repeated_spans(docs.select("sig", "text"), length, one_in)
    by_text = stash(spans.groupBy("sig").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "suffix-spans")
    touched = bounded_broadcast(by_text.select("sig"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.join(touched, "sig", "left_semi").join(by_text, "sig").select("doc_id", "text", "spans")
    cut = map_pandas(cut, _cut(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>")
    whole = docs.join(touched, "sig", "left_anti").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)").alias("removed"),
    )
    return cut.unionByName(whole)
