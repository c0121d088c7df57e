"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Texts over the longest are cut into pieces of that length. Pieces are dealt
evenly to tasks whatever their ids (round-robin over locally sorted rows, so a lost executor's task repeats exactly),
and each task packs its pieces by best fit, longest first: a piece goes to the open bin with the least room that still
holds it; where none does, a bin of the least-cost length is opened. The cost of opening length C for a piece is C less
the room that the pieces still to come can be expected to fill, so short tails do not open long bins. In the end each
bin is downsized to the shortest permitted length that holds its contents.

Defined cases: null and empty texts have no tokens and take no room: they are packed as pieces of length 0 with no bin
(bin_id null), so that every row is accounted for; repeated rows are packed each; an empty table gives no bins; further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_pandas, own

CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces that one task packs at a time; each batch of so many is packed on its own.
BATCH = 20_000


WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Tokens of a text: its runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


class Room:
    """Open bins by the room they have left."""

    def __init__(self, most: int) -> None:
        self.at: list[list[int]] = [[] for _ in range(most + 1)]
        self.bits = 0

    def put(self, room: int, b: int) -> None:
        self.at[room].append(b)
        self.bits |= 1 << room

    def best(self, need: int) -> tuple[int, int] | None:
        """Bin with the least room of at least ``need``, taken out."""
        above = self.bits >> need
        if not above:
            return None
        room = need + (above & -above).bit_length() - 1
        b = self.at[room].pop()
        if not self.at[room]:
            self.bits ^= 1 << room
        return b, room


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each piece, its offset there, and each bin's final length. Lengths: 1 to the largest capacity."""
    caps = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    coming = np.concatenate([np.cumsum(lengths[order][::-1])[::-1][1:], [0]]) if len(order) else np.zeros(0)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room, used, opened = Room(caps[-1]), [], []
    spare = 0  # room left in open bins, which takes what is coming first
    for i, later in zip(order, coming, strict=True):
        n = int(lengths[i])
        if (hit := room.best(n)) is None:
            fill = max(0, int(later) - spare)
            cap = min((c for c in caps if c >= n), key=lambda c: (max(0, c - n - fill), -c))
            b, left = len(used), cap
            used.append(0)
            opened.append(cap)
            spare += cap
        else:
            b, left = hit
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        spare -= n
        if left > n:
            room.put(left - n, b)
    final = np.array([min(c for c in caps if c >= u) for u in used], np.int64)
    return bins, offsets, final


def _packer(capacities: tuple[int, ...], batch: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pd.DataFrame:
            pdf = pd.concat(held, ignore_index=True)
            some = pdf.length.to_numpy() > 0
            bins, offsets, final = pack(pdf.length.to_numpy()[some], capacities)
            names = np.array([f"{part}-{k}-{b}" for b in range(len(final))], object)
            out = {c: pd.Series([None] * len(pdf), dtype=object) for c in ("bin_id", "bin_offset", "bin_length")}
            out["bin_id"][some] = names[bins] if len(final) else []
            out["bin_offset"] = pd.Series(pd.array([pd.NA] * len(pdf), "Int64"))
            out["bin_length"] = pd.Series(pd.array([pd.NA] * len(pdf), "Int64"))
            out["bin_offset"][some] = offsets
            out["bin_length"][some] = final[bins] if len(final) else []
            return pdf.assign(**out)

        for pdf in batches:
            held.append(pdf)
            rows += len(pdf)
            if rows >= batch:
                yield flush()
                held, rows, k = [], 0, k + 1
        if rows:
            yield flush()

    return run


def pack_documents(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
    batch: int = BATCH,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, bin_offset, bin_length.

    ``tokens``: the number of tokens of a row, its words by default.
    """
    most = max(capacities)
    sized = own(docs, id_col, text_col) if tokens is None else docs.select(docs[id_col].alias("doc_id"), tokens.alias("n"))
    sized = sized.select("doc_id", (word_count(F.col("text")) if tokens is None else F.col("n")).cast("long").alias("n"))
    pieces = sized.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"int((n - 1) div {most})"))))
    ).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * most).alias("start"),
        F.least(F.lit(most), F.col("n") - F.col("piece").cast("long") * most).alias("length"),
    )
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pieces.schema.add("bin_id", "string").add("bin_offset", "long").add("bin_length", "long")
    return map_pandas(pieces.repartition(n_parts), _packer(tuple(capacities), batch), schema)


def packed_sequences(docs: DataFrame, packed: DataFrame, capacities: tuple[int, ...] = CAPACITIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The training sequences of ``pack_documents`` by words: bin_id, bin_length, doc_ids (of its pieces, in order), starts (their
    places in tokens), tokens.

    An id must stand for one text; rows that repeat it are in as many bins as they were packed in. Texts without words are in none.
    A bin holds at most the largest capacity, so its group is small.
    """
    most = max(capacities)
    words = own(docs, id_col, text_col).withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).filter(F.size("w") > 0)
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"(size(w) - 1) div {most}").cast("int")), lambda k: F.slice("w", k * most + 1, F.lit(most)))
    parts = words.select(F.col("doc_id").alias("d"), F.posexplode(cut).alias("k", "words")).dropDuplicates(["d", "k"])
    placed = packed.filter("bin_id IS NOT NULL").select("doc_id", "piece", "bin_id", "bin_length", "bin_offset")
    joined = placed.join(parts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("piece") == F.col("k")))
    bins = joined.groupBy("bin_id", "bin_length").agg(F.array_sort(F.collect_list(F.struct("bin_offset", "doc_id", "words"))).alias("p"))
    return bins.select(
        "bin_id", "bin_length", F.col("p.doc_id").alias("doc_ids"), F.col("p.bin_offset").alias("starts"), F.flatten(F.col("p.words")).alias("tokens")
    )
