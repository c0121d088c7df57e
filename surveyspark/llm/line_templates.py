"""Line deduplication by a tree of line templates.

Lines are parsed as in a log: tokens with digits, addresses or links are variable fields; a line falls to the leaf of its
number of tokens and its first ``LEADING`` tokens, and there it joins the first template with which it shares at least
``SIMILAR`` of the tokens, whose differing tokens become variable. Lines whose template occurs in at least ``min_docs``
documents are dropped.

A leaf of any size is dealt to ``SLICES`` parts by the lines' hashes. A part is read as a stream in the order of these hashes
and keeps its templates only; then the templates of a leaf's parts join each other by the same rule, as lines do. Leaves in
fewer than ``min_docs`` documents end before that. Equal lines of a batch travel once, with the number of their documents, so
a line that very many documents share is no hot key.

Defined cases: null and empty texts have no lines; blank lines are kept and never counted; rows that repeat id and text
count as one document; of several templates that are similar enough the one that came up first takes a line; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, map_pandas, own, stash

LEADING, SIMILAR, MIN_DOCS = 3, 0.6, 5
#: Parts of a leaf.
SLICES = 64
ANY = "<*>"
FIELD = re.compile(r"\S*(?:\d|@|://)\S*")


def parsed(line: str) -> tuple[str, int, int]:
    """(masked line, its hash, its leaf)."""
    masked = FIELD.sub(ANY, line) if any(c in line for c in "0123456789@/") else line
    tokens = masked.split()
    masked = " ".join(tokens)
    leaf = f"{len(tokens)} {' '.join(tokens[:LEADING])}"
    return masked, signed(masked), signed(leaf)


def signed(s: str) -> int:
    h = xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct lines of a batch with the number of its documents."""
    for pdf in batches:
        seen: dict[str, list] = {}
        for text in pdf.text:
            for line in {x for x in (text or "").split("\n") if x and not x.isspace()}:
                if (row := seen.get(line)) is None:
                    seen[line] = [*parsed(line), 1]
                else:
                    row[3] += 1
        yield pd.DataFrame(list(seen.values()), columns=["line", "h", "leaf", "docs"])


def similar(a: list[str], b: list[str]) -> float:
    return sum(x == y for x, y in zip(a, b, strict=True)) / len(a) if len(a) == len(b) else 0.0


@functools.cache
def telling(n: int) -> range:
    """Places of which lines of ``n`` similar tokens share at least one, as so many others may not differ; empty if the
    leading tokens alone make them similar."""
    differ = max(k for k in range(n + 1) if (n - k) / n >= SIMILAR)
    return range(LEADING, LEADING + differ + 1) if LEADING + differ < n else range(0)


class Leaf:
    """Templates of one leaf in the order in which they came up, found by the tokens at telling places."""

    def __init__(self) -> None:
        self.templates: list[list[str]] = []
        self.names: list[int] = []
        self.at: dict[tuple[int, str], list[int]] = {}

    def add(self, line: str, name: int) -> int:
        """Name of the template that the line joins, or its own."""
        tokens = line.split(" ")
        places = telling(len(tokens))
        near = {k for i in places for k in self.at.get((i, tokens[i]), ())} if places else range(len(self.templates))
        for k in sorted(near):
            t = self.templates[k]
            if similar(t, tokens) >= SIMILAR:
                for i, (x, y) in enumerate(zip(t, tokens, strict=True)):
                    if x != y and x != ANY:
                        t[i] = ANY
                        if i in places:
                            self.at.setdefault((i, ANY), []).append(k)
                return self.names[k]
        for i in places:
            self.at.setdefault((i, tokens[i]), []).append(len(self.templates))
        self.templates.append(tokens)
        self.names.append(name)
        return name

    def rows(self) -> list[tuple[int, str]]:
        return [(name, " ".join(t)) for name, t in zip(self.names, self.templates, strict=True)]


LINE, TEMPLATE = 0, 1
_COLUMNS = ["kind", "leaf", "h", "template", "docs", "pattern"]
_ROWS = "kind int, leaf long, h long, template long, docs long, pattern string"


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines sorted by (leaf, slice, h), equal ones side by side, to the templates that they join, and these templates."""
    at, leaf, last, docs = None, Leaf(), None, 0

    def line() -> tuple:
        return LINE, at[0], last[0], leaf.add(last[1], last[0]), docs, None

    def templates() -> list[tuple]:
        return [(TEMPLATE, at[0], name, name, 0, text) for name, text in leaf.rows()]

    for pdf in batches:
        out: list[tuple] = []
        for key, part, h, text, n in zip(pdf.leaf, pdf.slice, pdf.h, pdf.line, pdf.docs, strict=True):
            if last is not None and (key, part, h) == (*at, last[0]):
                docs += n
                continue
            if last is not None:
                out.append(line())
                if (key, part) != at:
                    out += templates()
                    leaf = Leaf()
            at, last, docs = (key, part), (h, text), n
        yield rows_of(out)
    if last is not None:
        out = [line()]
        yield rows_of(out + templates())


def rows_of(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=_COLUMNS)


def line_templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h, template, pattern: lines (by hash of the masked line) whose template may recur; docs: text. Stashed."""
    lines = map_pandas(docs.select("text"), _lines, "line string, h long, leaf long, docs long")
    dealt = lines.withColumn("slice", F.pmod("h", F.lit(SLICES)).cast("int")).repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", "h")
    first = stash(map_pandas(dealt, _joined, _ROWS), "line-parts")
    members, parts = first.filter(F.col("kind") == LINE), first.filter(F.col("kind") == TEMPLATE)
    sized = members.groupBy("template").agg(F.first("leaf").alias("leaf"), F.sum("docs").alias("docs"))
    leaves = stash(sized.groupBy("leaf").agg(F.sum("docs").alias("n")).filter(F.col("n") >= min_docs).select("leaf"), "line-leaves")
    some = parts.select("leaf", "template", "pattern").join(bounded_broadcast(leaves), "leaf", "left_semi").join(sized.select("template", "docs"), "template")
    again = some.select("leaf", F.lit(0).alias("slice"), F.col("template").alias("h"), F.col("pattern").alias("line"), "docs")
    merged = stash(map_pandas(again.repartition("leaf").sortWithinPartitions("leaf", "h"), _joined, _ROWS), "line-merged")
    joins, whole = merged.filter(F.col("kind") == LINE), merged.filter(F.col("kind") == TEMPLATE)
    often = joins.groupBy("template").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("template")
    often = stash(often.join(whole.select("template", "pattern"), "template"), "line-patterns")
    named = joins.select(F.col("h").alias("part"), "template").join(bounded_broadcast(often), "template")
    named = bounded_broadcast(stash(named, "line-names"))
    found = members.select("h", F.col("template").alias("part")).join(named, "part").select("h", "template", "pattern")
    return stash(found, "line-templates")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, text (what is left)."""
    docs = own(docs, id_col, text_col).withColumns({"sig": F.xxhash64("text"), "sig2": F.hash("text")})
    found = line_templates(docs, min_docs)

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [
                (sig, sig2, i, parsed(x)[1])
                for sig, sig2, text in zip(pdf.sig, pdf.sig2, pdf.text, strict=True)
                for i, x in enumerate((text or "").split("\n"))
                if x and not x.isspace()
            ]
            yield pd.DataFrame(out, columns=["sig", "sig2", "at", "h"])

    at = map_pandas(docs.select("sig", "sig2", "text"), hashes, "sig long, sig2 int, at int, h long")
    hits = stash(at.join(bounded_broadcast(found.select("h", "template")), "h").select("sig", "sig2", "at", "template"), "line-hits")
    ids = docs.select("doc_id", "sig", "sig2").distinct()
    rows = ids.groupBy("sig", "sig2").agg(F.count("*").alias("n"))
    spread = hits.select("template", "sig", "sig2").distinct().join(rows, ["sig", "sig2"])
    often = spread.groupBy("template").agg(F.sum("n").alias("docs")).filter(F.col("docs") >= min_docs).select("template")
    gone = hits.join(bounded_broadcast(stash(often, "line-often")), "template")
    gone = stash(gone.groupBy("sig", "sig2").agg(F.collect_set("at").alias("gone")), "line-gone")

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, cut in zip(pdf.text, pdf.gone, strict=True):
                lines = (text or "").split("\n") if text else []
                away = set() if cut is None else {int(x) for x in cut}
                out.append((len(lines), len(away), "\n".join(x for i, x in enumerate(lines) if i not in away)))
            cols = pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), cols], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    touched = bounded_broadcast(gone)
    joined = docs.join(touched, ["sig", "sig2"], "left").select("doc_id", "text", "gone")
    return map_pandas(joined, left, f"doc_id {kind}, n_lines long, n_dropped long, text string")

