"""Toxicity by a support vector machine over the gap-weighted subsequence kernel, with Nystroem landmarks.

Texts are cut into chunks (the letters of each word, lower-cased; letters spelt out one by one are joined). The kernel of two chunks counts their common subsequences of
``P`` letters, each weighted by ``DECAY`` to the power of the span it takes in either chunk, so inserted letters and gaps
lower the similarity only gradually. It is normalised to 1 for equal chunks. The machine sees a mark in front of each chunk, a
letter of its own, so a stem at the beginning of a word differs from the same letters inside one.

Training takes a bounded, hashed sample of the labelled documents (``max_docs``), each whole. A label is that of the document,
and a toxic document needs one toxic chunk only, so training is multiple-instance: the first witnesses are the chunks that by
the likelihood of their counts belong to toxic documents (so documents with a wrong label bring none); the machine is fitted
on the Nystroem features of clean chunks against the witnesses, a surer witness having to reach a larger margin; in turns,
chunks that it takes for toxic and that toxic documents have far more often become witnesses too. A document's score is the
logistic of the margins of its three best distinct words and the logarithm of their number, fitted on training documents with
machines that did not see them.

Because the Nystroem map is linear in the kernel values, the decision equals a weighted sum over the chunk's own
subsequences divided by its norm; scoring uses that form, which gives the same value without a pass over the landmarks.

Defined cases: null, empty and letterless texts get the score of the emptiest text (the lowest); a sample without toxic
or without clean rows scores everything 0; repeated rows score alike; whole texts are scored; further columns are
ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, map_pandas, own, sliced, trim

P, DECAY, LANDMARKS = 3, 0.6, 192
#: Labelled documents that training takes at most, each whole, and distinct chunks that a machine is first fitted on.
MAX_DOCS, MAX_CHUNKS = 4000, 6000
#: Parts for the calibration, evidence of a first witness (log-likelihood), and how many times more often toxic documents
#: must have a further one.
FOLDS, SURE, LIFT = 3, 7.5, 4.0
BEGIN = "^"
ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßéèêçñóíáúàâîôûœ" + BEGIN
#: Codes that all other letters share.
OTHERS = 8
BASE = len(ALPHABET) + OTHERS
CODE = {c: i + OTHERS for i, c in enumerate(ALPHABET)}
LONGEST, STEP = 20, 10
#: Best chunks of a document that its score depends on, and the margin of a missing one.
TOP, LOWEST = 3, -1e9
SPELT = re.compile(r"(?:(?<=\s)|^)(?:\w[\s.\-_*]+){3,}\w(?=\s|$)")
MARK = re.compile(r"[\W_]+")
EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def chunk_of(word: str) -> str:
    """The letters of a white-space separated word; a digit in a letter's place is a gap, which the kernel tolerates."""
    if word.isalpha():
        return word
    word = EDGE.sub("", word)
    if word.isalpha():
        return word
    return "".join(c for c in word if c.isalpha())


def words_of(text: str) -> set[str]:
    """Distinct words of a text, and its runs of spelt-out letters, joined."""
    low = text.lower()
    words = set(low.split())
    if any(len(w) == 1 for w in words):
        words.update(MARK.sub("", m) for m in SPELT.findall(low))
    return words


def parts(chunk: str) -> list[str]:
    """A chunk in overlapping parts of at most ``LONGEST`` letters."""
    if len(chunk) <= LONGEST:
        return [chunk]
    return [chunk[i : i + LONGEST] for i in range(0, len(chunk) - LONGEST + STEP, STEP)]


def begun(chunks: list[str]) -> list[str]:
    """Chunks with the mark of their beginning; those too short for the kernel stay so."""
    return [BEGIN + x if len(x) >= P else x for x in chunks]


def codes(chunks: list[str]) -> np.ndarray:
    """Chunks of one length as rows of letter codes."""
    return np.array([[CODE.get(c, ord(c) % OTHERS) for c in x] for x in chunks], np.int32)


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each P-letter subsequence and its weight; chunks shorter than P have none."""
    n = rows.shape[1]
    at = np.array(list(combinations(range(n), P)), np.int64).reshape(-1, P)
    index = np.zeros((len(rows), len(at)), np.int32)
    for k in range(P):
        index = index * BASE + rows[:, at[:, k]]
    return index, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32) if len(at) else np.zeros(0, np.float32)


def norms(index: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square roots of the chunks' kernels with themselves: weights of equal subsequences add up first."""
    if not index.shape[1]:
        return np.ones(len(index), np.float32)
    order = np.argsort(index, axis=1, kind="stable")
    sorted_index = np.take_along_axis(index, order, 1)
    w = np.cumsum(weight[order], axis=1, dtype=np.float64)
    last = np.ones(index.shape, bool)
    last[:, :-1] = sorted_index[:, 1:] != sorted_index[:, :-1]
    rows, cols = np.nonzero(last)
    ends = w[rows, cols]
    sums = ends - np.concatenate([[0.0], ends[:-1]]) * (np.concatenate([[-1], rows[:-1]]) == rows)
    return np.sqrt(np.bincount(rows, sums**2, len(index))).astype(np.float32)


def compact(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised explicit features, a column for each chunk and a row for each subsequence that any of them has, after a row of
    zeros; and the row of every subsequence."""
    found = [subsequences(codes([x])) for x in chunks]
    used = np.unique(np.concatenate([index[0] for index, _ in found]))
    row_of = np.zeros(BASE**P, np.int32)
    row_of[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(chunks)), np.float32)
    for i, (index, weight) in enumerate(found):
        if index.shape[1]:
            np.add.at(table[:, i], row_of[index[0]], weight / norms(index, weight)[0])
    return table, row_of


def dense(chunks: list[str]) -> np.ndarray:
    """The same with a row for every subsequence there is."""
    table, row_of = compact(chunks)
    return table[row_of]


def project(chunks: list[str], table: np.ndarray, row_of: np.ndarray | None = None) -> np.ndarray:
    """<feature row, each column of table>; chunks: at most LONGEST letters and a mark. table: (BASE**P, m), or compact."""
    out = np.zeros((len(chunks), table.shape[1]), np.float32)
    lengths = np.array([len(x) for x in chunks])
    for n in np.unique(lengths):
        if n < P:
            continue
        where = np.nonzero(lengths == n)[0]
        step = max(1, 400_000 // (len(list(combinations(range(n), P))) * table.shape[1]))
        for i in range(0, len(where), step):
            some = where[i : i + step]
            index, weight = subsequences(codes([chunks[k] for k in some]))
            at = index if row_of is None else row_of[index]
            sums = np.einsum("bcm,c->bm", table[at], weight) if table.shape[1] > 1 else (table[:, 0][at] @ weight)[:, None]
            out[some] = sums / norms(index, weight)[:, None]
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 20.0, rounds: int = 30) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps over the active rows; y: the margins to reach, with the labels' signs; the
    last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1])
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        active = np.sign(y) * (x @ w) < np.abs(y)
        a = x[active] * (cost * weight[active])[:, None]
        new = np.linalg.solve(keep + a.T @ x[active], a.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


#: Training documents: whether toxic, and the numbers of their distinct chunks (in parts) in a list of names.
Bags = list[tuple[bool, np.ndarray]]


def train(names: list[str], bags: Bags, seed: int = 7) -> dict | None:
    """The logistic is fitted on margins from machines that didn't see the document."""
    model = machine(names, bags, seed)
    trim()
    if model is None:
        return None
    parts_of = [bags[k::FOLDS] for k in range(FOLDS)]
    others = [machine(names, [b for j, p in enumerate(parts_of) if j != k for b in p], seed) for k in range(FOLDS)]
    if any(m is None for m in others):
        parts_of, others = [bags], [model]
    best = np.vstack([top_margins(m, names, p) for p, m in zip(parts_of, others, strict=True) if p])
    trim()
    return model | calibrate(best, np.array([t for p in parts_of for t, _ in p]))


def evidence(count: np.ndarray) -> np.ndarray:
    """How surely chunks (rows: clean and toxic documents that have them) belong to toxic documents: the logarithm of the
    likelihood of their share against the share of all; 0 for those that toxic documents have no more often."""
    n, t = count.sum(1), count[:, 1]
    share = t.sum() / max(n.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(t > 0, t * np.log(t / (n * share)), 0) + np.where(n > t, (n - t) * np.log((n - t) / (n * (1 - share))), 0)
    return np.where(t > n * share, g, 0.0)


def machine(names: list[str], bags: Bags, seed: int = 7, turns: int = 3) -> dict | None:
    """Multiple-instance training of the subsequence weights."""
    toxic_n = sum(t for t, _ in bags)
    clean_n = len(bags) - toxic_n
    if not toxic_n or not clean_n:
        return None
    count = np.zeros((len(names), 2))
    for t, ids in bags:
        count[ids, int(t)] += 1
    usable = np.nonzero((count.sum(1) > 0) & (np.array([len(x) for x in names]) >= P))[0]
    if not len(usable):
        return None
    sure = evidence(count)
    witness = np.zeros(len(names), bool)
    witness[usable] = sure[usable] >= min(SURE, sure[usable].max() / 2)
    witness &= sure > 0
    rng = np.random.default_rng(seed)
    suspects = usable[np.argsort(-sure[usable], kind="stable")][: MAX_CHUNKS // 4]
    clean = usable[count[usable, 0] > 0]
    chance = np.log1p(count[clean, 0])
    others = rng.choice(clean, min(len(clean), MAX_CHUNKS * 3 // 4), replace=False, p=chance / chance.sum()) if len(clean) else clean
    pool = np.unique(np.concatenate([suspects, others]))
    first = suspects[witness[suspects]][: LANDMARKS // 2]
    rest = rng.choice(others, min(len(others), LANDMARKS - len(first)), replace=False) if len(others) else others
    marks = begun([names[i] for i in np.unique(np.concatenate([first, rest]))])
    phi, row_of = compact(marks)
    value, vector = np.linalg.eigh(phi.T @ phi + 1e-4 * np.eye(len(marks)))
    root = (vector / np.sqrt(np.maximum(value, 1e-4))).astype(np.float32)
    z = project(begun([names[i] for i in pool]), phi, row_of) @ root
    rate = (count[:, 1] / toxic_n) / ((count[:, 0] + 0.5) / clean_n)
    for turn in range(turns):
        good = witness[pool]
        bad = (count[pool, 0] > 0) & ~good
        if not good.any() or not bad.any():
            return None
        x = np.vstack([z[good], z[bad]])
        # the surer a witness, the larger the margin it has to reach
        y = np.concatenate([1 + np.clip(np.log10(np.maximum(sure[pool[good]], SURE) / SURE), 0, 1), -np.ones(bad.sum())])
        w_good, w_bad = np.log1p(count[pool[good], 1]), np.log1p(count[pool[bad], 0])
        w = fit_svm(x, y, np.concatenate([w_good / w_good.sum(), w_bad / w_bad.sum()]) * len(y))
        column = (phi @ (root @ w[:-1]).astype(np.float32))[row_of]
        score = np.full(len(names), -10.0)
        score[usable] = project(begun([names[i] for i in usable]), column[:, None])[:, 0] + w[-1]
        if turn < turns - 1:
            # what this machine rates highest joins the pool: clean chunks that it passes worst, and likely witnesses
            fresh = np.setdiff1d(usable, pool)
            hard = fresh[np.argsort(-score[fresh], kind="stable")][: MAX_CHUNKS // 4]
            pool = np.concatenate([pool, hard])
            z = np.vstack([z, project(begun([names[i] for i in hard]), phi, row_of) @ root])
            # forms of a known witness that toxic documents have far more often are witnesses too
            witness |= (score > 0) & (rate >= LIFT) & (count[:, 1] > 0)
    return {"table": column, "bias": float(w[-1])}


def top_margins(model: dict, names: list[str], bags: Bags) -> np.ndarray:
    """The TOP best chunk margins of each document, best first."""
    used = np.unique(np.concatenate([ids for _, ids in bags]))
    known = np.full(len(names), LOWEST)
    known[used] = margins(model, [names[i] for i in used])
    return np.array([tops(known[ids]) for _, ids in bags])


def tops(values) -> list[float]:
    """The best margins, best first, and the number of chunks."""
    return (heapq.nlargest(TOP, values) + [LOWEST] * TOP)[:TOP] + [len(values)]


def features(best: np.ndarray) -> np.ndarray:
    """Of the best margins: clipped, with the logarithm of the number of chunks (the best of many is high by chance) and a bias."""
    return np.hstack([np.clip(best[:, :TOP], -2.0, 2.0), -np.log1p(best[:, TOP:]), np.ones((len(best), 1))])


def calibrate(best: np.ndarray, label: np.ndarray, rounds: int = 50) -> dict:
    """Logistic regression on the best margins; moved so that the lowest threshold with the fewest errors has the score 0.7."""
    x, y = features(best), label.astype(float)
    use = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x[:, use] * (p * (1 - p))[:, None]).T @ x[:, use] + 0.5 * np.eye(use.sum())
            w[use] += np.linalg.solve(h, x[:, use].T @ (y - p) - 0.5 * w[use])
        if (w[:-1] >= 0).all():
            break
        use[np.argmin(w[:-1])] = False  # a further toxic chunk never lowers the score
    f = x @ w
    order = np.argsort(f, kind="stable")
    v, t = f[order], label[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + (~t).sum() - np.concatenate([[0], np.cumsum(~t)])
    low, high = np.concatenate([[v[0]], v]), np.concatenate([v, [v[-1]]])
    k = np.nonzero(errors == errors.min())[0][0]
    w[-1] += np.log(0.7 / 0.3) - (low[k] + high[k]) / 2
    return {"logit": w}


def margins(model: dict, chunks: list[str]) -> np.ndarray:
    flat, owner = [], []
    for i, x in enumerate(chunks):
        for p in parts(x):
            flat.append(p)
            owner.append(i)
    f = project(begun(flat), model["table"][:, None])[:, 0] + model["bias"]
    out = np.full(len(chunks), LOWEST, np.float32)
    np.maximum.at(out, np.array(owner, int), f)
    return out


def probability(model: dict, best: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features(best) @ model["logit"], -50, 50)))


class Scorer:
    """Scores texts; margins of words are kept between texts in a dictionary of bounded size."""

    def __init__(self, model: dict | None, keep: int = 120_000) -> None:
        self.model, self.keep, self.known = model, keep, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.keep:
            self.known = {}
            new = list(words)
        by_chunk: dict[str, list[str]] = {}
        for w in new:
            by_chunk.setdefault(chunk_of(w), []).append(w)
        chunks = list(by_chunk)
        for c, m in zip(chunks, margins(self.model, chunks).tolist(), strict=True):
            for w in by_chunk[c]:
                self.known[w] = m

    def best(self, texts: list[str | None]) -> np.ndarray:
        out = np.full((len(texts), TOP + 1), LOWEST)
        out[:, TOP] = 0
        held: list[tuple[int, set[str]]] = []
        size = 0
        for i, t in enumerate(texts):
            words = words_of(t) if t else set()
            held.append((i, words))
            size += len(words)
            if size > 60_000 or i == len(texts) - 1:
                self.learn(set().union(*(w for _, w in held)))
                for k, w in held:
                    if w:
                        out[k] = tops([self.known[x] for x in w])
                held, size = [], 0
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        return probability(self.model, self.best(texts))


def held_out(doc_id) -> "F.Column":
    return F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 1


def training_bags(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> tuple[list[str], Bags]:
    """A bounded sample of the labelled rows that aren't held out, by hash of the id: names and chunks of their whole texts."""
    rows = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    joined = docs.filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [{p for w in words_of(t) for p in parts(chunk_of(w))} for t in pdf.text]
            yield pd.DataFrame({"toxic": pdf.toxic == 1, "doc_id": pdf.doc_id, "chunks": [" ".join(sorted(x)) for x in found]})

    kind = joined.schema["doc_id"].dataType.simpleString()
    got = map_pandas(joined, chunks, f"toxic boolean, doc_id {kind}, chunks string").orderBy("doc_id", "chunks")
    number: dict[str, int] = {}
    bags = []
    for r in got.toLocalIterator():
        bags.append((bool(r.toxic), np.array([number.setdefault(x, len(number)) for x in r.chunks.split(" ") if x], np.int32)))
    return list(number), bags


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    docs = own(docs, id_col, text_col)
    model = train(*training_bags(docs, labels, max_docs))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "score": scorer.scores(list(pdf.text))})

    scored = map_pandas(docs, score, docs.select("doc_id").schema.add("score", "double"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """The input rows that are not predicted toxic, with all their columns."""
    model = train(*training_bags(own(docs, id_col, text_col), labels, max_docs))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in sliced(batches):
            yield batch.filter(pa.array(scorer.scores(batch.column(text_col).to_pylist()) < threshold))

    return map_arrow(docs, clean, docs.schema)
