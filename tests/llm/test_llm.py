"""Training-data operators against brute force on small fixtures with nulls, empty, long and repeated texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import decontaminate, exact_dedup, html_text, jaccard_join, license_scan, line_templates, packing, queries, substrings, token_rollup, toxicity
from surveyspark.llm.common import table

DATA = "/root/testdata/sf0.001"
# further columns whose names clash with the operators' own
SCHEMA = "doc_id long, text string, sig long, node long, n long, score double, fp string"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, 1, 2, 3, 0.5, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def fixture_texts(seed: int, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 80))) for _ in range(5)]
    out: list[str | None] = [None, "", " \t\n", "one", "one two three", "ONE two\nthree", "A b c d e f", "long " * 4000]
    for _ in range(n):
        kind = rng.random()
        text = rng.choice(base).split(" ")
        if kind < 0.6:  # near copies with a few edits
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.8:
            text = text[: rng.randint(5, len(text))] + [rng.choice(words) for _ in range(rng.randint(0, 30))]
        else:
            text = [rng.choice(words) for _ in range(rng.randint(1, 50))]
        out.append(" ".join(text))
    return [*out, out[10], out[11], out[11]]


def components(n: int, links) -> list[int]:
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize(("seed", "small", "block", "common"), [(1, 8, 1024, 16), (2, 2, 3, 2), (3, 3, 2, 10_000)])
def test_jaccard_components(spark, monkeypatch, seed, small, block, common):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SLICE", 7)
    texts = fixture_texts(seed, 90)
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, components(len(sets), links), strict=True))]
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(frame(spark, texts), common=common).collect())
    assert got == want
    assert len(links) > 20
    kept = {r.doc_id for r in jaccard_join.drop_near_copies(frame(spark, texts)).collect()}
    assert kept == {i for i, _, c in want if i == c}


def family(rng: random.Random, n: int, edits: tuple[int, int], words: int = 200) -> list[str]:
    """Near copies of one text, each with its own edits."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for k in rng.sample(range(words), rng.randint(*edits)):
            t[k] = f"e{rng.randrange(10**9)}"
        out.append(" ".join(t))
    return out


def brute_components(texts: list[str]) -> list[int]:
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    return components(len(sets), [(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])


def test_jaccard_recursion(spark, monkeypatch):
    """Large regions are cut again and again, in blocks: families around a common passage, with and without a middle."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4000)
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} {t}" for _ in range(4) for t in family(rng, 18, (0, 6), 140)] + family(rng, 60, (0, 5)) + family(rng, 60, (3, 7))
    turns, split = [], jaccard_join.split
    monkeypatch.setattr(jaccard_join, "split", lambda *a: (out := split(*a)) and (turns.append(1) or out))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame(spark, texts), leaf=10, common=10_000).collect()}
    want = brute_components(texts)
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) > 5 and len(turns) > 1


def test_jaccard_links_of_a_family(spark, monkeypatch):
    """The links of a family grow with its size, not with its square."""
    counts, link = {}, jaccard_join._links

    def counted(*a):
        out = link(*a)
        counts[len(counts)] = sum(x.count() for x in out)
        return out

    monkeypatch.setattr(jaccard_join, "_links", counted)
    for n in (200, 400):
        texts = family(random.Random(7), n, (1, 5))
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame(spark, texts)).collect()}
        assert [got[i] for i in range(n)] == brute_components(texts)
    assert counts[1] < 3 * counts[0] and counts[1] < 4 * 400


def test_jaccard_null_ids(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(None, text), (7, text), (9, text), (None, "a b c d e f g"), (3, "z")], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 4, 7), (7, 4, 7), (9, 4, 7), (None, 3, None), (3, 1, 3)], key=str)
    assert jaccard_join.drop_near_copies(docs).count() == 4


def test_empty_tables(spark):
    none = frame(spark, ["x"]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.jaccard_components(none).count() == 0
    assert substrings.drop_repeats(none).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert line_templates.drop_lines(none).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    some = frame(spark, ["idiot", None])
    assert [r.score for r in toxicity.toxicity(some, labels).collect()] == [0.0, 0.0]
    assert [r.n_hit for r in decontaminate.contamination(some, bench).collect()] == [0, 0]


@pytest.mark.parametrize("last", [False, True])
def test_induction_by_batches(last):
    """Batches of any size decide as a single one does, and runs are covered as a plain reading of the sorted tuples says."""
    rng = np.random.default_rng(7)
    for n in (1, 2, 40, 300):
        f = np.sort(rng.integers(0, 6, n))
        e = f * 100 + rng.integers(0, 8, n)
        o = np.lexsort((e, f))
        f, e = f[o], e[o]
        sig, lo, sure = rng.permutation(n), np.zeros(n, np.int64), rng.random(n) < 0.1
        whole = substrings.tuples_batch(0, f, e, sig, lo, np.zeros(n), sure)
        read = lambda step: sorted(
            (r["kind"], r["sig"]) for b in substrings._induced(200, last)(iter([whole.slice(i, step) for i in range(0, n, step)])) for r in b.to_pylist()
        )
        runs = defaultdict(list)
        for row in zip(f.tolist(), e.tolist(), sig.tolist(), sure.tolist(), strict=True):
            runs[row[:2]].append(row[2:])
        cores = Counter(k[0] for k in runs)
        want = []
        for (core, _), members in runs.items():
            again = len(members) > 1 or members[0][1]
            want += [(substrings.COVER, s) for s, known in members if again and not known]
            if not last and cores[core] > 1:
                want.append((substrings.PROOF if again else substrings.OPEN, members[0][0]))
        assert read(n) == read(1) == read(3) == sorted(want)


@pytest.mark.parametrize(("length", "one_in"), [(40, 8), (64, 32)])
def test_repeated_strings(spark, length, one_in):
    rng = random.Random(length)
    pieces = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 120))) for _ in range(10)]
    texts: list[str | None] = [None, "", "a" * 300, "ab" * 90, "x" * (length - 1)]
    texts += ["".join(rng.choice(pieces) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 12))) for _ in range(50)]
    texts += [texts[10], texts[10]]
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    want = []
    for b in raw:
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                cut[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~cut].tobytes()
        want.append((len(b), int(cut.sum()), int((cut & ~np.concatenate([[False], cut[:-1]])).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    got = substrings.drop_repeats(frame(spark, texts), length=length, one_in=one_in).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want
    assert sum(w[1] for w in want) > 1000


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    rng = random.Random(3)
    one = "".join(rng.choice("abcdefghij") for _ in range(3000))
    texts = [one, one[500:1700] + "".join(rng.choice("klmn") for _ in range(900))]
    got = {r.doc_id: r.removed for r in substrings.drop_repeats(frame(spark, texts)).collect()}
    assert [tuple(x) for x in got[0]] == [(500, 1700)] and [tuple(x) for x in got[1]] == [(0, 1200)]


def test_fingerprints_compose():
    tables = exact_dedup.power_tables()
    rng = random.Random(0)
    data = bytes(rng.randrange(256) for _ in range(3 * exact_dedup.CHUNK + 17))
    for cut in (0, 1, 100, exact_dedup.CHUNK):
        left, right = exact_dedup.chunk_hash(data[:cut], tables), exact_dedup.chunk_hash(data[cut : exact_dedup.CHUNK], tables)
        assert exact_dedup.combine(left, right, exact_dedup.CHUNK - cut) == exact_dedup.chunk_hash(data[: exact_dedup.CHUNK], tables)
    naive = 0
    for b in data:
        naive = (naive * exact_dedup.BASES[0] + b + 1) % exact_dedup.PRIMES[0]
    assert exact_dedup.fingerprint(data, tables) >> 31 == naive
    assert exact_dedup.fingerprint(b"\0", tables) != exact_dedup.fingerprint(b"\0\0", tables)


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(spark, monkeypatch, collide):
    texts = fixture_texts(4)
    ids = [*range(len(texts) - 1), 11]  # the last two rows repeat id and text or text only
    ids[-1] = ids[-2]
    if collide:  # all fingerprints equal: lengths and the comparison must tell texts apart
        monkeypatch.setattr(exact_dedup, "fingerprint", lambda data, tables: 7)
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[t or ""].append(i)
    got = exact_dedup.exact_groups(frame(spark, texts, ids), huge_bytes=1 << 30 if collide else 2000).collect()
    assert len(got) == len(texts)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        g = groups[by_sha[r.text_sha256]]
        assert (r.keep_id, r.group_size) == (max(g), len(g))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == set(by_sha) and set(kept.values()) == {1}
    left = exact_dedup.drop_copies(frame(spark, texts, ids))
    assert sorted((r.text or "", r.doc_id) for r in left.collect()) == sorted((t, max(g)) for t, g in groups.items())
    assert left.columns == frame(spark, ["x"]).columns


def test_null_ids(spark):
    big = (1 << 60) + 1
    df = frame(spark, ["a", "a", "b"], [None, None, big])
    assert sorted((r.text_sha256 is not None, r.kept) for r in exact_dedup.exact_groups(df).collect()) == [(True, False), (True, True), (True, True)]
    assert {r.doc_id for r in jaccard_join.jaccard_components(df).collect()} == {None, big}
    assert {r.doc_id for r in license_scan.scan_licenses(df).collect()} == {None, big}


def test_decontamination(spark):
    rng = random.Random(9)
    words = [f"b{i}" for i in range(400)]
    items = [(1, " ".join(words[:20])), (2, "Short ÉTÉ item"), (3, None), (4, " ".join(words[30:43])), (5, " ".join(words[10:25])), (6, "!!")]
    filler = lambda n: [f"f{rng.randrange(1000)}" for _ in range(n)]
    texts = [
        None, "", "nothing here", " ".join(filler(30) + words[:13] + filler(10)), " ".join(words[:12]), "SHORT-ÉTÉ item, and more", "short été item",
        " ".join(filler(300) + words[30:43]), ",".join(w.upper() for w in words[:20]), " ".join(words[5:25] + words[30:43]), "x" * 50_000,
    ]
    texts.append(texts[3])

    def split(t):
        low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    wins = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[k : k + n])].add(str(i))
    want = []
    for d, t in enumerate(texts):
        w, hit, found = split(t), set(), set()
        for n in range(1, 14):
            for k in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= got
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((d, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1_000_000, 0):
        docs = frame(spark, texts)
        windows = decontaminate.benchmark_windows(bench.select(F.col("item_id").cast("string").alias("item"), "text"))
        assert decontaminate.window_hits(docs, windows, limit).count() > 0
    got = decontaminate.contamination(frame(spark, texts), bench).orderBy("doc_id")
    assert [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()] == want
    assert {r.doc_id for r in decontaminate.drop_contaminated(frame(spark, texts), bench).collect()} == {d for d, *_, bad in want if not bad}
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(frame(spark, texts), bench).collect()}
    assert cut[2] == "nothing here" and cut[0] is None and len(split(cut[3])) == 40
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_decontamination_lower_cases_ascii_only(spark):
    """The final sigma of Unicode lower-casing depends on what follows; the A-Z rule leaves it alone."""
    texts = ["ΟΔΟΣ Α beta", "ΟΔΟΣ'Α BETA", "ΟΔΟΣ.Α beta", "οδος α beta", "\x00ΟΔΟΣ\x7fΑ[beta`"]
    bench = spark.createDataFrame([(1, "ΟΔΟΣ Α beta"), (2, None), (3, "...")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(frame(spark, texts), bench).collect()}
    assert [got[i].n_hit for i in range(5)] == [3, 3, 3, 0, 3] and [got[i].n_words for i in range(5)] == [3] * 5
    none = decontaminate.contamination(frame(spark, texts), bench.limit(0)).collect()
    assert all(r.n_hit == 0 and not r.contaminated for r in none)


def test_packing(spark):
    rng = random.Random(1)
    lengths = [rng.choice((0, 1, 5, 100, 511, 512, 513, 4096, 9000)) if rng.random() < 0.5 else rng.randint(1, 4000) for _ in range(500)]
    texts = [None, *[" ".join(["w"] * n) for n in lengths]]
    rows = packing.pack_documents(frame(spark, texts), batch=200).collect()
    per_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        per_doc[r.doc_id].append(r)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for d, n in enumerate([0, *lengths]):
        ps = sorted(per_doc[d], key=lambda r: r.start)
        assert sum(p.length for p in ps) == n and [p.start for p in ps] == list(range(0, max(n, 1), 4096))
        assert all((p.bin_id is None) == (p.length == 0) for p in ps)
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        ends = [r.bin_offset + r.length for r in b]
        assert [r.bin_offset for r in b] == [0, *ends[:-1]]
        assert b[0].bin_length == min(c for c in packing.CAPACITIES if c >= ends[-1])
    assert sum(lengths) / sum(b[0].bin_length for b in bins.values()) > 0.95


def test_packed_sequences(spark):
    """Every word of every text is in the sequences once for each row, in order."""
    rng = random.Random(2)
    texts = [None, " ", *[" ".join(f"{d}.{i}" for i in range(rng.choice([1, 3, 400, 4096, 4097, 9000]))) for d in range(60)]]
    docs = frame(spark, [*texts, texts[5], "null id"], [*range(len(texts)), 5, None])
    packed = packing.pack_documents(docs).persist()
    rows = packing.packed_sequences(docs, packed).collect()
    seen = Counter()
    for r in rows:
        assert len(r.tokens) <= r.bin_length <= 4096 and r.starts == sorted(r.starts)
        for d, a, b in zip(r.doc_ids, r.starts, [*r.starts[1:], len(r.tokens)], strict=True):
            part = r.tokens[a:b]
            if d is not None:
                words = texts[d].split()
                at = words.index(part[0])
                assert part == words[at : at + len(part)]
            seen[d] += len(part)
    assert seen == {d: len(t.split()) * (1 + (d == 5)) for d, t in enumerate(texts) if t and t.strip()} | {None: 2}
    assert packing.packed_sequences(docs.limit(0), packed.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, final = packing.pack(np.array([6, 5, 4, 3]), (8, 10))
    assert bins.tolist() == [0, 1, 0, 1] and final.tolist() == [10, 8] and offsets.tolist() == [0, 0, 6, 5]
    assert packing.pack(np.array([3]), (4, 100))[2].tolist() == [4]


def naive_kernel(s: str, t: str) -> float:
    from itertools import combinations

    a, b = defaultdict(float), defaultdict(float)
    for x, out in ((s, a), (t, b)):
        for at in combinations(range(len(x)), toxicity.P):
            out["".join(x[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
    k = lambda u, v: sum(w * v[z] for z, w in u.items())
    return k(a, b) / (k(a, a) * k(b, b)) ** 0.5


def test_subsequence_kernel():
    words = ["banana", "bandana", "idiot", "idixot", "anagram"]
    phi = toxicity.dense(words)
    got = toxicity.project(words, phi)
    want = [[naive_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want, atol=1e-4)
    assert got[2, 3] > 3 * got[2, 4]


def test_chunks():
    assert toxicity.chunk_of("i.d-i_o,t!!") == "idiot" and toxicity.chunk_of("id10t") == "idt"
    assert "idiot" in {toxicity.chunk_of(w) for w in toxicity.words_of("you i d i o t now")}


def test_training_takes_whole_texts(spark):
    words = [a + b + c for a in "bcdfghklmnprst" for b in "abcdefghijklmnop" for c in "abcdefghijklmnopqrstuvwxyz"]
    assert len(words) > 5000
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs = frame(spark, [" ".join(words), "short one"], ids)
    names, bags = toxicity.training_bags(docs, spark.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id long, toxic int"))
    assert sorted(len(b) for _, b in bags) == [2, len(words)] and set(words) <= set(names)


def test_letters_beyond_the_alphabet():
    got = toxicity.project(["идиот", "привет"], toxicity.dense(["идиот"]))
    assert got[0, 0] > 0.999 and got[1, 0] < 0.5


def test_beginning_of_a_word_is_told_from_its_inside():
    phi = toxicity.dense(toxicity.begun(["bomente"]))
    inside, begins, short = toxicity.project(toxicity.begun(["asbomente", "bomentear", "bo"]), phi)[:, 0]
    assert begins > inside > 0 and short == 0


def test_no_labels(spark):
    docs = frame(spark, ["you idiot", None, ""])
    for lab in ([], [(0, 1)], [(0, 0)], [(99, 1)]):
        got = toxicity.toxicity(docs, spark.createDataFrame(lab, "doc_id long, toxic int")).collect()
        assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 3
    assert toxicity.drop_toxic(docs.limit(0), spark.createDataFrame([(0, 1)], "doc_id long, toxic int")).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(2)
    insults, syll = ["idiot", "moron", "scumbag"], ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(400):
        w, bad = [word() for _ in range(40)], i % 5 == 0
        for _ in range(2 * bad):
            w.insert(rng.randrange(40), rng.choice(insults))
        texts.append(" ".join(w))
        labels.append((i, int(bad)))
    # gapped and marked forms that training never saw
    extra = [None, "", "... 123", " ".join([*(word() for _ in range(10)), "idi-ot", "m.o.r.o.n", "idixot"]), "the " * 30_000 + "moron idiot scumbag"]
    docs = frame(spark, [*texts, *extra])
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, lab).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    right = sum(got[i].predicted == labels[i][1] for i in held)
    assert right / len(held) > 0.97
    assert [got[400 + k].predicted for k in range(5)] == [0, 0, 0, 1, 1]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[400].score == got[401].score
    kept = toxicity.drop_toxic(docs, lab)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted} and kept.columns == docs.columns


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><p>Site</p></header>
    <nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside>
    <article class="post"><h1>Head &amp; line</h1><p><b>First   para&eacute;<br><p>Second&nbsp;one</p><div class="ad">Buy</div><form><p>Sign</p></form>
    <ul><li>One<li>Two</ul><section class="comments"><article><p>Reader says</p></article></section></article><footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line\nFirst paraé\nSecond one\nOne\nTwo"
    assert html_text.main_text("<nav><a>x</a><article><p>In</p></article>") == "In"
    assert html_text.main_text("plain   text") == "plain text"
    assert [html_text.main_text(x) for x in (None, "", "<p></p>", "<footer>f</footer>")] == [""] * 4
    deep = "<div>" * 2000 + "x" + "</div>" * 2000
    assert html_text.main_text(deep) == "x"


def test_html_whole_region():
    """Nothing of an article is dropped because one of its containers holds most of the text."""
    long = "<p>" + "long text of the body, " * 60 + "</p>"
    nav = "<nav><a href='/'>Home</a></nav>"
    for inner in (f"<div class='body'>{long}</div>", f"<ul><li>{long}</li></ul>", f"<table><tr><td>{long}</td></tr></table>", f"<article>{long}</article>"):
        got = html_text.main_text(f"<body>{nav}<article><h1>T</h1><p>lead</p>{inner}<p>last</p></article><footer>f</footer></body>")
        assert got.split("\n")[:2] == ["T", "lead"] and got.split("\n")[-1] == "last" and got.count("long text") == 60
    # without an article: the smallest container of the whole cluster, not of nine tenths of it
    part = "<p>" + "a part of its own, " * 4 + "</p>"
    got = html_text.main_text(f"<body>{nav}<div><div><h2>T</h2>{part}</div><div>{long}</div><div>{part}</div></div></body>")
    assert got.startswith("T\na part") and got.endswith("a part of its own,") and got.count("long text") == 60
    two = html_text.main_text(f"<body>{nav}<article><h1>A</h1>{long}</article><article><h1>B</h1>{long}</article></body>")
    assert two.count("long text") == 120 and "A\n" in two and "\nB\n" in two


def test_html_wrappers():
    """Marks on a wrapper, a form around the page and headers of articles cost no content."""
    inner = "<article><header class='entry-header'><h1>Head</h1></header><p>" + "some text of the page, " * 20 + "</p><div class='ad'>Buy</div></article>"
    want = "Head\n" + ("some text of the page, " * 20).strip()
    side = "<div class='sidebar'><article><h2>Teaser</h2></article></div><div class='comments'><article><p>Reader says</p></article></div>"
    for a, b in (
        ("<div class='layout has-sidebar'><main>", "</main></div>"), ("<form id='aspnetForm'>", "</form>"), ("<div class='widget'>", "</div>"),
        ("<section id='popup'><div role='dialog'>", "</div></section>"), ("<div class='no-comments'>", "</div>"), ("<main class='comments-open'>", "</main>"),
    ):
        assert html_text.main_text(f"<body class='comments-open'><nav>n</nav>{a}{inner}{b}{side}<footer>f</footer></body>") == want, a
    short = "<article><p>Short one</p></article>"
    links = "<p>Some other words that are longer than the article</p>"
    assert html_text.main_text(f"<body><div class='widget'>{short}</div><div class='menu'>Menu</div>{links}</body>").startswith("Short one")
    assert html_text.main_text("<body><div class='modal'><p>All the text of this page</p></div><p>x</p></body>").startswith("All the text")
    assert html_text.main_text(f"<body>{short}<div class='comments'><p>{'Reader says ' * 50}</p></div></body>") == "Short one"
    assert html_text.main_text(f"<body>{short}<div class='site-footer'>f</div><form><p>Sign</p></form></body>") == "Short one"


def test_html_robust():
    m = html_text.main_text
    assert m("<p>a</p><![foo[x]]><p>b</p>") == "a\nb" and m("<p>a <!-- unclosed") == "a" and m("<p>x</p><![x") == "x"
    assert m('<article><div class="header"><h1>T</h1></div><div class="notice-board">nb</div><p>x</p></article>') == "T\nnb\nx"
    assert m('<article><p>one two</p><p class="advert">buy</p><p class="cookie-notice">we use</p><p>last</p></article>') == "one two\nlast"
    two = m("<body><div>" + "word " * 200 + "</div><div>" + "other " * 15 + "</div></body>")
    assert two.count("word") == 200 and two.count("other") == 15
    assert m('<p>end <a href="x') == "end"
    for n in (2000, 50_000):  # deep nesting
        assert m("<div>x" * n).count("x") == n
    assert m("<nav>" * 20_000 + "</section>" * 20_000 + "<article>x" * 20_000).count("x") == 20_000


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "c"), (None, None, None, "c"), (1, "u", "<p>é</p>", "c")], "page_id long, url string, html string, text string")
    got = html_text.extract_text(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "é", 1), (1, "é", 1)]


def test_html_of_the_pages(spark):
    """Against a plain reading of the generator's article element."""
    import html

    pages = table(spark, DATA, "pages")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*)</article>", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", m[1] if m else "")
        text = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in blocks)
        assert got[r.page_id] == "\n".join(x for x in text if x)


def test_patience():
    assert license_scan.rising([(0, 3), (1, 1), (2, 2), (3, 5), (4, 4)]) in ([(1, 1), (2, 2), (4, 4)], [(1, 1), (2, 2), (3, 5)])
    a, b = "x a b c y d e z e".split(), "a b q c d e e".split()
    got = license_scan.align(a, b, 0, len(a), 0, len(b))
    assert got == sorted(got) and [a[i] for i, _ in got] == [b[j] for _, j in got] and len(got) >= 5


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["MIT-grant"]
    texts = [
        None, "", "the license of the thing", "Hello.\nReleased under the MIT License.\nBye", mit.upper().replace(" ", "\n  "),
        mit.replace("free of charge", "at no cost"), "word " * 20_000 + "Licensed under the Apache License, Version 2.0.", mit[: len(mit) // 3],
    ]
    got = {r.doc_id: r for r in license_scan.scan_licenses(frame(spark, texts)).collect()}
    assert [got[i].n_licenses for i in range(8)] == [0, 0, 0, 1, 1, 1, 1, 0]
    assert (got[3].best_license, got[3].best_coverage, got[3].start_word, got[3].end_word) == ("MIT", 1.0, 1, 6)
    assert got[4].best_coverage == 1.0 and 0.75 <= got[5].best_coverage < 1 and got[6].licenses == "Apache-2.0" and got[6].start_word == 20_000


def test_license_names():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    name = lambda text: scanner.best(scanner.scan(text))[0]
    for k, text in license_scan.TEMPLATES.items():
        assert scanner.best(scanner.scan(f"Words before. {text} Words after."))[:2] == (k, 1.0)
    for text in (
        "Released under the BSD License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU Lesser General Public License, version 3.", "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ):
        assert name(text) is None, text
    assert name("This work is licensed under the GNU General Public License, version 3.0.") == "GPL-3.0"
    assert name("Released, " + "and more words " * 9 + "under the MIT License") == "MIT"
    # inserted words cost
    assert scanner.scan("released x under x the x mit x license") == [] and scanner.scan("released under x the mit license")[0][1] == 5 / 6


def test_license_windows():
    """Against the alignment of every window."""
    rng = random.Random(11)
    templates = {n: " ".join(f"{n}{i % (size - 2)}" for i in range(size)) for n, size in (("a", 9), ("b", 14), ("c", 17))}
    scanner, hits = license_scan.Scanner(templates), 0
    for _ in range(60):
        n = rng.choice("abc")
        words = templates[n].split()
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(words))
            words[i : i + rng.randint(0, 1)] = rng.choice([["new"], [], [rng.choice(words)]])
        words = ["pre"] * rng.randint(0, 3) + words + rng.choices(words, k=3) + ["post"]
        want, t = 0.0, templates[n].split()
        for lo in range(len(words)):
            for hi in range(lo + 1, len(words) + 1):
                want = max(want, len(license_scan.align(words, t, lo, hi, 0, len(t))) / max(len(t), hi - lo))
        got = {k: c for k, c, *_ in scanner.scan(" ".join(words))}
        assert got == ({n: want} if want >= 0.75 else {})
        hits += want >= 0.75
    assert 20 < hits < 60
    # the words that tell a template from others best are the ones changed
    t = license_scan.TEMPLATES["GPL-3.0-notice"]
    changed = t.replace("redistribute", "spread").replace("Foundation", "Body").replace("published", "given out")
    assert license_scan.Scanner(license_scan.TEMPLATES).scan(changed)[0][0] == "GPL-3.0-notice"


def test_line_templates(spark):
    head = [f"Page {i} of 20 printed" for i in range(12)]
    texts = [f"{h}\nbody {chr(97 + i)} is its own line of words\n\nall rights reserved here" for i, h in enumerate(head)]
    texts += [None, "", "\n \n", "just once here", texts[0]]
    got = {r.doc_id: r for r in line_templates.drop_lines(frame(spark, texts), min_docs=5).collect()}
    assert got[3].text == "body d is its own line of words\n" and (got[3].n_lines, got[3].n_dropped) == (4, 2)
    assert got[12].text == "" and got[12].n_lines == 0 and got[14].text == "\n \n" and got[15].text == "just once here"
    few = line_templates.drop_lines(frame(spark, texts), min_docs=50).collect()
    assert all(r.n_dropped == 0 for r in few)


def plain_lines(texts: dict[int, str | None], min_docs: int, slices: int) -> dict[int, tuple[int, int, str]]:
    """The template tree by its definition: all templates of a leaf are compared."""

    def joined(rows):
        templates, of = [], {}
        for name, tokens in rows:
            hit = next((t for t in templates if sum(map(str.__eq__, t[1], tokens)) / len(tokens) >= 0.6), None)
            if hit is None:
                templates.append(hit := (name, list(tokens)))
            else:
                hit[1][:] = [x if x == y else "<*>" for x, y in zip(hit[1], tokens, strict=True)]
            of[name] = hit[0]
        return of, templates

    lines = {}
    for doc, text in texts.items():
        for x in (text or "").split("\n"):
            if x.strip():
                lines.setdefault(line_templates.parsed(x)[:2], set()).add(doc)
    parts = defaultdict(list)
    for (masked, h), _ in sorted(lines.items(), key=lambda kv: kv[0][1]):
        tokens = masked.split(" ")
        parts[(len(tokens), *tokens[:3]), h % slices].append((h, tokens))
    first, leaves = {}, defaultdict(list)
    for (leaf, _), rows in parts.items():
        of, templates = joined(rows)
        first |= of
        leaves[leaf] += templates
    second = {}
    for templates in leaves.values():
        second |= joined(sorted(templates))[0]
    where = defaultdict(set)
    for (_, h), docs in lines.items():
        where[second[first[h]]] |= docs
    out = {}
    for doc, text in texts.items():
        all_lines = text.split("\n") if text else []
        kept = [x for x in all_lines if not x.strip() or len(where[second[first[line_templates.parsed(x)[1]]]]) < min_docs]
        out[doc] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_line_templates_by_definition(spark, monkeypatch, slices):
    """Leaves with many templates, ties between templates, repeated lines and a very long line."""
    monkeypatch.setattr(line_templates, "SLICES", slices)
    rng = random.Random(3)
    words = "alpha beta gamma delta".split()
    texts: dict[int, str | None] = {0: None, 1: "", 2: "word " * 30_000, 3: " \n\n"}
    for i in range(4, 120):
        lines = [" ".join([*rng.choice([("the", "same", "start"), ("a", "b", "c")]), *(rng.choice(words) for _ in range(rng.choice([2, 6, 7])))]) for _ in range(6)]
        texts[i] = "\n".join([*lines, lines[0], f"user {i} came at {i}:0{i % 10}", "", f"only here {'x' * i} {'y' * i}"])
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_templates.drop_lines(frame(spark, list(texts.values()))).collect()}
    want = plain_lines(texts, 5, slices)
    assert got == want
    dropped, lines = sum(x[1] for x in want.values()), sum(x[0] for x in want.values())
    assert 100 < dropped < lines - 100


def test_telling_places():
    """Similar lines of a leaf share a token at a telling place."""
    rng = random.Random(1)
    for n in range(1, 40):
        lead = ["l"] * min(3, n)
        for _ in range(200):
            a, b = ([*lead, *(rng.choice("xyz") for _ in range(n - len(lead)))] for _ in range(2))
            if line_templates.similar(a, b) >= line_templates.SIMILAR:
                places = line_templates.telling(n)
                assert not places or any(a[i] == b[i] for i in places)


def test_token_rollup(spark):
    import base64

    import tiktoken

    docs = table(spark, DATA, "documents").unionByName(spark.createDataFrame([(10**9, None, None, None, 0), (10**9 + 1, "", "en", "src1", 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    counts = token_rollup.token_counts(docs, queries.TOKENIZERS)
    got = {r.doc_id: list(r.counts) for r in counts.collect()}
    files = token_rollup.vocabularies(queries.TOKENIZERS)
    for k, v in enumerate(token_rollup.VERSIONS):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, files[v].splitlines())}
        coder = tiktoken.Encoding("own", pat_str=token_rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for r in docs.collect():
            assert got[r.doc_id][k] == len(coder.encode_ordinary(r.text or ""))


def test_token_totals(spark, monkeypatch):
    """All documents count, the empty ones too, and the delete batch takes tokens away."""
    extra = spark.createDataFrame([(None, None, None, None, 0), (10**9, None, None, None, 0), (10**9 + 1, "", "en", "src1", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = table(spark, DATA, "documents").unionByName(extra)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    taken, commit = {}, token_rollup.Rollup.commit

    def seen(self, batch, changes):
        taken[batch] = changes.agg(F.sum("d_tokens")).first()[0]
        return commit(self, batch, changes)

    monkeypatch.setattr(token_rollup.Rollup, "commit", seen)
    got = sorted(map(tuple, queries.op7_token_counts(spark, DATA).collect()), key=str)
    rows = token_rollup.token_counts(docs, queries.TOKENIZERS).select("source", "lang", F.explode(F.map_from_arrays(F.array(*map(F.lit, token_rollup.VERSIONS)), "counts")).alias("tokenizer", "n"))
    plain = rows.groupBy("source", "lang", "tokenizer").agg(F.count("*"), F.sum("n"))
    assert got == sorted(map(tuple, plain.collect()), key=str)
    assert taken["delete-0"] < 0 and taken["insert-again-0"] == -taken["delete-0"]


def test_rollup_batches(spark, tmp_path):
    rows = spark.createDataFrame([("s", "en", "v1", 10), ("s", "en", "v1", 5), ("t", None, "v1", 7)], "source string, lang string, tokenizer string, n_tokens long")
    r = token_rollup.Rollup(spark, str(tmp_path / "state"))
    names = ["a", "b", "c"]
    assert r.commit("a", token_rollup.signed(rows, 1)) and not r.commit("a", token_rollup.signed(rows, 1))
    total = lambda: sorted(((x.source, x.lang, x.n_docs, x.n_tokens) for x in r.totals(names).collect()), key=str)
    assert total() == [("s", "en", 2, 15), ("t", None, 1, 7)]
    r.commit("b", token_rollup.revised(rows.limit(1).withColumn("new", F.lit(12)), "n_tokens", "new"))
    r.commit("c", token_rollup.signed(rows.filter("source = 't'"), -1))
    assert total() == [("s", "en", 2, 17)]
    (tmp_path / "state" / "batch=b" / "_SUCCESS").unlink()  # a batch that broke off is written anew
    assert total() == [("s", "en", 2, 15)]
    r.commit("b", token_rollup.revised(rows.limit(1).withColumn("new", F.lit(12)), "n_tokens", "new"))
    assert total() == [("s", "en", 2, 17)]
    with pytest.raises(ValueError, match="other content"):
        r.commit("c", token_rollup.signed(rows, -1))
    moved = rows.filter("n_tokens = 5").select(F.lit("u").alias("source"), "lang", "tokenizer", "n_tokens", F.lit(6).alias("new"), F.lit("s").alias("was"))
    r.commit("d", token_rollup.revised(moved, "n_tokens", "new", source="was"))
    names.append("d")
    assert total() == [("s", "en", 1, 12), ("u", "en", 1, 6)]
    none = r.totals([])
    assert none.count() == 0 and token_rollup.token_counts(table(spark, DATA, "documents").limit(0), queries.TOKENIZERS).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = table(spark, DATA, "documents")
    kept = docs
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, kept, DATA)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= before and ids, name
        kept = spark.createDataFrame(after.collect(), docs.schema)
    packed = cp.run(spark, DATA)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    assert [s[0] for s in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_by_brute_force(spark, monkeypatch):
    """run() on documents with planted copies, near copies, benchmark passages and empty texts against plain Python, stage by
    stage; what is toxic is what the operator's own scores say."""
    import corpus_pipeline as cp

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    real = table(spark, DATA, "documents")
    labels, bench = table(spark, DATA, "labels"), table(spark, DATA, "benchmark")
    items = [r.text for r in bench.collect() if r.text]
    rng = random.Random(4)
    clean = [r.text for r in real.orderBy("doc_id").limit(40).collect() if r.text and len(r.text.split()) > 60][:12]
    extra: list[str | None] = [None, "", None, " \n", *clean[:5], *clean[:3]]
    for t in clean:
        w = t.split()
        w[rng.randrange(10, len(w) - 10)] = "edited"
        extra.append(" ".join(w))
    extra += [f"some words before {i} and some after" for i in items[:8]] + [" ".join(f"u{k}" for k in range(3000)) + " " + items[0]]
    rows = [(10**6 + k, t, "en", "src", len(t or "")) for k, t in enumerate(extra)]
    docs = real.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).persist()
    monkeypatch.setattr(cp, "table", lambda s, d, name: docs if name == "documents" else table(s, d, name))

    texts = {r.doc_id: r.text for r in docs.collect()}
    ok = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.score < 0.7}
    last = {}
    for d in sorted(ok):
        last[texts[d] or ""] = d
    kept = sorted(last.values())

    sets = []
    for d in kept:
        w = re.findall(r"[^\x20\x09-\x0D]+", (texts[d] or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    where = defaultdict(list)
    for i, shingles in enumerate(sets):
        for x in shingles:
            where[x].append(i)
    pairs = {(a, b) for near in where.values() for a in near for b in near if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert links
    groups = components(len(kept), links)
    kept = [d for i, d in enumerate(kept) if groups[i] == i]

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    wins = {tuple(w[k : k + min(13, len(w))]) for w in map(split, items) if w for k in range(max(1, len(w) - 12))}
    sizes, final = {len(x) for x in wins}, []
    for d in kept:
        w, hit = split(texts[d]), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            final.append(d)
    assert len(final) < len(kept)

    packed, words = cp.run(spark, DATA).collect(), Counter()
    for r in packed:
        words[r.doc_id] += r.length
    assert dict(words) == {d: len(re.findall(r"[^\x20\x09-\x0D]+", texts[d] or "")) for d in final}
