"""SimHash, periodic runs and the conversation trie against plain definitions, and the SQL of all training-data queries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from surveyspark.llm import conversation_trie, periodic_runs, queries, simhash
from surveyspark.llm.common import table

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
#: Further columns whose names clash with the operators' own.
CLASHING = "doc_id long, text string, point long, mask long, key string, runs string, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "k", "r", "x") for i, t in rows], CLASHING)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    rel = con.execute(queries.ORACLE[name])
    columns = sorted(c[0] for c in rel.description)
    at = [[c[0] for c in rel.description].index(c) for c in columns]
    wanted = sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
    assert sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, DATA).select(*columns).collect()) == wanted


# --- SimHash ---------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints, distance):
    comp = list(range(len(prints)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(prints)):
        known = [x for x in (least.get(find(i)), ids[i]) if x is not None]
        least[find(i)] = min(known, default=None)
    return [least[find(i)] for i in range(len(prints))]


def texts_for_prints(seed):
    rng = random.Random(seed)
    words = [f"W{i}É" if i % 5 == 0 else f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(100, 500))] for _ in range(6)]
    out = [None, "", " \n\t", "one", "ONE", "one two", "one two three", "x " * 5000]
    for _ in range(60):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return [*out, out[9], out[9]]


def test_simhash_against_all_pairs(spark):
    texts = texts_for_prints(3)
    rows = [(None if i == 20 else 500 - i, t) for i, t in enumerate(texts)]
    got = {(r.doc_id, r.point % 2**64, r.component_id) for r in simhash.simhash_components(frame(spark, rows)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    comps = plain_components([i for i, _ in rows], prints, 3)
    assert got == {(i, p, c) for (i, _), p, c in zip(rows, prints, comps, strict=True)}
    assert len(set(comps)) < len(set(prints))


@pytest.mark.parametrize("leaf", [2, 20])
def test_large_buckets_are_split(spark, leaf):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(2)]
    points = {rng.getrandbits(64) for _ in range(20)}
    for c in centres:
        points |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)}
    points = sorted(points)
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in points], "point long")
    links = set()
    for part in simhash.near_links(df, 3, leaf):
        links |= {(r.a % 2**64, r.b % 2**64) for r in part.collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    wanted = plain_components(points, points, 3)
    assert [find(p) for p in points] == wanted


def test_finer_masks_cover_the_free_bits():
    for mask in (0, 0xFFFF, 0x0F0F0F0F0F0F0F0F):
        new = [m ^ mask for m in simhash.finer(mask, 4)]
        assert sum(new) == 2**64 - 1 - mask and all(a & b == 0 for a in new for b in new if a != b)


def test_simhash_of_an_empty_table(spark):
    assert simhash.simhash_components(frame(spark, [])).collect() == []


# --- periodic runs -----------------------------------------------------------------------------------------------------------


def plain_runs(words, least=6, times=4):
    out = {}
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                out.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    return b" ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (4, 2), (10, 3), (2, 4)])
def test_runs_against_every_period(least, times):
    rng = random.Random(least * 10 + times)
    found = 0
    for _ in range(1500):
        n, k = rng.randint(0, 50), rng.choice([1, 2, 3, 8])
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.7:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            words = words[:a] + (words[a : a + p] * n)[: n - a]
        runs = periodic_runs.runs_of(words, least, times)
        assert runs == plain_runs(words, least, times)
        assert periodic_runs.collapsed(words, runs) == plain_collapsed(words, runs)
        found += len(runs)
    assert found > 500


def test_segments_tell_where_suffixes_last_ended():
    rng = random.Random(5)
    words = [rng.randrange(3) for _ in range(60)]
    for r, found in enumerate(periodic_runs.segments(words, 1)):
        told = dict((n, last) for n, last in found)
        wanted = {}
        for n in range(1, r + 1):
            ends = [e for e in range(n - 1, r) if words[e - n + 1 : e + 1] == words[r - n + 1 : r + 1]]
            if ends:
                wanted[ends[-1]] = n  # the longest suffix that last ended there
        assert {last: n for n, last in told.items()} == wanted


def test_periodic_runs_of_a_table(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t\x0b", "a", "a b c", "a " * 6, "a " * 5, "x  y\n" * 4 + "x", "é É " * 9 + "z", "p q r " * 300 + "end", "a a a a a a b b b b b b"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 80))) for _ in range(20)]
    rows = [(None if i == 5 else i % 25, t) for i, t in enumerate(texts)]
    got = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.longest and tuple(r.longest), r.text) for r in periodic_runs.periodic_runs(frame(spark, rows)).collect())
    wanted = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = plain_runs(words)
        wanted.append((repr(i), len(words), runs, min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None), plain_collapsed(words, runs).decode()))
    assert got == sorted(wanted)
    assert periodic_runs.periodic_runs(frame(spark, [])).collect() == []


def test_runs_query_over_its_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, DATA).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
        if n > 1500:
            continue  # the plain definition is square
        runs = plain_runs(words)
        assert got[i].n_runs == len(runs)
        assert got[i].runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert got[i].collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs)).hexdigest()


# --- conversation trie -------------------------------------------------------------------------------------------------------


def plain_trie(rows, heads=None):
    """rows: conv, turn, role, text without equal turns."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        base, head = heads(c) if heads else (c, 0)
        built[c] = tuple(own.get(base, [])[:head] + ts[head:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)
    out = []
    for seq, cs in members.items():
        below = [s for s in members if s[: len(seq)] == seq]
        saved = sum((len(members[s]) - 1) * len(s[-1][1].encode()) for s in below if s)
        ends = ",".join(str(c) for c in sorted(cs) if built[c] == seq)
        out.append((min(cs), len(seq), min(members[seq[:-1]]) if seq else None, len(cs), len(children[seq]), sum(not children[s] for s in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def conversations(seed):
    rng = random.Random(seed)
    rows = [(7, None, None, None), (7, 2, "user", ""), (8, 1, "user", "é" * 3000)]
    for c in range(20, 70):
        turns = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, None if k == 0 and c % 7 == 0 else 10 * k, rng.choice(["user", "assistant"]), rng.choice(["hi", "Hi", "ü", None])) for k in range(turns)]
    rows += [(c, k, "user", f"t{k}" if k < 40 or c % 2 else f"u{k}") for c in (100, 101, 102, 103) for k in range(60)]  # long ones with a common start
    rows += [(c, k, "user", f"t{k}") for c in (200, 201) for k in range(60)]
    rows += [(None, 1, "user", "no conversation")]
    rng.shuffle(rows)
    return rows


def trie(spark, rows, **kw):
    # conv, place and k1 clash with the operator's own names
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, conv long, place long, k1 long")
    got = conversation_trie.conversation_trie(df, **kw)
    return sorted(repr(tuple(r)) for r in got.collect())


@pytest.mark.parametrize("part", [2, 20, 4096])
def test_trie_against_plain_prefixes(spark, part, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK", 7)
    monkeypatch.setattr(conversation_trie, "CHUNK", 16)
    rows = conversations(1)
    assert trie(spark, rows, part=part) == plain_trie(rows)


def test_trie_of_rebuilt_conversations(spark):
    from pyspark.sql import functions as F

    rows = [r for r in conversations(4) if r[0] != 30]  # 31 to 34 lack their base
    crc = lambda c: zlib.crc32(str(c).encode()) % 9
    heads = lambda c: (c - c % 5, F.crc32(c.cast("string").cast("binary")) % 9)
    assert trie(spark, rows, heads=heads, part=10) == plain_trie(rows, lambda c: (c - c % 5, crc(c)))


def test_trie_of_few_rows(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    one = [(5, 1, "user", "a")]
    assert trie(spark, one) == plain_trie(one)
    twice = [(5, 1, "user", "a"), (5, 1, "user", "a"), (6, 1, "user", "a")]  # repeated rows are turns of their own
    assert trie(spark, twice) == plain_trie(twice)


def test_rollup_against_plain_sums():
    rng = random.Random(9)
    for n in (1, 2, 50, 300):
        parent = [-1 if i == 0 or rng.random() < 0.02 else (i - 1 if n == 300 else rng.randrange(i)) for i in range(n)]
        values = np.array([[rng.randrange(5), rng.randrange(100)] for _ in range(n)])
        wanted = values.copy()
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                wanted[parent[i]] += wanted[i]
        assert (conversation_trie.rollup(parent, values) == wanted).all()


# --- main text: adverts and inline marks ---------------------------------------------------------------------------------------


def test_marked_parts_of_an_article_go_whatever_their_size():
    from surveyspark.llm.html_text import main_text

    ad = "Buy this and that now " * 40
    for part in (f'<div class="ad"><p>{ad}</p></div>', f'<section id="cookieConsent"><p>{ad}</p></section>', f'<div class="promoted-content">{ad}</div>', f'<div class="replies"><p>{ad}</p></div>', f'<p class="advert">{ad}</p>'):
        assert main_text(f"<body><article><h1>T</h1><p>Own text.</p>{part}<p>More.</p></article></body>") == "T\nOwn text.\nMore.", part
    assert main_text(f'<body><main><div class="widget"><p>{ad}</p></div></main></body>') == ad.strip()  # all that it has


def test_marked_inline_elements_lose_their_text():
    from surveyspark.llm.html_text import main_text

    assert main_text('<article><p>One <span class="ad">Buy <b>now</b> here</span>two <b class="x">three</b></p><p>Four</p></article>') == "One two three\nFour"
    assert main_text('<article><p>One <span class="sponsored">never closed</p><p>Two</p></article>') == "One\nTwo"
    assert main_text('<article><p>A<br class="ad">B <img class="ad">C</p></article>') == "A B C"


def test_main_text_of_an_empty_table(spark):
    from surveyspark.llm.html_text import extract_text

    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string, text string")).collect() == []
