"""Queries and oracle SQL of the training-data operators, over the whole tables."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table
from .conversation_trie import conversation_trie
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .license_scan import scan_licenses
from .line_templates import drop_lines
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .simhash import simhash_components
from .substrings import drop_repeats
from .token_rollup import VERSIONS, Rollup, revised, rollup_folder, signed, token_counts
from .toxicity import toxicity


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = drop_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


#: Where the vocabularies lie.
TOKENIZERS = "/opt/tokenizers"


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after batches: four of inserts with estimated counts and no language, one repeated, one of revisions to the true
    language and counts, one that deletes the documents of an insert batch, and one that inserts them again."""
    counts = stash(token_counts(table(spark, sf_dir, "documents"), TOKENIZERS), "token-counts")
    each = counts.select(
        "doc_id", "source", "lang", F.lit(None).cast("string").alias("no_lang"), (F.col("n_chars") / 4).cast("long").alias("estimate"),
        F.explode(F.map_from_arrays(F.array(*map(F.lit, VERSIONS)), "counts")).alias("tokenizer", "n_tokens"),
    )
    rollup = Rollup(spark, rollup_folder(spark, f"token-rollup-{uuid.uuid4().hex}"))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(4)), F.lit(0))
    inserts = [f"insert-{k}" for k in range(4)]
    for k, name in [*enumerate(inserts), (2, inserts[2])]:
        rollup.commit(name, signed(each.filter(part == k).withColumn("lang", F.col("no_lang")), 1, "estimate"))
    rollup.commit("revise-0", revised(each, "estimate", "n_tokens", lang="no_lang"))
    rollup.commit("delete-0", signed(each.filter(part == 0), -1))
    rollup.commit("insert-again-0", signed(each.filter(part == 0), 1))
    return rollup.totals([*inserts, "revise-0", "delete-0", "insert-again-0"])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "sig", "sig2")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id", F.col("copies").alias("n_copies"))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that the contract of op12 scans: a tenth of the documents get a periodic tail, by a checksum of the id."""
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=repeated_tail)
    start, length, period = F.col("longest.start"), F.col("longest.length"), F.col("longest.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(
        table(spark, sf_dir, "conversations"), heads=lambda c: (c - c % 5, F.crc32(c.cast("string").cast("binary")) % 9), most=8
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_bestfit_packing,
        op3_jaccard_join,
        op4_suffix_dedup,
        op5_line_dedup,
        op6_exact_dedup,
        op7_token_counts,
        op8_toxicity,
        op9_decontamination,
        op10_html_extraction,
        op11_simhash_near_dedup,
        op12_periodic_runs,
        op13_conversation_trie,
    )
}



def crc(col: str) -> str:
    """SQL for the CRC-32 of a number's decimal digits, bit by bit."""
    byte = "list_reduce([xor(a, b)] || range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))"
    digits = f"[CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST({col} AS VARCHAR), '')]"
    return f"xor(4294967295, list_reduce([4294967295] || {digits}, lambda a, b: {byte}))"


ORACLE: dict[str, str] = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        sh AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE
            [hash(array_to_string(ws[i:i + 4], ' ')) FOR i IN range(1, greatest(len(ws) - 4, 1) + 1)] END) AS s FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
          GROUP BY ALL),
        links AS (
          SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
        sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(x, root) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT sym.y, root FROM reach JOIN sym ON sym.x = reach.x WHERE sym.y > root)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT x, min(root) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
    """,
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op9_decontamination": r"""
        WITH w AS (
          SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
          FROM documents
          UNION ALL
          SELECT 'b', CAST(item_id AS VARCHAR), regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
          FROM benchmark),
        bw AS (
          SELECT DISTINCT id AS item, least(13, len(ws)) AS n,
            unnest([array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') FOR i IN range(1, greatest(len(ws) - 12, 1) + 1)]) AS win
          FROM w WHERE kind = 'b' AND len(ws) > 0),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (
          SELECT id, n, unnest(range(1, len(ws) - n + 2)) AS p0,
            unnest([array_to_string(ws[i:i + n - 1], ' ') FOR i IN range(1, len(ws) - n + 2)]) AS win
          FROM w, sizes WHERE kind = 'd' AND len(ws) >= n),
        hits AS (SELECT dw.id, dw.p0, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
        words AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(p0, p0 + n)) AS p FROM hits) GROUP BY id),
        items AS (SELECT id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM hits GROUP BY id)
        SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
          coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM w LEFT JOIN words USING (id) LEFT JOIN items USING (id) WHERE kind = 'd'
    """,
    "op12_periodic_runs": rf"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {crc("doc_id")} AS h FROM documents),
        e AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS edited, h // 10 AS g FROM d),
        f AS (SELECT *, CASE WHEN edited THEN g % n END AS a FROM e),
        t AS (SELECT doc_id, n, edited, a, ws, CASE WHEN edited THEN 1 + (n - a) // (3 + g % 8) END AS p FROM f),
        words AS (
          SELECT doc_id, n, i, CASE WHEN edited AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w
          FROM (SELECT *, unnest(range(n)) AS i FROM t)),
        same AS (
          SELECT x.doc_id, y.i - x.i AS q, y.i AS i FROM words x JOIN words y
          ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
        islands AS (
          SELECT doc_id, q, min(i) - q AS s, count(*) + q AS l
          FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same)
          GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS (SELECT doc_id, s, l, min(q) AS q FROM islands GROUP BY doc_id, s, l),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
        kept AS (
          SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS txt
          FROM words LEFT JOIN (SELECT doc_id, i, true AS g FROM gone) USING (doc_id, i) WHERE g IS NULL GROUP BY doc_id),
        each AS (
          SELECT doc_id, count(*) AS n_runs, min_by(struct_pack(s := s, l := l, q := q), (-l, s, q)) AS r,
            sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256
          FROM runs GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(r.s AS BIGINT) AS start, CAST(r.l AS BIGINT) AS length, CAST(r.q AS BIGINT) AS period,
          CAST(1000 * r.l // r.q AS BIGINT) AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
          sha256(coalesce(txt, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN each ON each.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
    "op13_conversation_trie": f"""
        WITH convs AS (SELECT conv_id AS c, count(*) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (SELECT c, c - c % 5 AS base, {crc("c")} % 9 AS h FROM convs),
        turns AS (
          SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS k
          FROM (SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS bytes,
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d FROM conversations)),
        built AS (
          SELECT heads.c, k AS place, d, bytes FROM heads JOIN turns ON turns.c = base AND k <= h
          UNION ALL
          SELECT heads.c, k - h + least(h, coalesce(own, 0)), d, bytes
          FROM heads LEFT JOIN convs b ON b.c = base JOIN turns ON turns.c = heads.c AND k > h),
        keyed AS (
          SELECT c, place, bytes, sha256(string_agg(d, ',') OVER (PARTITION BY c ORDER BY place)) AS k FROM built
          UNION ALL
          SELECT c, 0, 0, 'root' FROM convs),
        rows AS (SELECT *, lag(k) OVER w AS up, place = max(place) OVER (PARTITION BY c) AS ends FROM keyed WINDOW w AS (PARTITION BY c ORDER BY place)),
        nodes AS (
          SELECT k, min(c) AS conv_id, max(place) AS depth, count(*) AS n_convs, max(up) AS up, (count(*) - 1) * max(bytes) AS saved,
            sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
          FROM rows GROUP BY k),
        kids AS (SELECT up AS k, count(*) AS n FROM nodes GROUP BY up),
        full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.k = nodes.k),
        sums AS (
          SELECT rows.k, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
          FROM full_nodes u JOIN rows ON rows.c = u.conv_id AND rows.place <= u.depth GROUP BY rows.k)
        SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
          CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
        FROM full_nodes v LEFT JOIN nodes p ON p.k = v.up JOIN sums ON sums.k = v.k
    """,
}
