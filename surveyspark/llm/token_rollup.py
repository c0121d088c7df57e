"""Token counts as delta-maintained rollups.

A change is a signed row: an insert adds a document's tokens to its group (source, language, tokenizer version), a delete
takes them away, a revision takes the old row away and adds the new one, in another group if need be. A batch of changes is
added up and committed as a small table of its own in the state folder, under the batch's id; the write's success marker is
the commit. A batch that is committed already adds nothing, and one that broke off is written anew, so repeating batches
after a failure changes nothing; a committed id with other content is refused. Totals are the sum of the committed batches.

Tokens are counted with public vocabularies, whose folder is a parameter; each text is encoded whole.

Defined cases: null and empty texts have no tokens but count as documents; null sources and languages are groups of their
own; repeated rows count each; groups whose documents are all gone are left out of the totals; further columns are
ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_pandas, own, shared_dir

VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")
GROUP = ["source", "lang", "tokenizer"]
# Fixed value: the pattern by which the byte-level vocabularies split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabularies(folder: str, versions: tuple[str, ...] = VERSIONS) -> dict[str, bytes]:
    """The vocabularies' files, read on the driver (about 1 MB each)."""
    return {v: Path(f"{folder}/{v}.tiktoken").read_bytes() for v in versions}


def encoders(files: dict[str, bytes]) -> list:
    import tiktoken

    def ranks(data: bytes) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}

    return [tiktoken.Encoding(v, pat_str=PATTERN, mergeable_ranks=ranks(x), special_tokens={}) for v, x in files.items()]


def token_counts(
    docs: DataFrame,
    folder: str,
    versions: tuple[str, ...] = VERSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """doc_id, source, lang, n_chars, counts (one per version) of each row."""
    rows = own(docs, id_col, text_col, source=source_col, lang=lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies(folder, versions))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coders = encoders(shared.value)
        for pdf in batches:
            texts = [t or "" for t in pdf.text]
            yield pdf.assign(n_chars=list(map(len, texts)), counts=[[len(c.encode_ordinary(t)) for c in coders] for t in texts])

    schema = rows.drop("text").schema.add("n_chars", "long").add("counts", T.ArrayType(T.LongType()))
    return map_pandas(rows, count, schema)


def signed(rows: DataFrame, sign: int, tokens: str = "n_tokens") -> DataFrame:
    """Changes that insert (1) or delete (-1) rows with source, lang, tokenizer and a token count."""
    return rows.select(*GROUP, F.lit(sign).cast("long").alias("d_docs"), (F.lit(sign) * F.col(tokens)).cast("long").alias("d_tokens"))


def revised(rows: DataFrame, old: str, new: str, **was: str) -> DataFrame:
    """Changes of documents whose count goes from ``old`` to ``new``; was: the column of the former value of source or lang,
    where the group changes."""
    before = rows.withColumns({k: F.col(v) for k, v in was.items()}) if was else rows
    return signed(before, -1, old).unionByName(signed(rows, 1, new))


class Rollup:
    """Committed batches in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self.folder}/batch={batch}/_SUCCESS")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before. Raises ValueError if that was with other content."""
        sums = changes.groupBy(GROUP).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        path = f"{self.folder}/batch={batch}"
        if self.committed(batch):
            there = self.spark.read.schema(sums.schema).parquet(path)
            if not sums.exceptAll(there).unionByName(there.exceptAll(sums)).isEmpty():
                raise ValueError(f"batch {batch} was committed with other content")
            return False
        sums.write.mode("overwrite").parquet(path)
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over the committed ones of these batches."""
        done = [f"{self.folder}/batch={b}" for b in batches if self.committed(b)]
        schema = "source string, lang string, tokenizer string, d_docs long, d_tokens long"
        deltas = self.spark.read.schema(schema).parquet(*done) if done else self.spark.createDataFrame([], schema)
        sums = deltas.groupBy(GROUP).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")


def rollup_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}"
