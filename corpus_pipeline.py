"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. Packing, the last, returns a row for each piece of a document with its place in a training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyspark.llm.common import stash, table
from surveyspark.llm.decontaminate import drop_contaminated
from surveyspark.llm.exact_dedup import drop_copies
from surveyspark.llm.jaccard_join import drop_near_copies
from surveyspark.llm.packing import pack_documents
from surveyspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The toxicity and packing stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stash(docs, f"pipeline-{name}")
    return docs
