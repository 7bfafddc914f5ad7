"""From documents to packed training sequences: the corpus operators one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from contentloom.llm.common import shared_folder, table
from contentloom.llm.decontaminate import without_contaminated
from contentloom.llm.line_dedup import without_repeats
from contentloom.llm.near_dedup import one_of_each
from contentloom.llm.packing import pack
from contentloom.llm.queries import public_vocabulary
from contentloom.llm.toxicity import without_toxic
from contentloom.sources.files import SharedFiles


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in one document."""
    return without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its 5-word shingles."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than 5 % of their words in benchmark passages."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with their ids."""
    return pack(docs, public_vocabulary(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Hash signatures, a trained network and greedy packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again.

    The tables go below the folder that ``spark.checkpoint.dir`` names; whoever runs the pipeline
    for good passes the stages a place of their own. A stage's table goes when the next one is
    written; the last one stays for the reader.
    """
    folder = f"{shared_folder(spark)}/corpus-{uuid4().hex}"
    files = SharedFiles(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            files.delete(before)
        before = f"{folder}/{name}"
    return docs
