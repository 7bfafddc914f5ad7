"""The registered queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table
from .decontaminate import find_contamination
from .language import identify_language
from .line_dedup import dedup_lines
from .mixing import Mix
from .near_dedup import ForestSettings, near_duplicates
from .packing import pack
from .phrases import collocations
from .pii import SurrogateSettings, replace_entities
from .quality import quality
from .quality_rules import quality_rules
from .sharding import shard
from .tokens import Vocabulary
from .toxicity import toxicity
from .whitening import whiten


def public_vocabulary() -> Vocabulary:
    """The byte-level vocabulary of 50,257 tokens, from the installed package of tokenizer files."""
    from public_tokenizers import path

    return Vocabulary(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share at least 85 % of their 3-word shingles."""
    return near_duplicates(table(spark, folder, "documents"), ForestSettings(words=3, percent=85))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack(table(spark, folder, "documents"), public_vocabulary())


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and divergence verdicts of all documents."""
    return quality_rules(table(spark, folder, "documents")).drop("class_distance", "word_distance")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return identify_language(table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with surrogates for personal data; the tables are invented, so any key will do."""
    found = replace_entities(table(spark, folder, "documents"), SurrogateSettings(key="invented tables"))
    return found.select("doc_id", "text", "n_entities")


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of nearly equal sizes."""
    return shard(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of 40 characters or more that five documents or more share."""
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages of 13 words in documents."""
    found = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings on the 32 strongest components of their covariance, with unit variance."""
    return whiten(table(spark, folder, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best phrases of two or three words of each language."""
    return collocations(table(spark, folder, "documents"))


def op13_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix with source weights 1, 2 and 3 takes."""
    return Mix(table(spark, folder, "documents")).counts()


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_quality_classifier,
        op3_packing,
        op4_quality_rules,
        op5_language_id,
        op6_toxicity,
        op7_pii_surrogates,
        op8_sharding,
        op9_line_dedup,
        op10_decontamination,
        op11_embedding_whitening,
        op12_phrase_collocations,
        op13_source_mixing,
    )
}
ORACLES = {
    "op1_minhash_near_dedup": oracles.OP1,
    "op4_quality_rules": oracles.OP4,
    "op9_line_dedup": oracles.OP9,
    "op10_decontamination": oracles.OP10,
    "op12_phrase_collocations": oracles.OP12,
    "op13_source_mixing": oracles.OP13,
}
