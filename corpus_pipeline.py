"""Corpus pipeline: stages over ``documents``, each on all that its predecessor kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  All but the last return the columns of
``documents`` (extra columns pass through, whatever their names; the operators' own
columns start with ``__llm_``).  An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm import byte_bpe, mixing, quality_perplexity, secret_scan, simhash_dedup
from shardloom.llm.catalog import vocabulary
from shardloom.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's perplexity band go.

    A null or empty text fails the rules; rows without id and repeated rows are judged each."""
    return quality_perplexity.kept_documents(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id, rows without id last.

    Repeated rows are copies; rows of one id with unrelated texts are groups of their own."""
    return simhash_dedup.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; every row stays.

    A null text stays null; rows without id are searched by every rule."""
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: repeated, whole, partial or no text of a document.

    A null source is one of its own; texts without words are never taken."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, ids and digests of every text of the mix; a null text has no tokens."""
    return byte_bpe.encode(docs, *vocabulary(), whole=True, decoded=False)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", simhash_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

ORACLE_SQL = None   # SimHash, perplexity bands and byte-level BPE are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared scratch
    folder and read back as the next stage's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
