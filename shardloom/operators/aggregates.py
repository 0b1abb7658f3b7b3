"""Per-shard and per-index aggregates (all partial + final hash aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .duplicates import repeats_by_shard


def shard_counts(docs: DataFrame) -> DataFrame:
    """A1: documents per (index, shard, type), exact."""
    return docs.groupBy("index", "shard", "type").agg(F.count(F.lit(1)).alias("doc_count"))


def distinct_shards(docs: DataFrame) -> DataFrame:
    """A2: the (index, shard) pairs that hold at least one document."""
    return docs.select("index", "shard").distinct()


def shard_stats(docs: DataFrame, key_col: str | None = None) -> DataFrame:
    """A3: one row per (index, shard), without gathering its documents.

    ``doc_count``, ``distinct_ids``, the smallest and largest id and routing
    key, and the total bytes of the document text.  Distinct ids are the
    documents less the repeats, which are counted among suspects only
    (``duplicates``): a null id counts as one of its own.
    """
    aggs = [F.count(F.lit(1)).alias("doc_count"),
            F.min("_id").alias("min_id"), F.max("_id").alias("max_id"),
            F.sum(F.octet_length("doc")).cast("bigint").alias("doc_bytes")]
    if key_col is not None:
        aggs += [F.min(key_col).alias("min_key"), F.max(key_col).alias("max_key")]
    stats = docs.groupBy("index", "shard").agg(*aggs)
    more = repeats_by_shard(docs).select(F.col("index").alias("_i"), F.col("shard").alias("_s"), "repeats")
    same = F.col("index").eqNullSafe(F.col("_i")) & F.col("shard").eqNullSafe(F.col("_s"))
    return (stats.join(more, same, "left").drop("_i", "_s")
            .withColumn("distinct_ids", F.col("doc_count") - F.coalesce("repeats", F.lit(0))).drop("repeats"))


def index_shards(counts: DataFrame) -> DataFrame:
    """Per index, its non-empty shards (a list bounded by the shard
    count), their number, the document total and whether shard 0 (the
    owner of the index metadata in the source format) holds documents."""
    per_shard = counts.groupBy("index", "shard").agg(F.sum("doc_count").alias("doc_count"))
    return per_shard.groupBy("index").agg(
        F.array_join(F.sort_array(F.collect_set("shard")), ",").alias("shard_list"),
        F.count(F.lit(1)).cast("int").alias("n_shards"),
        F.sum("doc_count").cast("bigint").alias("doc_count"),
        F.max(F.col("shard") == 0).alias("has_shard0"))


def sample_per_type(docs: DataFrame, k: int = 50, order_col: str = "_id") -> DataFrame:
    """A5: the first ``k`` documents of every (index, shard, type) by id.

    Planned as a WindowGroupLimit, so each task keeps at most ``k`` rows per
    group before the exchange: a hot group costs no more than a cold one.
    """
    w = Window.partitionBy("index", "shard", "type").orderBy(order_col)
    return (docs.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= k).drop("_rn"))
