"""Dense shard grid: every index that holds a document gets all its shards.

The grid is ``#indices x num_shards`` rows, generated with
``explode(sequence(0, n-1))`` per index (no cross join, no join at all): the
per-shard counts of an index are gathered into a map first, which holds at
most ``num_shards`` entries whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_shard(counts_or_docs: DataFrame) -> DataFrame:
    if "doc_count" in counts_or_docs.columns:
        return counts_or_docs.groupBy("index", "shard").agg(F.sum("doc_count").cast("bigint").alias("doc_count"))
    return counts_or_docs.groupBy("index", "shard").agg(F.count(F.lit(1)).alias("doc_count"))


def _dense(per_shard: DataFrame, num_shards: int) -> DataFrame:
    """Per index, its present shards as a map (at most ``num_shards`` entries,
    a bound set by the spec), then every shard ``0..n-1`` looked up in it.
    One aggregate chain over the documents; no join, no second pass."""
    per_index = per_shard.groupBy("index").agg(
        F.map_from_entries(F.collect_list(F.struct("shard", "doc_count"))).alias("_counts"))
    grid = per_index.select("index", "_counts",
                            F.explode(F.sequence(F.lit(0), F.lit(num_shards - 1))).alias("shard"))
    count = F.try_element_at(F.col("_counts"), F.col("shard"))
    return grid.select("index", F.col("shard").cast("int").alias("shard"),
                       F.coalesce(count, F.lit(0)).cast("bigint").alias("doc_count"),
                       count.isNull().alias("is_empty"))


def shard_grid(counts_or_docs: DataFrame, num_shards: int) -> DataFrame:
    """``(index, shard, doc_count, is_empty)`` for shards ``0..n-1``."""
    return _dense(_per_shard(counts_or_docs), num_shards)


def empty_shards(counts_or_docs: DataFrame, num_shards: int) -> DataFrame:
    """The shards of a seen index that hold no document."""
    return shard_grid(counts_or_docs, num_shards).filter("is_empty").select("index", "shard")
