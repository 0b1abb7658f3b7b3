"""Ids that more than one document of an index carries: a filter of hashes, then the ids themselves.

The filter reads the id column alone and counts 8-byte hashes; a hash that occurs once
belongs to a unique id.  Only documents whose hash occurs again (the repeated ids, and
one in some 10^9 of the rest) have their ids shuffled and compared.  So a folder without
repeats costs one narrow aggregate and moves no id and no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateIds(ValueError):
    """Documents of one index share an id."""


def suspects(docs: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``docs`` whose keys' hash occurs more than once."""
    h = F.xxhash64(*keys)
    again = docs.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    return docs.withColumn("_h", h).join(again, "_h", "left_semi").drop("_h")


def duplicate_ids(docs: DataFrame) -> DataFrame:
    """``(index, _id, copies)`` of every id that an index holds more than once; a null id is none."""
    found = suspects(docs.where("_id is not null").select("index", "_id"), "index", "_id")
    return found.groupBy("index", "_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def repeats_by_shard(docs: DataFrame) -> DataFrame:
    """``(index, shard, repeats)``: by how many documents a shard's count exceeds its distinct ids."""
    found = suspects(docs.where("_id is not null").select("index", "shard", "_id"), "index", "shard", "_id")
    per_id = found.groupBy("index", "shard", "_id").agg((F.count(F.lit(1)) - 1).alias("more")).where("more > 0")
    return per_id.groupBy("index", "shard").agg(F.sum("more").cast("bigint").alias("repeats"))


def refuse_duplicates(docs: DataFrame) -> None:
    """Fail on the first repeated id found."""
    found = duplicate_ids(docs).head(1)
    if found:
        raise DuplicateIds(f"index {found[0]['index']!r} holds id {found[0]['_id']!r} {found[0]['copies']} times; "
                           "the key fields are not unique")


__all__ = ["DuplicateIds", "duplicate_ids", "refuse_duplicates", "repeats_by_shard", "suspects"]
