"""Ordinals of equal lines: every copy of a line gets a number of its own, 1 to the number of copies.

Copies are counted per scan split (a partial and final aggregate over digests of
the lines), a prefix sum over the splits that hold a line gives each split its first
number, and a window within one line of one split numbers the copies there.  So no
group is larger than a split, also where one line is a third of the feed, and a line
that stands once (most do) is not numbered at all.  Which copy gets which number does
not matter: they are equal.  The set of numbers does not depend on how the feed is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_ordinals(lines: DataFrame, *value_cols: str, name: str = "_ord") -> DataFrame:
    """``lines`` (straight from a scan) with the ordinal of each among equal values of
    ``value_cols`` (default: ``value``).

    A null value is equal to other nulls; an empty input gives no rows.
    """
    cols = lines.columns
    told = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in value_cols or ("value",)]
    digest = F.unhex(F.md5(F.concat(*told)))
    marked = lines.withColumns({"_h": digest, "_split": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    counts = marked.groupBy("_h", "_split").agg(F.count(F.lit(1)).alias("_n"))
    splits = Window.partitionBy("_h")                   # one row a split that holds the line
    upto = F.sum("_n").over(splits.orderBy("_split"))
    repeated = (counts.select("_h", "_split", (upto - F.col("_n")).alias("_first"), F.sum("_n").over(splits).alias("_all"))
                .where("_all > 1").drop("_all"))
    told = marked.join(repeated, ["_h", "_split"], "left")
    once = told.where("_first is null").select(*cols, F.lit(1).cast("bigint").alias(name))
    within = F.row_number().over(Window.partitionBy("_h", "_split").orderBy("_at"))
    again = told.where("_first is not null").select(*cols, (F.col("_first") + within).cast("bigint").alias(name))
    return once.unionByName(again)


__all__ = ["with_ordinals"]
