"""Connected components as alternating large-star and small-star rounds.

Each round is two aggregates and two joins over the edge table; the edges are
written to the shared scratch folder after each round.  Only a count and a
checksum reach the driver.  Joins are plain equi-joins, so a hub node is
split by the skew-join rule of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def _signature(e: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(e.agg(F.count(F.lit(1)), F.sum(h)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(src, dst)``; the component
    is its smallest node.  Nulls and self-loops make no link; repeated and
    reversed edges count once; no edges give no rows."""
    e = (edges.where("src <> dst")
         .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    e = saved(e, "components")
    before = _signature(e)
    while before[0]:
        e = saved(_small_star(_large_star(e)).distinct(), "components")
        after = _signature(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select("v", "v").distinct()))


__all__ = ["connected_components"]
