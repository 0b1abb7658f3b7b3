"""Joins with small configuration tables.

* J3 type lookup - each line takes its separator, field list and routing
  field from its type's row of a type table.  A table made from a spec says that
  it may be broadcast (one row per type; Spark does not know the size of local
  rows, and a shuffle by type puts all lines of a type in one task); a table of
  the caller's is joined as Spark sees fit.
* J4 publish plan - the indices of a new build against those already
  published: ``create`` or ``replace``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import routed_shard
from ..functions.text import split_escaped_by
from ..spec import IndexSpec


def type_table(spark: SparkSession, ispec: IndexSpec) -> DataFrame:
    rows = [(t.name, t.input_path, list(t.field_names), t.field_sep, t.routing_field) for t in ispec.types]
    return F.broadcast(spark.createDataFrame(
        rows, "type string, path string, field_names array<string>, field_sep string, routing_field string"))


def type_lookup(tagged: DataFrame, types: DataFrame, num_shards: int) -> DataFrame:
    """``(type, value)`` lines -> ``(type, value, n_fields, arity_ok, routing, shard)``
    with every rule taken from the joined type row."""
    j = tagged.join(types.select("type", "field_names", "field_sep", "routing_field"), "type")
    f = split_escaped_by("value", "field_sep")
    j = j.withColumn("_f", f)
    ri = F.array_position("field_names", F.col("routing_field"))
    routing = F.when(ri > 0, F.get("_f", (ri - 1).cast("int")))
    return j.select("type", "value", F.size("_f").alias("n_fields"),
                    (F.size("_f") == F.size("field_names")).alias("arity_ok"),
                    routing.alias("routing"),
                    F.when(routing.isNotNull() & ~routing.isin("", "\\N"),
                           routed_shard(routing, num_shards)).alias("shard"))


def publish_plan(new_indices: DataFrame, current: DataFrame) -> DataFrame:
    """``(index, action, previous_version)`` per index of the new build."""
    cur = current.select("index", F.col("version").alias("previous_version")).distinct()
    return (new_indices.select("index").distinct().join(cur, "index", "left")
            .select("index",
                    F.when(F.col("previous_version").isNull(), F.lit("create"))
                    .otherwise(F.lit("replace")).alias("action"),
                    "previous_version"))
