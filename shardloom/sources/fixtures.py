"""Delimited feeds rendered from the driver's tables, and their job specs.

Each feed is a DataFrame ``value string`` derived by Spark from a parquet
table, so its size grows with the table.  Integers, date parts and strings
only (doubles and timestamps print differently across engines).  The planted
cases (null tokens, escaped separators, extra fields, bad numbers) follow
FIXTURES.md; the SQL oracle renders the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import FieldMapping, IndexSpec, TypeSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


# --- types -----------------------------------------------------------------

EVENT_TYPE = TypeSpec("event", ("year", "month", "day", "uid", "event_type", "event_id"),
                      field_sep=",", routing_field="uid", key_fields=("event_id",))
ORDER_TYPE = TypeSpec("order", ("okey", "custkey", "status", "priority", "year"),
                      field_sep="|", routing_field="custkey", key_fields=("okey",))
PART_TYPE = TypeSpec("part", ("partkey", "name", "brand", "type", "size"),
                     field_sep="\x01", key_fields=("partkey",),
                     mapping=(FieldMapping("size", "integer"), FieldMapping("partkey", "long")))
DOC_TYPE = TypeSpec("doc", ("doc_id", "lang", "source", "text"), field_sep=",",
                    routing_field="doc_id", key_fields=("doc_id",),
                    mapping=(FieldMapping("text", "string", "analyzed"),))


def events_spec(num_shards: int = 10) -> IndexSpec:
    return IndexSpec("events", num_shards, (EVENT_TYPE,), partition_fields=("year", "month", "day"))


def orders_spec(num_shards: int = 10) -> IndexSpec:
    return IndexSpec("orders", num_shards, (ORDER_TYPE,), partition_fields=("year",))


def union_spec(num_shards: int = 10) -> IndexSpec:
    """Two types in one index, partitioned by the one field both have."""
    return IndexSpec("activity", num_shards, (EVENT_TYPE, ORDER_TYPE), partition_fields=("year",))


def parts_spec(num_shards: int = 4) -> IndexSpec:
    return IndexSpec("parts", num_shards, (PART_TYPE,))


def docs_spec(num_shards: int = 8) -> IndexSpec:
    return IndexSpec("docs", num_shards, (DOC_TYPE,), partition_fields=("lang",))


# --- feeds -----------------------------------------------------------------

def events_lines(spark: SparkSession, sf_dir: str, keep_key: bool = False,
                 days: tuple[int, int] | None = None) -> DataFrame:
    """``days=(lo, hi)`` renders only events of those days of the month."""
    e = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if days is not None:
        e = e.filter(F.dayofmonth("ts").between(days[0], days[1]))
    eid = F.col("event_id")
    uid = (F.when(eid % 17 == 0, F.lit("\\N")).when(eid % 19 == 0, F.lit(""))
           .otherwise(_s(F.col("user_id"))))
    etype = F.when(eid % 23 == 0, F.concat(F.col("event_type"), F.lit("\\,x"))).otherwise(F.col("event_type"))
    line = F.concat_ws(",", _s(F.year("ts")), F.lpad(_s(F.month("ts")), 2, "0"),
                       F.lpad(_s(F.dayofmonth("ts")), 2, "0"), uid, etype, _s(eid))
    line = F.when(eid % 29 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    cols = [line.alias("value")] + ([eid.alias("src_key")] if keep_key else [])
    return e.select(*cols)


def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    prio = F.when(okey % 13 == 0, F.lit("\\N")).otherwise(F.col("o_orderpriority"))
    line = F.concat_ws("|", _s(okey), _s(F.col("o_custkey")), F.col("o_orderstatus"), prio,
                       _s(F.year("o_orderdate")))
    return o.select(line.alias("value"))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    size = F.when(pk % 31 == 0, F.lit("bad")).otherwise(_s(F.col("p_size")))
    line = F.concat_ws("\x01", _s(pk), F.col("p_name"), F.col("p_brand"), F.col("p_type"), size)
    return p.select(line.alias("value"))


def docs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    text = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit(","), F.lit("\\,"))
    line = F.concat_ws(",", _s(F.col("doc_id")), F.col("lang"), F.col("source"), text)
    return d.select(line.alias("value"))


FEEDS = {
    "event": events_lines,
    "order": orders_lines,
    "part": part_lines,
    "doc": docs_lines,
}


def feed_inputs(spark: SparkSession, sf_dir: str, ispec: IndexSpec) -> dict[str, DataFrame]:
    return {t.name: FEEDS[t.name](spark, sf_dir) for t in ispec.types}
