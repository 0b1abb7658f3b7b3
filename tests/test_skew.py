"""A hot routing key (a third of all lines) is split over several write tasks."""

from pyspark.sql import functions as F

from shardloom import IndexSpec, TypeSpec, build_index
from shardloom.sources import fixtures as fx
from tests.conftest import SF_MID


def test_hot_shard_is_split(spark, scratch):
    e = fx.table(spark, SF_MID, "events").repartition(8)      # an input of several splits; the given file is one
    uid = F.when(F.col("event_id") % 3 == 0, F.lit("7")).otherwise(F.col("user_id").cast("string"))
    lines = e.select(F.concat_ws(",", uid, F.col("event_type"), F.col("event_id").cast("string"),
                                 F.lit("x" * 200)).alias("value"))
    t = TypeSpec("event", ("uid", "event_type", "event_id", "pad"), field_sep=",", routing_field="uid",
                 key_fields=("event_id",))
    spec = IndexSpec("hot", 4, (t,))
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        res = build_index(spark, spec, f"{scratch}/out", inputs={"event": lines})
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    docs = res.documents
    hot = docs.filter(F.get_json_object("doc", "$.uid") == "7").select("shard").distinct().collect()
    assert len(hot) == 1
    hot_shard = hot[0].shard
    n_hot = docs.filter(F.col("shard") == hot_shard).count()
    assert n_hot >= e.count() // 3
    files = (docs.filter(F.col("shard") == hot_shard)
             .select(F.col("_metadata.file_path")).distinct().count())
    assert files > 1, "the hot shard was written by a single task"
    assert docs.count() == e.count()
