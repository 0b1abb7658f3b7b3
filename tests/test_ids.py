"""Ordinal ids of equal lines, and repeated key ids."""

import pytest
from pyspark.sql import functions as F

from shardloom import IndexSpec, TypeSpec, build_index
from shardloom.operators import aggregates as agg
from shardloom.operators import duplicates as du
from shardloom.operators import parse as ps
from shardloom.operators.ordinals import with_ordinals
from shardloom.sinks.manifest import read_log
from tests.test_versions import feed

T = TypeSpec("t", ("k", "v"), field_sep=",", routing_field="k")
IX = IndexSpec("ix", 3, (T,))
LINES = ["a,1"] * 700 + [f"k{i % 40},x" for i in range(400)] + [f"u{i},y" for i in range(900)] + ["bad", "", "\\N,z", "\\N,z"]


def written(spark, path, files, lines=LINES):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.text(path)
    return spark.read.text(path)


def ids(lines):
    p = ps.parse_lines(lines, T, IX, id_mode="content").where("_status = 'ok'")
    return sorted(tuple(r) for r in p.select("_line", "_id", "_shard").collect())


def test_content_ids_do_not_depend_on_the_files(spark, scratch):
    one, many = ids(written(spark, f"{scratch}/1", 1)), ids(written(spark, f"{scratch}/9", 9))
    assert one == many and len(one) == 2000 and len({i for _, i, _ in one}) == 2000


def test_ordinals_run_from_one(spark, scratch):
    got = with_ordinals(written(spark, f"{scratch}/5", 5)).groupBy("value").agg(F.count("_ord").alias("n"), F.sort_array(F.collect_list("_ord")).alias("o")).collect()
    assert all(r.o == list(range(1, r.n + 1)) for r in got) and max(r.n for r in got) == 700
    none = spark.createDataFrame([(None,), (None,), ("",)], "value string")
    assert sorted((r.value is None, r._ord) for r in with_ordinals(none).collect())[0] == (False, 1)
    assert with_ordinals(spark.createDataFrame([], "value string")).count() == 0


def test_a_frequent_line_is_numbered_per_split(spark, scratch):
    """No window holds more than one line's copies of one split, and unique lines are in none."""
    lines = written(spark, f"{scratch}/8", 8)
    plan = with_ordinals(lines)._jdf.queryExecution().optimizedPlan().toString()
    ranks = [x for x in plan.splitlines() if "Window" in x and "row_number" in x]
    assert ranks and all("_split" in x.split("], [")[1] for x in ranks)
    per = lines.select(F.spark_partition_id().alias("s"), "value").groupBy("s", "value").count()
    assert per.agg(F.max("count")).first()[0] < 200 < 700


def test_content_ids_in_a_build(spark, scratch):
    res = build_index(spark, IX, f"{scratch}/out", inputs={"t": written(spark, f"{scratch}/in", 4)}, mode="quarantine", id_mode="content")
    assert res.documents.select("_id").distinct().count() == res.documents.count() == 2000 and res.rejected.count() == 2
    with pytest.raises(ValueError):
        ps.parse_lines(feed(spark, "a,1")["t"], T, IX, id_mode="nothing")


KEYED = IndexSpec("ix", 2, (TypeSpec("t", ("k", "v"), field_sep=",", routing_field="v", key_fields=("k",)),))


def test_repeated_keys_fail_a_failfast_build(spark, scratch):
    lines = feed(spark, "1,a", "2,a", "1,b")
    with pytest.raises(du.DuplicateIds, match="2 times"):
        build_index(spark, KEYED, f"{scratch}/out", inputs=lines)
    assert read_log(spark, f"{scratch}/out").last == 0                     # nothing is published
    res = build_index(spark, KEYED, f"{scratch}/out", inputs=lines, mode="quarantine")
    assert [(r["index"], r.copies) for r in res.duplicates.collect()] == [("ix", 2)] and res.documents.count() == 3
    build_index(spark, KEYED, f"{scratch}/fine", inputs=feed(spark, "1,a", "2,a"))


def test_only_suspects_are_compared(spark):
    docs = spark.createDataFrame([("ix", i % 3, f"id{i % 950}", "d") for i in range(1000)] + [("iy", 0, "id1", "d"), ("ix", 0, None, "d"), ("ix", 0, None, "d")],
                                 "index string, shard int, _id string, doc string")
    assert du.suspects(docs.where("_id is not null"), "index", "_id").count() == 100
    assert sorted((r._id, r.copies) for r in du.duplicate_ids(docs).collect()) == sorted((f"id{i}", 2) for i in range(50))
    want = {}
    for r in docs.collect():
        want.setdefault((r["index"], r.shard), []).append(r._id)
    got = {(r["index"], r.shard): (r.doc_count, r.distinct_ids) for r in agg.shard_stats(docs).collect()}
    assert got == {k: (len(v), len(set(v) - {None}) + v.count(None)) for k, v in want.items()}
    # the ids of the rest never leave their task: the exchange before the filter carries hashes only
    plan = du.duplicate_ids(docs)._jdf.queryExecution().executedPlan().toString()
    first = [x for x in plan.splitlines() if "Exchange hashpartitioning(_h" in x]
    assert first
