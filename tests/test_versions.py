"""Builds in folders of their own: empty feeds, mixed folders, activation, rollback."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardloom import IndexSpec, TypeSpec, build_index
from shardloom.functions.ids import key_id
from shardloom.functions.maps import str_to_map
from shardloom.operators import postings as po
from shardloom.sinks import documents as sk
from shardloom.sources import fixtures as fx
from tests.conftest import SF_SMALL

T = TypeSpec("t", ("k", "v"), field_sep=",", routing_field="k", key_fields=("k",))
AT = dt.datetime(2024, 1, 1)


def feed(spark, *lines):
    return {"t": spark.createDataFrame([(x,) for x in lines], "value string")}


def build(spark, out, *lines, spec=None, **kw):
    return build_index(spark, spec or IndexSpec("ix", 2, (T,)), out, inputs=feed(spark, *lines), mode="quarantine", created_at=AT, **kw)


def keys(df):
    return sorted(r[0] for r in df.select(F.get_json_object("doc", "$.k")).collect())


@pytest.mark.parametrize("lines", [(), ("\\N,a", ",b"), ("a,b,c", "")])
def test_a_feed_without_documents_builds(spark, scratch, lines):
    res = build(spark, f"{scratch}/out", *lines, postings=True)
    for df in (res.documents, res.shards, res.mapping, res.manifest, res.postings, res.terms):
        assert df.count() == 0
    assert res.rejected.count() == (2 if "a,b,c" in lines else 0)
    assert sk.publish(spark, f"{scratch}/out", f"{scratch}/live").count() == 0
    build(spark, f"{scratch}/out", "1,x")
    sk.publish(spark, f"{scratch}/out", f"{scratch}/live")
    assert keys(sk.active_documents(spark, f"{scratch}/live")) == ["1"]


def test_a_replacement_is_not_seen_before_its_manifest_row(spark, scratch):
    live = f"{scratch}/live"
    build(spark, f"{scratch}/a", "1,x", "2,x")
    sk.publish(spark, f"{scratch}/a", live)
    second = build(spark, f"{scratch}/b", "7,x", "8,x", "9,x")
    # the copy step alone, as after a failure before the append
    sk.read_table(spark, f"{scratch}/b", "documents").write.partitionBy("build_id", "index").mode("append").parquet(f"{live}/documents")
    assert keys(sk.active_documents(spark, live)) == ["1", "2"]
    sk.publish(spark, f"{scratch}/b", live)
    assert keys(sk.active_documents(spark, live)) == ["7", "8", "9"]
    assert sk.active_table(spark, live, "shards").select("build_id").distinct().first()[0] == second.build_id


def test_last_publication_wins_and_an_older_build_rolls_back(spark, scratch):
    live = f"{scratch}/live"
    build(spark, f"{scratch}/a", "1,x", build_id="zz")
    build(spark, f"{scratch}/b", "2,x", build_id="aa")         # the same created_at
    seen = []
    for out in ("a", "b", "b", "a"):
        sk.publish(spark, f"{scratch}/{out}", live)
        seen.append((keys(sk.active_documents(spark, live)), sk.read_table(spark, live, "manifest").count()))
    assert seen == [(["1"], 1), (["2"], 2), (["2"], 2), (["1"], 3)]


def test_earlier_results_and_rejects_stay(spark, scratch):
    out = f"{scratch}/out"
    first = build(spark, out, "1,x", "bad")
    second = build(spark, out, "2,x", "worse,a,b")
    assert keys(first.documents) == ["1"] and first.shards.count() == 2 and first.rejected.first().value == "bad"
    assert keys(second.documents) == ["2"] and keys(sk.active_documents(spark, out)) == ["2"]
    assert sorted(r.value for r in sk.read_rejected(spark, out).collect()) == ["bad", "worse,a,b"]
    assert {r.build_id for r in sk.read_rejected(spark, out, with_build=True).collect()} == {first.build_id, second.build_id}


def test_a_folder_of_two_specs_keeps_all_columns(spark, scratch):
    live = f"{scratch}/live"
    u = TypeSpec("t", ("k", "year", "day"), field_sep=",", routing_field="k", key_fields=("k",))
    build(spark, f"{scratch}/a", "1,x")
    build(spark, f"{scratch}/b", "2,2024,05", spec=IndexSpec("iy", 3, (u,), partition_fields=("year", "day")))
    for out in "ab":
        sk.publish(spark, f"{scratch}/{out}", live)
    got = {r["index"]: r for r in sk.active_documents(spark, live).collect()}
    assert set(got) == {"ix", "iy@2024-05"} and got["iy@2024-05"].day == "05" and got["ix"].day is None


def test_settings_come_back_after_a_build(spark, scratch):
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        build(spark, f"{scratch}/out", "1,x")
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.set(name, before)


def test_different_keys_have_different_ids(spark):
    rows = [("x\x01y", "z"), ("x", "y\x01z"), ("1:a", ""), ("", "1:a"), (None, "-"), ("-", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(key_id("t", "a", "b")).distinct().count() == len(rows)


def test_long_tokens_are_terms_unless_limited(spark):
    df = spark.createDataFrame([("ix", 0, "doc", "1", "x" * 300 + " short")], "_index string, _shard int, _type string, _id string, text string")
    terms = lambda **kw: sorted(r.term for r in po.text_postings(df, fx.DOC_TYPE, **kw).select("term").collect())
    assert terms() == ["short", "x" * 300] and terms(max_token_length=255) == ["short"]


def test_maps_with_many_entries(spark):
    n = 20_000
    text = ",".join(f"k{i % 15_000}:v{i}" for i in range(n))
    got = spark.createDataFrame([(text,)], "s string").select(str_to_map("s").alias("m")).first().m
    assert got == {f"k{i % 15_000}": f"v{i}" for i in range(n)}


def test_no_plan_of_the_feeds_has_a_round_robin(spark):
    for fn in fx.FEEDS.values():
        assert "RoundRobin" not in fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
