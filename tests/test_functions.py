"""Random and edge tests of the column functions against plain-Python rules."""

import random

from pyspark.sql import functions as F

from shardloom import functions as X
from tests import rules

ALPHABET = ["a", "b", "Z", "0", ",", "|", "\x01", "\\", "N", " ", "é", "中", "😀", "\t", '"', ":", "."]


def random_strings(n, seed=7, max_len=12):
    rnd = random.Random(seed)
    out = set()
    while len(out) < n:
        out.add("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, max_len))))
    return sorted(out)


def test_split_null_unescape_random(spark):
    vals = random_strings(600)
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for sep in (",", "|", "\x01", ".", "é", "N"):
        got = {r.v: (r.sp, r.fv) for r in df.select(
            "v", X.split_escaped("v", sep).alias("sp"), X.field_value("v").alias("fv")).collect()}
        for v in vals:
            assert got[v][0] == rules.split(v, sep), (v, sep)
            assert got[v][1] == rules.unescape(rules.null_token(v)), v


def test_java_hash_and_shard_random(spark):
    vals = random_strings(800, seed=11, max_len=30) + ["", "hello", "polygenelubricants"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select("v", X.java_hash("v").alias("h"), X.java_hash_fold("v").alias("hf"),
                     X.routed_shard("v", 7).alias("s"), X.routed_shard("v", 64).alias("s64")).collect()
    for r in rows:
        assert r.h == rules.java_hash(r.v), r.v
        assert r.hf == r.h, r.v
        assert r.s == rules.shard(r.v, 7)
        assert r.s64 == rules.shard(r.v, 64)


def test_hash_probes(spark):
    df = spark.createDataFrame([("hello",), ("polygenelubricants",), ("",)], "v string")
    got = dict(df.select("v", X.java_hash("v").alias("h")).collect())
    assert got == {"hello": 99162322, "polygenelubricants": -2147483648, "": 0}
    assert dict(df.select("v", X.routed_shard("v", 10).alias("s")).collect())["polygenelubricants"] == 8


def test_edge_lines(spark):
    edge = ["", ",", ",,", "a,", "\\,a", "a\\,b,c", "\\ab\\c", "a\\b\\c", "\\N,x"]
    df = spark.createDataFrame([(v,) for v in edge], "v string")
    got = {r.v: r.sp for r in df.select("v", X.split_escaped("v", ",").alias("sp")).collect()}
    assert got[","] == ["", ""]
    assert got[",,"] == ["", "", ""]
    assert got["a,"] == ["a", ""]
    assert got["\\,a"] == ["\\,a"]
    assert got["a\\,b,c"] == ["a\\,b", "c"]
    fv = {r.v: r.fv for r in df.select("v", X.field_value("v").alias("fv")).collect()}
    assert fv["\\ab\\c"] == "\\ab\\c"       # first backslash at 0: kept
    assert fv["a\\b\\c"] == "abc"
    assert fv[""] is None


def test_naming(spark):
    df = spark.createDataFrame([("2024", "01", "\\N")], "a string, b string, c string")
    r = df.select(X.index_name("ix", "a", "b", "c").alias("i")).first()
    assert r.i == "ix@2024-01-\\N"
    df2 = spark.createDataFrame([("ix@a@b",), ("plain",)], "i string")
    got = dict(df2.select("i", X.index_suffix("i").alias("s")).collect())
    assert got == {"ix@a@b": "a@b", "plain": None}


def test_maps(spark):
    df = spark.createDataFrame([("a:1,b:2,a:3",), ("x",), ("a\\,b:c:d,e:f",), (":a",), ("a\nb:c",)], "v string")
    got = {r.v: r.m for r in df.select("v", X.str_to_map("v").alias("m")).collect()}
    assert got["a:1,b:2,a:3"] == {"a": "3", "b": "2"}
    assert got["x"] is None and got[":a"] is None and got["a\nb:c"] is None
    assert got["a\\,b:c:d,e:f"] == {"a\\,b": "c", "e": "f"}
    m = spark.range(1).select(X.map_to_str(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))).alias("s"))
    assert m.first().s == "a:1,b:2"


def test_ids_are_stable_and_unique(spark):
    df = spark.createDataFrame([(str(i % 50),) for i in range(200)], "k string")
    a = [r.i for r in df.select(X.key_id("t", "k").alias("i")).collect()]
    b = [r.i for r in df.select(X.key_id("t", "k").alias("i")).collect()]
    assert a == b and all(len(x) == 22 for x in a)
    assert len(set(a)) == 50


def test_fold_hash_switch_routes_the_same(spark):
    from shardloom.functions import hashing
    df = spark.createDataFrame([(v,) for v in random_strings(300, seed=23, max_len=20)], "v string")
    by_reflect = dict(df.select("v", X.routed_shard("v", 10)).collect())
    hashing.use_fold_hash(True)
    try:
        plan = df.select(X.routed_shard("v", 10))._jdf.queryExecution().optimizedPlan().toString()
        by_fold = dict(df.select("v", X.routed_shard("v", 10)).collect())
    finally:
        hashing.use_fold_hash(False)
    assert "reflect" not in plan and "aggregate" in plan
    assert by_fold == by_reflect
