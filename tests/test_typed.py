"""Typed fields in the written documents."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom import FieldMapping, IndexSpec, TypeSpec, build_index
from shardloom.sinks import documents as sk
from tests.test_versions import feed

AT = dt.datetime(2024, 1, 1)


def spec(kind, name="ix", extra=()):
    t = TypeSpec("t", ("k", "v", "d", "at", "s"), field_sep=",", routing_field="k", key_fields=("k",),
                 mapping=(FieldMapping("v", kind), FieldMapping("d", "date"), FieldMapping("at", "timestamp"), FieldMapping("s", "string", "analyzed"), *extra))
    return IndexSpec(name, 2, (t,))


LINES = ("1,007,2024-02-29,2024-01-02T03:04:05Z,a text", "2,,,,", "3,-5,2023-12-31,2024-01-02 03:04:05.25+02:00,b", "4,x,,,")


def build(spark, out, ispec, *lines, **kw):
    return build_index(spark, ispec, out, inputs=feed(spark, *lines), mode="quarantine", created_at=AT, **kw)


def test_fields_come_back_in_their_types(spark, scratch):
    ix = spec("long")
    res = build(spark, f"{scratch}/a", ix, *LINES)
    sk.publish(spark, f"{scratch}/a", f"{scratch}/live")
    for out in ("a", "live"):
        got = sk.read_typed(spark, f"{scratch}/{out}", ix.types[0])
        assert {f.name: f.dataType for f in got.schema.fields[3:]} == {"v": T.LongType(), "d": T.DateType(), "at": T.TimestampType()}
        rows = got.join(sk.active_documents(spark, f"{scratch}/{out}").select("_id", F.get_json_object("doc", "$.k").alias("k"), "doc"), "_id") \
            .select("k", "v", "d", F.unix_micros("at").alias("us"), "doc").orderBy("k").collect()
        us = int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp()) * 10**6
        assert [tuple(r)[:4] for r in rows] == [("1", 7, dt.date(2024, 2, 29), us), ("2", None, None, None),
                                                ("3", -5, dt.date(2023, 12, 31), us - 2 * 3600 * 10**6 + 250_000)]
        assert '"v":"007"' in rows[0].doc and '"d":"2024-02-29"' in rows[0].doc
    assert res.rejected.count() == 1


def test_a_read_of_one_field_opens_its_column_only(spark, scratch):
    ix = spec("double")
    build(spark, f"{scratch}/a", ix, *LINES)
    plan = sk.read_typed(spark, f"{scratch}/a", ix.types[0]).select("v")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("ReadSchema: ")[1:] if "_typed_t" in x]
    assert scans and all("v:double" in x.splitlines()[0] and "d:date" not in x.splitlines()[0] and "doc" not in x.splitlines()[0] for x in scans)


def test_builds_with_other_types_lie_side_by_side(spark, scratch):
    live = f"{scratch}/live"
    for name, kind in (("a", "integer"), ("b", "double"), ("c", "string")):
        build(spark, f"{scratch}/{name}", spec(kind, f"i{name}"), "1,12,2024-01-01,,")
        sk.publish(spark, f"{scratch}/{name}", live)
    got = {r["index"]: r.v for r in sk.read_typed(spark, live, spec("long").types[0]).collect()}
    assert got == {"ia": 12, "ib": 12, "ic": None}          # text only: the build gave it no type
    assert {r["index"]: r.d for r in sk.read_typed(spark, live, spec("long").types[0]).collect()} == dict.fromkeys(("ia", "ib", "ic"), dt.date(2024, 1, 1))


def test_two_types_in_one_index_and_odd_names(spark, scratch):
    a = TypeSpec("a b", ("k", "x y"), field_sep=",", routing_field="k", key_fields=("k",), mapping=(FieldMapping("x y", "integer"),))
    b = TypeSpec("b", ("k", "z"), field_sep=",", routing_field="k", key_fields=("k",))
    ix = IndexSpec("ix", 2, (a, b))
    inputs = {"a b": feed(spark, "1,5")["t"], "b": feed(spark, "2,6")["t"]}
    build_index(spark, ix, f"{scratch}/a", inputs=inputs, created_at=AT)
    assert [r["x y"] for r in sk.read_typed(spark, f"{scratch}/a", a).collect()] == [5]
    assert [tuple(r)[:1] for r in sk.read_typed(spark, f"{scratch}/a", b).collect()] == [("ix",)]
    assert sk.active_documents(spark, f"{scratch}/a").count() == 2


def test_one_large_index_is_not_gathered_by_the_manifest_join(spark, scratch):
    from shardloom.plans.build import build_index
    from shardloom.sinks import documents as sk
    from shardloom.sources import fixtures as fx
    lines = spark.createDataFrame([(f"{i}|1|O|x|1995",) for i in range(20)], "value string")
    build_index(spark, fx.orders_spec(2), scratch, inputs={"order": lines})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = sk.active_documents(spark, scratch)
        assert "SortMergeJoin [index" not in docs._jdf.queryExecution().executedPlan().toString() and docs.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
