"""One scan over the inputs of several types."""

from dataclasses import replace

import pytest
from pyspark.errors import PySparkException

from shardloom import FieldMapping, IndexSpec, TypeSpec, build_index
from shardloom.operators import parse as ps
from shardloom.plans.build import union_rows
from shardloom.sources import fixtures as fx
from shardloom.sources import lines as ln
from tests.conftest import SF_SMALL

PART = TypeSpec("part", ("pk", "year", "size", "at"), field_sep="|", key_fields=("pk",), max_line_bytes=40,
                mapping=(FieldMapping("size", "integer"), FieldMapping("at", "date")))
SPEC = IndexSpec("all", 7, (fx.EVENT_TYPE, fx.ORDER_TYPE, PART), partition_fields=("year",))


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tree"))
    ln.write_lines(fx.events_lines(spark, SF_SMALL), f"{base}/event")
    ln.write_lines(fx.orders_lines(spark, SF_SMALL), f"{base}/order")
    parts = [f"{i}|20{i % 3 + 20}|{'x' if i % 9 == 0 else i}|2024-01-0{i % 9 + 1}" for i in range(60)] + ["", "only|two", "9|2020|5|" + "2" * 50, "7|2020||"]
    ln.write_lines(spark.createDataFrame([(x,) for x in parts], "value string"), f"{base}/part")
    return replace(SPEC, types=tuple(replace(t, input_path=f"{base}/{t.name}") for t in SPEC.types))


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, df.select(*cols).collect()))


def test_equals_the_scans_by_type(spark, tree):
    one = ps.build_tagged_rows(ln.read_index_lines(spark, tree), tree, mode="quarantine")
    each = union_rows(ln.read_index_inputs(spark, tree), tree, mode="quarantine")
    assert set(one.columns) == set(each.columns) and rows(one) == rows(each)
    assert one.where("reason is not null").groupBy("type").count().count() >= 2


def test_builds_agree_and_scan_once(spark, tree, scratch):
    a = build_index(spark, tree, f"{scratch}/a", mode="quarantine")
    b = build_index(spark, tree, f"{scratch}/b", mode="quarantine", scan="by_type")
    for x, y in ((a.documents, b.documents), (a.rejected, b.rejected), (a.shards, b.shards), (a.mapping, b.mapping)):
        assert rows(x) == rows(y)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan text")
    assert scans(ps.build_tagged_rows(ln.read_index_lines(spark, tree), tree, mode="quarantine")) == 1
    assert scans(union_rows(ln.read_index_inputs(spark, tree), tree, mode="quarantine")) == 3
    with pytest.raises(ValueError):
        build_index(spark, tree, f"{scratch}/c", scan="none")


def test_an_unknown_file_fails_the_build(spark, tree, scratch):
    ln.write_lines(fx.orders_lines(spark, SF_SMALL), f"{scratch}/in/a/deep=1")
    ln.write_lines(fx.orders_lines(spark, SF_SMALL), f"{scratch}/in/b/deep=1")
    t = fx.ORDER_TYPE
    spec = IndexSpec("ix", 2, (replace(t, name="a", input_path=f"{scratch}/in/a"), replace(t, name="b", input_path=f"{scratch}/in/b")))
    with pytest.raises(PySparkException):                       # files below the folders: of no type, or at odds
        build_index(spark, spec, f"{scratch}/out")
    assert build_index(spark, spec, f"{scratch}/out", scan="by_type").documents.select("type").distinct().count() == 2


def test_failfast_and_ids_without_keys(spark, tree, scratch):
    with pytest.raises(PySparkException):
        build_index(spark, tree, f"{scratch}/x")
    for mode in ("position", "content"):
        got = build_index(spark, tree, f"{scratch}/{mode}", mode="quarantine", id_mode=mode).documents
        assert got.select("_id").distinct().count() == got.count()
    one = ps.build_tagged_rows(ln.read_index_lines(spark, tree), tree, mode="quarantine", id_mode="content")
    each = union_rows(ln.read_index_inputs(spark, tree), tree, mode="quarantine", id_mode="content")
    assert rows(one) == rows(each)


def test_when_a_scan_is_shared(tree):
    a, b, c = tree.types
    share = lambda *types: ln.shared_scan(replace(tree, types=types))
    assert share(a, b, c) and not share(a)
    assert not share(a, replace(b, record_sep=";")) and not share(a, replace(b, input_path="/in/*.txt"))
    assert not share(a, replace(b, input_path=a.input_path + "/")) and not share(a, replace(b, input_path=None))
