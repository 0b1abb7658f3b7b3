"""The term dictionary of a live folder follows its publications."""

import shutil
from glob import glob

from pyspark.sql import functions as F

from shardloom import FieldMapping, IndexSpec, TypeSpec, build_index
from shardloom.operators.postings import term_stats
from shardloom.sinks import dictionary as dc
from shardloom.sinks import documents as sk
from tests.test_versions import AT, feed

T = TypeSpec("t", ("day", "k", "body"), field_sep=",", routing_field="k", key_fields=("day", "k"), mapping=(FieldMapping("body", "string", "analyzed"),))
SPEC = IndexSpec("ix", 3, (T,), partition_fields=("day",))


def publish(spark, scratch, name, *lines):
    build_index(spark, SPEC, f"{scratch}/{name}", inputs=feed(spark, *lines), mode="quarantine", created_at=AT, postings=True)
    sk.publish(spark, f"{scratch}/{name}", f"{scratch}/live")


def recount(spark, live):
    return rows(term_stats(sk.active_table(spark, live, "postings").withColumn("index", F.lit("all"))).drop("index"))


def rows(df):
    return sorted(tuple(r) for r in df.select("field", "term", "doc_freq", "total_freq").collect())


def test_the_dictionary_follows_partial_replacements(spark, scratch):
    live = f"{scratch}/live"
    assert dc.refresh_terms(spark, live) == 0 and dc.active_terms(spark, live).count() == 0
    publish(spark, scratch, "a", "1,x,red red blue", "2,x,blue", "3,y,green blue")
    assert rows(dc.active_terms(spark, live)) == recount(spark, live)
    publish(spark, scratch, "b", "2,x,blue blue black", "2,z,white")
    # the terms and postings of what stayed are not looked at
    for name in ("terms", "postings"):
        for day in (1, 3):
            for at in glob(f"{live}/{name}/*/index=ix@{day}"):
                shutil.move(at, f"{scratch}/{name}-{day}-{at.count('/')}")
                home = at
    got = rows(dc.active_terms(spark, live))
    assert ("body", "blue", 3, 4) in got and ("body", "red", 1, 2) in got and ("body", "white", 1, 1) in got and home
    assert len(got) == len({(f, t) for f, t, *_ in got}) and all(d > 0 for _, _, d, _ in got)


def test_many_publications_rollback_and_removal(spark, scratch):
    live = f"{scratch}/live"
    publish(spark, scratch, "a", "1,x,red", "2,x,blue")
    dc.refresh_terms(spark, live)
    publish(spark, scratch, "b", "1,x,green")
    publish(spark, scratch, "c", "1,x,black", "4,x,red")
    assert sk.remove_replaced(spark, live, keep=0) == 2                # the dictionary is brought up to date first
    assert rows(dc.active_terms(spark, live)) == recount(spark, live)
    sk.publish(spark, f"{scratch}/a", live)                             # back to what was removed: copied anew
    assert rows(dc.active_terms(spark, live)) == recount(spark, live)
    assert ("body", "green", 1, 1) not in rows(dc.active_terms(spark, live))
    plan = dc.merged_terms(spark, live, 1, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" in plan


def test_two_refreshes_make_one_version(spark, scratch, monkeypatch):
    live = f"{scratch}/live"
    publish(spark, scratch, "a", "1,x,red")
    real = dc.files.put_if_absent
    monkeypatch.setattr(dc.files, "put_if_absent", lambda s, p, t: real(s, p, "gone-before") and False if "versions" in p else real(s, p, t))
    dc.refresh_terms(spark, live)
    assert dc.files.names(spark, f"{live}/dictionary/rows") == []
