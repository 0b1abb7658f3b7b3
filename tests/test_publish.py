"""Publishers that race, snapshots of the log, removal of replaced builds."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from shardloom.sinks import documents as sk
from shardloom.sinks import files
from shardloom.sinks import manifest as mf
from tests.test_versions import build, keys


def test_a_file_is_made_once(spark, scratch):
    wins = []

    def go(me):
        for i in range(20):
            if files.put_if_absent(spark, f"{scratch}/c/{i}", me):
                wins.append((i, me))
    threads = [threading.Thread(target=go, args=(str(k),)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(i for i, _ in wins) == list(range(20)) and len(files.names(spark, f"{scratch}/c")) == 20
    assert all(files.read_text(spark, f"{scratch}/c/{i}") == me for i, me in wins)


def test_a_build_id_is_used_once(spark, scratch):
    first = build(spark, f"{scratch}/out", "1,x", build_id="B")
    with pytest.raises(ValueError, match="never overwritten"):
        build(spark, f"{scratch}/out", "2,x", build_id="B")
    assert first.documents.count() == 1 and keys(sk.active_documents(spark, f"{scratch}/out")) == ["1"]
    with pytest.raises(ValueError, match="build id"):
        build(spark, f"{scratch}/out", "2,x", build_id="a/b")


def racing(monkeypatch, n):
    """The first ``n`` commits wait for each other after they have read the log."""
    gate, real, left = threading.Barrier(n), files.put_if_absent, [n]

    def wait(spark, path, text):
        if "/commits/" in path and left[0] > 0:
            left[0] -= 1
            gate.wait(60)
        return real(spark, path, text)
    monkeypatch.setattr(files, "put_if_absent", wait)


def test_racing_publishers_get_numbers_of_their_own(spark, scratch, monkeypatch):
    live = f"{scratch}/live"
    for b in "ABC":
        build(spark, f"{scratch}/{b}", f"{b},x", build_id=b)
    racing(monkeypatch, 3)
    threads = [threading.Thread(target=sk.publish, args=(spark, f"{scratch}/{b}", live)) for b in "ABC"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = sk.read_table(spark, live, "manifest").orderBy("publish_seq").collect()
    assert [r.publish_seq for r in rows] == [1, 2, 3] and {r.build_id for r in rows} == set("ABC")
    for _ in range(2):
        assert keys(sk.active_documents(spark, live)) == [rows[-1].build_id]
    assert [keys(sk.active_documents(spark, live, as_of=k)) for k in (1, 2, 3)] == [[r.build_id] for r in rows]


def test_the_loser_sees_what_the_winner_published(spark, scratch, monkeypatch):
    """Two publish the same build: one publication, the other finds it done."""
    live = f"{scratch}/live"
    build(spark, f"{scratch}/a", "1,x")
    racing(monkeypatch, 2)
    got = []
    threads = [threading.Thread(target=lambda: got.append(sk.publish(spark, f"{scratch}/a", live).count())) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [0, 1] and sk.read_table(spark, live, "manifest").count() == 1
    assert keys(sk.active_documents(spark, live)) == ["1"]


def test_a_rollback_copies_nothing(spark, scratch):
    live = f"{scratch}/live"
    for b in "ab":
        build(spark, f"{scratch}/{b}", f"{b},x", build_id=b)
        sk.publish(spark, f"{scratch}/{b}", live)
    before = sorted(os.listdir(f"{live}/documents"))
    sk.publish(spark, f"{scratch}/a", live)
    assert keys(sk.active_documents(spark, live)) == ["a"] and sorted(os.listdir(f"{live}/documents")) == before
    sk.publish(spark, live, live, build_id="b")                # within the folder itself
    assert keys(sk.active_documents(spark, live)) == ["b"] and sorted(os.listdir(f"{live}/documents")) == before


def test_snapshots_bound_what_a_reader_opens(spark, scratch, monkeypatch):
    live = f"{scratch}/live"
    monkeypatch.setattr(mf, "SNAPSHOT_EVERY", 4)
    for b in "ab":
        build(spark, f"{scratch}/{b}", f"{b},x", build_id=b)
    for k in range(11):
        sk.publish(spark, f"{scratch}/{'ab'[k % 2]}", live)
    log = mf.read_log(spark, live)
    assert log.last == 11 and log.snapshot and [n for n, _ in log.tail] == [9, 10, 11]
    assert keys(sk.active_documents(spark, live)) == ["a"]
    for k in range(1, 12):
        assert keys(sk.active_documents(spark, live, as_of=k)) == ["ab"[(k - 1) % 2]]
        assert len(mf.read_log(spark, live, as_of=k).tail) < 4
    assert len(mf.read_log(spark, live, whole=True).tail) == 11
    # a lost snapshot changes nothing
    for n in files.names(spark, f"{live}/manifest/snapshots"):
        files.delete(spark, f"{live}/manifest/snapshots/{n}")
    assert keys(sk.active_documents(spark, live)) == ["a"] and len(mf.read_log(spark, live).tail) == 11


def test_a_thousand_publications(spark, scratch):
    """The log alone: a reader opens one snapshot and the tail."""
    build(spark, f"{scratch}/a", "1,x", build_id="a")
    row = mf.current_manifest(spark, f"{scratch}/a")
    name = files.read_text(spark, f"{scratch}/a/manifest/commits/{1:012d}")
    for n in range(2, 1001):
        files.put_if_absent(spark, f"{scratch}/a/manifest/commits/{n:012d}", name)
        if n % mf.SNAPSHOT_EVERY == 0 and n > 960:
            mf.write_snapshot(spark, f"{scratch}/a", n)
    log = mf.read_log(spark, f"{scratch}/a")
    assert log.last == 1000 and len(log.tail) == 1000 % mf.SNAPSHOT_EVERY
    assert row.count() == 1 and keys(sk.active_documents(spark, f"{scratch}/a")) == ["1"]


def test_what_is_out_of_reach_is_removed(spark, scratch):
    live = f"{scratch}/live"
    for b in "abcd":
        build(spark, f"{scratch}/{b}", f"{b},x", "bad", build_id=b, postings=True)
        sk.publish(spark, f"{scratch}/{b}", live)
    seen = lambda keep: sorted(r.build_id for r in sk.removable_builds(spark, live, keep).collect())
    assert [seen(k) for k in range(5)] == [["a", "b", "c"], ["a", "b"], ["a"], [], []]
    assert sk.remove_replaced(spark, live, keep=1) == 2
    assert [keys(sk.active_documents(spark, live, as_of=k)) for k in (3, 4)] == [["c"], ["d"]]
    assert keys(sk.read_table(spark, live, "documents")) == ["c", "d"]
    assert sk.read_table(spark, live, "terms").where("term = 'a' or term = 'b'").count() == 0
    # the removal is a number of the log: one state back is d's again
    assert seen(1) == ["c"] and sk.remove_replaced(spark, live, keep=5) == 0
    # a removed build is copied anew by a rollback, and not from within the folder
    with pytest.raises(ValueError, match="removed"):
        sk.publish(spark, live, live, build_id="a")
    sk.publish(spark, f"{scratch}/a", live)
    assert keys(sk.active_documents(spark, live)) == ["a"]
    with pytest.raises(ValueError):
        sk.removable_builds(spark, live, keep=-1)


def test_copies_without_a_manifest_row_are_removed_by_age(spark, scratch):
    live = f"{scratch}/live"
    build(spark, f"{scratch}/a", "1,x")
    sk.publish(spark, f"{scratch}/a", live)
    docs = sk.read_table(spark, f"{scratch}/a", "documents")
    sk.write_documents(docs.withColumn("index", F.lit("ix@a:b c")), live, "left-behind")
    soon, hour_ago = dt.datetime.now() + dt.timedelta(hours=1), dt.datetime.now() - dt.timedelta(hours=1)
    time.sleep(0.1)
    assert sk.unlisted_builds(spark, live, hour_ago).count() == 0
    assert [tuple(r)[:2] for r in sk.unlisted_builds(spark, live, soon).collect()] == [("ix@a:b c", "left-behind")]
    assert sk.remove_replaced(spark, live, unlisted_before=soon) == 1
    assert sk.read_table(spark, live, "documents").count() == 1 and keys(sk.active_documents(spark, live)) == ["1"]


def test_publish_and_remove_from_the_command_line(spark, scratch, capsys):
    import json

    from shardloom.__main__ import main

    live = f"{scratch}/live"
    for b in "abc":
        build(spark, f"{scratch}/{b}", f"{b},x", build_id=b)
        assert main(["publish", f"{scratch}/{b}", live]) == 0
    assert main(["remove", live, "--keep", "1"]) == 0
    told = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [t.get("published", t.get("removed")) for t in told] == [1, 1, 1, 1]
    assert keys(sk.active_documents(spark, live)) == ["c"] and keys(sk.active_documents(spark, live, as_of=2)) == ["b"]
