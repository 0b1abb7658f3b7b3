from shardloom.operators import parse as ps
from shardloom.session import scratch_path
from shardloom.sinks import documents as sk
from shardloom.sources import fixtures as fx
from shardloom.sources import lines as ln
from shardloom.streaming import stream_rows, write_stream
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark, scratch):
    src = f"{scratch}/in"
    ln.write_lines(fx.events_lines(spark, SF_SMALL), src)
    spec = fx.events_spec(4)
    rows = stream_rows(spark, spec, "event", src, max_files_per_trigger=1)
    q = write_stream(rows, f"{scratch}/out", scratch_path(spark, "stream-ckpt"), available_now=True)
    q.awaitTermination(300)
    got = sk.read_documents(spark, f"{scratch}/out").select("index", "shard", "_id")
    batch = ps.documents(ps.parse_lines(spark.read.text(src), fx.EVENT_TYPE, spec), fx.EVENT_TYPE, spec,
                         mode="quarantine").select("index", "shard", "_id")
    assert got.count() == batch.count()
    assert got.subtract(batch).count() == 0
    assert sk.read_rejected(spark, f"{scratch}/out").count() == \
        ps.rejected(ps.parse_lines(spark.read.text(src), fx.EVENT_TYPE, spec)).count()


def test_a_stream_honours_the_feed_options(spark, scratch):
    """Record separator and line limit of the type, as in a batch build."""
    from dataclasses import replace

    from shardloom import build_index

    src = f"{scratch}/in"
    ln.write_lines(fx.events_lines(spark, SF_SMALL), src, line_sep=";")
    limit = 27
    spec = fx.events_spec(4)
    spec = replace(spec, types=(replace(spec.types[0], input_path=src, record_sep=";", max_line_bytes=limit),))
    rows = stream_rows(spark, spec, "event", src)
    write_stream(rows, f"{scratch}/out", scratch_path(spark, "stream-ckpt"), available_now=True).awaitTermination(300)
    res = build_index(spark, spec, f"{scratch}/batch", mode="quarantine")
    ids = lambda df: sorted(r._id for r in df.select("_id").collect())
    assert ids(sk.read_documents(spark, f"{scratch}/out")) == ids(res.documents)
    assert sk.read_rejected(spark, f"{scratch}/out").count() == res.rejected.count()
    short = [r for r in fx.events_lines(spark, SF_SMALL).collect() if len(r.value.encode()) + 1 < limit]
    assert 0 < res.documents.count() <= len(short) < fx.events_lines(spark, SF_SMALL).count()
