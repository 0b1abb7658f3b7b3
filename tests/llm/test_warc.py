"""WARC archives: round trip, byte ranges, revisits."""

import gzip
import hashlib
import io
import random

import pytest

from shardloom.llm import warc as W
from shardloom.llm.catalog import LLM_QUERIES

from ..conftest import SF_MID

PAGES = "page_id bigint, url string, html string, payload string, digest string, salt int"
BIG = "x" * 1000


def page(i, html, url="http://a/"):
    return (i, url, html, "p", "d", 1)


ROWS = [page(1, BIG), page(2, BIG), page(3, "é" * 500), page(4, "é" * 500), page(5, "x" * 999), page(6, "x" * 999), page(7, None), page(8, ""),
        page(9, BIG + "y", None), page(2, BIG), page(None, BIG), page(None, "z"), page(10, "a\r\n\r\nb", "http://b/\r\nWARC-Type: x")]


def want(rows):
    out, owner = [], {}
    for i, _, html, *_ in rows:
        b = (html or "").encode()
        if len(b) >= 1000 and i is not None:
            owner[b] = max(owner.get(b, i), i)
    for i, _, html, *_ in rows:
        b = (html or "").encode()
        o = owner.get(b) if sum((r[2] or "").encode() == b for r in rows) > 1 else None
        again = o is not None and i != o
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", o if again else None))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("range_bytes", [W.RANGE_BYTES, 97])
def test_round_trip_of_odd_rows(spark, tmp_path, range_bytes):
    pages = spark.createDataFrame(ROWS, PAGES).coalesce(2)
    cards = W.write_archives(pages, f"file://{tmp_path}/a", archive_bytes=600)
    assert cards.count() > 2
    got = W.read_archives(cards, range_bytes=range_bytes)
    assert told(got) == want(ROWS)
    texts = {r.page_id: bytes(r.payload).decode() for r in got.where("record_type = 'response'").collect()}
    assert texts[10] == "a\r\n\r\nb" and texts[7] == "" and texts[4] == "é" * 500
    assert {r.page_id: r.url for r in got.collect()}[9] is None
    assert W.round_trip(pages.limit(0)).count() == 0


def test_query_on_pages(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()]
    assert told(LLM_QUERIES["op9_warc"](spark, SF_MID)) == want(rows)


def test_archives_are_plain_multi_member_gzip(spark, tmp_path):
    W.write_archives(spark.createDataFrame(ROWS[:3], PAGES).coalesce(1), f"file://{tmp_path}/a")
    (f,) = [p for p in (tmp_path / "a").iterdir() if p.name.endswith(".warc.gz")]
    text = gzip.decompress(f.read_bytes())
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"WARC-Type: revisit") == 1


def test_each_member_is_owned_by_one_range():
    rng = random.Random(5)
    bodies = [W.record(i, "u", rng.randbytes(rng.randint(0, 3000)) + W.MAGIC * rng.randint(0, 3), 0, "00" * 20, None) for i in range(60)]
    # a payload that holds gzip members of its own, stored without compression
    inner = gzip.compress(bodies[0])
    data = b"".join(gzip.compress(b, compresslevel=rng.choice([0, 1, 9])) for b in [*bodies, W.record(99, "u", inner + b"tail", 0, "00" * 20, None)])
    all_ = [*bodies, W.record(99, "u", inner + b"tail", 0, "00" * 20, None)]
    for step in (1, 50, 777, 5000, len(data)):
        cuts = range(0, len(data), step) if step > 1 else range(0, 4000, 1)
        got = [m for s in cuts for m in W.members(io.BytesIO(data), s, min(s + step, len(data)), len(data))]
        assert got == (all_ if step > 1 else all_[:len(got)]) and got
