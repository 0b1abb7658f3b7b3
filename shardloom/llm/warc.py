"""WARC archives: a writer with revisit records and a splittable reader.

Writing: pages with equal payloads are found by digest (an aggregate and an
equi-join, salted so that one payload's pages spread over ``SALT`` keys); each
task writes its records as gzip members to archives of its own and returns
their names.  Only archives named in the returned table count, so a task that
ran twice leaves a stray file but no double record.

Reading: archives are cut into byte ranges, one task each.  A task searches
its range for the gzip magic, validates a candidate by decoding the member's
head (it must hold a WARC version line, and the member must end where the file
ends or another member starts), then reads member after member and owns those
that start inside its range.

Files are reached through ``pyarrow.fs``, by the scheme of the folder's URI.
Defined results: null html is an empty payload, and one of any length is a record (which
must fit a task's memory several times over); a null url is left out of the
record; a row without ``page_id`` is written and read back without one and
never owns a payload; rows that share the owner's id and payload are all
responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import saved

MAGIC = b"\x1f\x8b\x08"
LEAST_REVISIT = 1000            # payload bytes from which equal payloads are revisits
ARCHIVE_BYTES = 1 << 30
RANGE_BYTES = 4 << 20
CHUNK = 1 << 16
SALT = 16
DATE = "1970-01-01T00:00:00Z"   # pages carry no time of capture

_CARD = "path string, bytes bigint, records bigint"
_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


# --- records -----------------------------------------------------------------

def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    got = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(got[1]) if got else None


def record(page_id, url, payload: bytes, size: int, digest: str, owner) -> bytes:
    """One WARC record; with ``owner`` a revisit of that page's response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if owner is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if owner is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if owner is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(owner)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse(data: bytes) -> dict | None:
    """Fields and payload of a response or revisit record; None for other types."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    out = {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": None}
    if kind == "revisit":
        out |= {"refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": int(_fields(http).get("content-length", 0)),
                "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(), "payload": None}
    else:
        out |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest(), "payload": payload}
    return out


# --- writing --------------------------------------------------------------------

def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def with_owner(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, size, digest, owner``: the page whose response a
    revisit names, else null."""
    rows = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
            .withColumn("size", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha1("payload")))
    same = (rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("digest", "owner", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", F.spark_partition_id()), F.lit(SALT)).cast("int"))
    joined = salted.join(same, ["digest", "salt"], "left")
    return joined.select("page_id", "url", "payload", "size", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")).alias("owner"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives under ``folder``; returns
    their written list ``(path, bytes, records)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        out, cards = None, []

        def close():
            nonlocal out
            if out:
                out[1].close()
                cards.append((f"{folder.rstrip('/')}/{out[0]}", out[2], out[3]))
                out = None

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = [name, files.open_output_stream(f"{base}/{name}", compression=None), 0, 0]
                z = zlib.compressobj(wbits=31)
                member = z.compress(record(*row)) + z.flush()
                out[1].write(member)
                out[2] += len(member)
                out[3] += 1
                if out[2] >= archive_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cards], pa.string()), pa.array([c[1] for c in cards], pa.int64()),
                                          pa.array([c[2] for c in cards], pa.int64())], names=["path", "bytes", "records"])

    return saved(with_owner(pages).mapInArrow(run, _CARD), "warc-archives")


# --- reading ----------------------------------------------------------------------

def _member(f, at: int, size: int, most: int | None = None) -> tuple[bytes, int] | None:
    """Decoded bytes (up to ``most``) of the gzip member at ``at`` and its end,
    or None if there is none."""
    d, out, pos = zlib.decompressobj(31), [], at
    got = 0
    try:
        while not d.eof and pos < size:
            f.seek(pos)
            data = f.read(min(CHUNK, size - pos))
            pos += len(data)
            out.append(d.decompress(data))
            got += len(out[-1])
            if most is not None and got >= most:
                return b"".join(out), pos
    except zlib.error:
        return None
    return (b"".join(out), pos - len(d.unused_data)) if d.eof else None


def _starts(f, at: int, size: int, first: bool) -> bool:
    """Whether a WARC member starts at ``at``; ``first``: without a trusted neighbour."""
    head = _member(f, at, size, 16)
    if not head or not re.match(rb"WARC/\d\.\d\r\n", head[0]):
        return False
    if not first:
        return True
    whole = _member(f, at, size)
    if not whole:
        return False
    f.seek(whole[1])
    return whole[1] >= size or f.read(3) == MAGIC


def members(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """Decoded members that start in ``[start, end)`` of an open file."""
    at, trusted = start, start == 0
    while at < end:
        if trusted and _starts(f, at, size, False):
            got = _member(f, at, size)
            if got:
                yield got[0]
                at = got[1]
                continue
        # no member here: look for the next magic that a member's head confirms
        trusted, look = False, at if not trusted else at + 1
        while look < end and not trusted:
            f.seek(look)
            data = f.read(min(CHUNK + len(MAGIC) - 1, size - look))
            hit = data.find(MAGIC)
            if hit < 0:
                if look + len(data) >= size:
                    return
                look += max(1, len(data) - len(MAGIC) + 1)
            elif look + hit < end and _starts(f, look + hit, size, True):
                at, trusted = look + hit, True
            else:
                look += hit + 1
        if not trusted:
            return


def read_archives(archives: DataFrame, payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Response and revisit records of the archives in ``archives(path, bytes)``."""
    some = archives.where("bytes > 0")
    cut = some.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
    n = some.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.lit(0))).first()[0]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *["payload"] * payload]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, types)], names=names)

        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                files, name = _open(path)
                with files.open_input_file(name) as f:
                    rows, held = [], 0
                    for data in members(f, start, min(start + range_bytes, size), size):
                        got = parse(data)
                        if got:
                            rows.append(got)
                            held += len(data)
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                    yield batch(rows)

    # one range a task: a range row is small, but what it stands for is not
    return cut.repartition(max(1, int(n)), "path", "start").mapInArrow(run, _RECORD + ", payload binary" * payload)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (by default under the shared scratch folder) and read the records back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), payload=False)


__all__ = ["record", "parse", "with_owner", "write_archives", "members", "read_archives", "round_trip"]
