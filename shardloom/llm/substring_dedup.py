"""Substring duplicates by difference-cover anchors.

A word is removed if a window of ``window`` consecutive words that covers it also
starts in a document of a smaller ``doc_id``.

1. Anchors: runs of ``window - period + 1`` words are hashed only where their word
   position modulo ``period`` lies in a difference cover (a set whose differences give
   every residue).  For any two equal windows, wherever they stand in their documents,
   some offset puts both onto cover positions, so they share an anchor there; with
   period 7 this takes 3 of 7 positions.
2. Documents are dealt to blocks of about ``block_bytes`` of text.  Each block sends its
   distinct anchors once, by bucket; the bucket answers with a bit for each that more
   than one document holds.  An anchor is only a filter, so 6 bytes of its hash do.
3. Shared anchors are extended: the windows that hold one at a fitting offset (few,
   unless much of the text is copied) are hashed whole, with 128 bits, and sent once a
   block with the smallest document of the block that holds them.
4. The bucket answers with the smallest document of all, for those windows of a block
   that a smaller document than the block's largest holds; the block marks the words.

A passage that a third of all documents hold costs one entry a block, never a row per
document or pair of documents.  Lists get shorter as blocks and buckets grow in number,
down to one entry each, which is what a plain shuffle of anchors would send.

Defined results: a null or empty text has no words; a text shorter than a window loses
nothing; a document must fit a task's memory some ten times over, however long; rows that
share a ``doc_id`` do not remove each other's words (neither is smaller); a row without
``doc_id`` removes nothing and loses nothing; repeated rows are judged each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cover:
    window: int = 13
    period: int = 7
    residues: tuple[int, ...] = (0, 1, 3)      # differences modulo 7 give every residue
    block_bytes: int = 8 << 20
    bucket_bytes: int = 32 << 20               # of text, for each bucket of anchors or windows

    def __post_init__(self):
        if {(a - b) % self.period for a in self.residues for b in self.residues} != set(range(self.period)):
            raise ValueError(f"{self.residues} is no difference cover modulo {self.period}")
        if self.period > self.window:
            raise ValueError("the period may not exceed the window")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))      # odd multipliers of the rolling sums


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Block:
    """Word hashes of the documents of a block that take part, one after the other."""

    def __init__(self, ids: list[int], texts: list[bytes], c: Cover):
        import xxhash

        self.c, hashes, sizes, docs = c, [], [], []
        for i, text in zip(ids, texts):
            words = WORDS.findall(text)
            if i is not None and len(words) >= c.window:
                hashes.append(b"".join(map(xxhash.xxh3_128_digest, words)))
                sizes.append(len(words))
                docs.append(i)
        self.words = np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64).reshape(-1, 2)
        self.sizes = np.array(sizes, np.int64)
        self.docs = np.array(docs, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def runs(self, length: int, lane: int) -> np.ndarray:
        """Hash of the run of ``length`` words from each position (those that cross a document's end too)."""
        w = self.words[:, lane]
        n = max(0, len(w) - length + 1)
        h = np.zeros(n, np.uint64)
        for i in range(length):
            h = h * STEP[lane] + w[i:n + i]
        return mixed(h)

    def positions(self, length: int, keep: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start positions of the runs that lie in one document, and that document's row."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        at = np.arange(len(doc)) - np.repeat(self.starts, self.sizes)
        inside = at + length <= np.repeat(self.sizes, self.sizes)
        if keep is not None:
            inside &= keep(at)
        found = np.flatnonzero(inside)
        return found, doc[found]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(position, document row, hash)`` of every anchor."""
        at, doc = self.positions(self.c.anchor, lambda p: np.isin(p % self.c.period, self.c.residues))
        return at, doc, self.runs(self.c.anchor, 0)[at]

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(position, document row)`` of the windows that hold an anchor at one of the positions ``shared``."""
        at, doc = self.positions(self.c.window)
        mark = np.zeros(len(self.words) + 1, np.int64)
        mark[shared + 1] = 1
        before = np.cumsum(mark)                                # anchors that start before a position
        fit = before[np.minimum(at + self.c.period, len(mark) - 1)] > before[at]
        return at[fit], doc[fit]


def _distinct(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the smallest and the largest id of each."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return keys, ids, ids
    return keys[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def _short(h: np.ndarray) -> bytes:
    """The low 6 bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _long(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.pad(six, ((0, 0), (0, 2))).view("<u8").ravel().astype(np.uint64)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """By the 16 bits that the short form lacks, and more that it holds."""
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(h: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(bucket, rows)``; rows of a bucket keep their order."""
    b = _bucket(h, buckets)
    order = np.argsort(b, kind="stable")
    ends = np.flatnonzero(np.diff(b[order])) + 1
    for rows in np.split(order, ends) if len(order) else ():
        yield int(b[rows[0]]), rows


def _sent_anchors(block: Block, buckets: int):
    """What a block sends, in an order that it can make again: per bucket the distinct
    anchors, and a bit for those that two of its documents hold."""
    at, doc, h = block.anchors()
    keys, low, high = _distinct(h, block.docs[doc])
    for b, rows in _by_bucket(keys, buckets):
        yield b, keys[rows], low[rows] < high[rows]


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """``(block, ids, texts)`` of rows sorted by block."""
    import zstandard

    unpack, now, ids, texts = zstandard.ZstdDecompressor(), None, [], []
    for b in batches:
        for block, i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if block != now:
                if ids:
                    yield now, ids, texts
                now, ids, texts = block, [], []
            ids.append(i)
            texts.append(unpack.decompress(data))
    if ids:
        yield now, ids, texts


def _blocks(docs: DataFrame, c: Cover) -> tuple[DataFrame, int]:
    """``(block, doc_id, text)``: compressed texts dealt to blocks, and the number of buckets."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = int(total // c.block_bytes) + 1
    # the input partition salts ids that many rows share (or lack)
    block = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(n)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = [pack.compress((t or "").encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["block", "doc_id", "text"])

    return (docs.select(block.alias("block"), "doc_id", "text").mapInArrow(run, "block int, doc_id bigint, text binary")
            .repartition("block").sortWithinPartitions("block")), int(total // c.bucket_bytes) + 1


def _send_anchors(c: Cover, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, ids, texts in _each_block(batches):
            rows = [(at, b, _short(keys), _bits(two)) for b, keys, two in _sent_anchors(Block(ids, texts, c), buckets)]
            if rows:
                yield _table(rows, LISTS)
    return run


LISTS = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])
BITS = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
LEAST = pa.schema([("block", pa.int32()), ("keys", pa.binary()), ("least", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _shared(table: pa.Table) -> pa.Table:
    """A bucket's answer: which of each block's anchors more than one document holds."""
    keys = [_long(k) for k in table.column("keys").to_pylist()]
    sizes = [len(k) for k in keys]
    h = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    two = np.concatenate([_flags(m, n) for m, n in zip(table.column("more").to_pylist(), sizes)]) if keys else np.empty(0, bool)
    _, place, count = np.unique(h, return_inverse=True, return_counts=True)
    several = count > 1
    several[place[two]] = True
    answer = several[place]
    out = [_bits(a) for a in np.split(answer, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())}, schema=BITS)


def _candidates(c: Cover, buckets: int, window_buckets: int):
    """Cogroup of a block with the answers to its anchors: its windows to be compared."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(*_documents(left), c)
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()))
        found = [keys[_flags(answers[b], len(keys))] for b, keys, _ in _sent_anchors(block, buckets)]
        shared = np.sort(np.concatenate(found)) if found else np.empty(0, np.uint64)
        at, _, h = block.anchors()
        at, doc = block.windows(at[_member(h, shared)])
        first, second = block.runs(c.window, 0)[at], block.runs(c.window, 1)[at]
        order = np.lexsort((second, first))
        first, second, ids = first[order], second[order], block.docs[doc[order]]
        new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]) if len(first) else np.empty(0, np.int64)
        rows = []
        if len(new):
            low, high = np.minimum.reduceat(ids, new), np.maximum.reduceat(ids, new)
            pair = np.stack([first[new], second[new]], axis=1)
            number = left.column("block")[0].as_py()
            for b, own in _by_bucket(pair[:, 0], window_buckets):
                rows.append((number, b, pair[own].tobytes(), np.stack([low[own], high[own]], axis=1).tobytes()))
        return pa.Table.from_batches([_table(rows, LISTS)], schema=LISTS)
    return run


def _member(h: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(h), bool)
    return among[np.minimum(np.searchsorted(among, h), len(among) - 1)] == h


def _documents(table: pa.Table) -> tuple[list, list]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return table.column("doc_id").to_pylist(), [unpack(t) for t in table.column("text").to_pylist()]


def _least(table: pa.Table) -> pa.Table:
    """A bucket's answer: the smallest document of a window, for blocks that hold it in a larger one."""
    pairs = [np.frombuffer(k, np.uint64).reshape(-1, 2) for k in table.column("keys").to_pylist()]
    spans = [np.frombuffer(m, np.int64).reshape(-1, 2) for m in table.column("more").to_pylist()]
    pair, span = np.concatenate(pairs), np.concatenate(spans)
    order = np.lexsort((pair[:, 1], pair[:, 0]))
    sorted_ = pair[order]
    new = np.r_[True, (sorted_[1:] != sorted_[:-1]).any(axis=1)]
    least = np.empty(len(pair), np.int64)
    least[order] = np.minimum.reduceat(span[order, 0], np.flatnonzero(new))[np.cumsum(new) - 1]
    rows, start = [], 0
    for block, own in zip(table.column("block").to_pylist(), pairs):
        mine = slice(start, start + len(own))
        start += len(own)
        hit = least[mine] < span[mine, 1]
        if hit.any():
            rows.append((block, np.ascontiguousarray(own[hit, 0]).tobytes(), least[mine][hit].tobytes()))
    return pa.Table.from_batches([_table(rows, LEAST)], schema=LEAST)


def _marked(c: Cover, whole: bool):
    """Cogroup of a block with the smallest documents of its windows: what is left of each document."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import xxhash

        keys = np.frombuffer(b"".join(right.column("keys").to_pylist()), np.uint64)
        least = np.frombuffer(b"".join(right.column("least").to_pylist()), np.int64)
        order = np.argsort(keys, kind="stable")
        keys, least = keys[order], least[order]
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        one = Block([], [], c)
        for i, text in zip(*_documents(left)):
            words = WORDS.findall(text)
            gone = np.zeros(len(words), bool)
            if i is not None and len(words) >= c.window and len(keys):
                one.words = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").astype(np.uint64).reshape(-1, 2)
                h = one.runs(c.window, 0)
                spot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                start = np.flatnonzero((keys[spot] == h) & (least[spot] < i))
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + c.window, -1)
                gone = np.cumsum(edge)[:-1] > 0
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
            out["doc_id"].append(i)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if whole:
                out["kept"].append(kept.decode())
        cols = {"doc_id": pa.array(out["doc_id"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if whole:
            cols["kept"] = pa.array(out["kept"], pa.string())
        return pa.table(cols)
    return run


def dedup(docs: DataFrame, cover: Cover = Cover(), whole: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``, with
    ``whole`` also ``kept``, the words that are left, joined by one space."""
    blocks, buckets = _blocks(docs, cover)
    lists = "block int, bucket int, keys binary, more binary"
    by_block = blocks.groupBy("block")
    anchors = blocks.mapInArrow(_send_anchors(cover, buckets), lists)
    shared = anchors.groupBy("bucket").applyInArrow(_shared, "block int, bucket int, bits binary")
    windows = by_block.cogroup(shared.groupBy("block")).applyInArrow(_candidates(cover, buckets, buckets), lists)
    least = windows.groupBy("bucket").applyInArrow(_least, "block int, keys binary, least binary")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * whole
    return by_block.cogroup(least.groupBy("block")).applyInArrow(_marked(cover, whole), schema)


__all__ = ["Cover", "dedup", "Block"]
