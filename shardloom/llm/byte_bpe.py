"""Byte-level BPE by a shuffle of distinct words.

1. Documents are cut into pre-tokens (each match of ``pattern``) and dealt to
   blocks of about ``block_bytes`` of text; a document's pre-tokens stay in
   order, which is their position.
2. Each block lists its distinct pre-tokens once, sorted, by word bucket (a
   hash of the word).  The lists are dealt by bucket, so the tokenizer runs
   once per distinct word of the corpus.  There are half as many buckets as blocks.
3. A bucket's ids go back to the block in the order of its list; the block
   rebuilds the lists, so words need not travel back, and reassembles every
   document by position.  A frequent word stands once in a block's list,
   however often it occurs.
4. Decoding looks each id up in the token-byte table, which the vocabulary
   file bounds, and joins the bytes.

Defined results: a null or empty text has no tokens; a text of any length is encoded
whole (it must fit a task's memory several times over); repeated rows are encoded
each; rows without ``doc_id`` are kept; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
SEP, SEP_BYTE = "\udcff", b"\xff"        # a byte that UTF-8 never holds

# Letters, numbers and white space below U+0250, where the
# faster standard matcher gives the same matches as the Unicode classes.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = "\t-\r \x85\xa0"


@lru_cache(maxsize=4)
def splitter(pattern: str):
    """``text -> list of pre-tokens`` for a pattern of \\p{L}, \\p{N}, \\s and \\S classes."""
    import regex

    plain = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACES}{LETTERS}{NUMBERS}]")
                       .replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", f"[{NUMBERS}]")
                       .replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]"))
    full = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    beyond = re.compile("[^\x00-ɏ]")
    return lambda text: (full if beyond.search(text) else plain).findall(text)


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 token, rank per line)."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(data), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(data: bytes) -> list[bytes]:
    """The token-byte table, by id."""
    ranks = load_ranks(data)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for t, r in ranks.items():
        table[r] = t
    return table


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids.tolist()])


def _blocks(docs: DataFrame, pattern: str, block_bytes: int) -> tuple[DataFrame, int]:
    """``(block, doc_id, words)``: compressed pre-tokens, dealt by block; and the number of blocks."""
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = int(total // block_bytes) + 1
    # the input partition salts ids that many rows share (or lack)
    block = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(n)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        split, pack = splitter(pattern), zstandard.ZstdCompressor(level=3)
        for b in batches:
            words = [pack.compress(SEP.join(split(t or "")).encode("utf-8", "surrogateescape")) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.binary())], names=["block", "doc_id", "words"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select(block.alias("block"), "doc_id", "text").mapInArrow(run, f"block int, doc_id {id_type}, words binary")
            .repartition("block").sortWithinPartitions("block")), n


def _unpack(data: bytes, d) -> list[bytes]:
    text = d.decompress(data)
    return text.split(SEP_BYTE) if text else []


def _by_bucket(words: set[bytes], buckets: int) -> dict[int, list[bytes]]:
    """The words of a block, sorted, by bucket."""
    out: dict[int, list[bytes]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w) % buckets, []).append(w)
    return out


def _distinct_words(buckets: int):
    """``(block, bucket, list)`` of each block's distinct words; the input is sorted by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        d, pack, at, words = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3), None, set()

        def rows():
            lists = _by_bucket(words, buckets)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lists), at, np.int32)), pa.array(list(lists), pa.int32()),
                 pa.array([pack.compress(SEP_BYTE.join(x)) for x in lists.values()], pa.binary())], names=["block", "bucket", "list"])

        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if block != at:
                    if words:
                        yield rows()
                    at, words = block, set()
                words.update(_unpack(data, d))
        if words:
            yield rows()
    return run


def _encode_lists(data, pattern: str, kind: str):
    """The ids of each list, in its order; the input is sorted by bucket, and a
    word of a bucket is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        d, pack, encode = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3), _encoder(data.value, pattern).encode_ordinary
        at, known = None, {}
        for b in batches:
            out = []
            for bucket, packed in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if bucket != at:
                    at, known = bucket, {}
                ids = []
                for w in _unpack(packed, d):
                    if w not in known:
                        known[w] = encode(w.decode())
                    ids.append(known[w])
                size = np.array([len(x) for x in ids], "<u4")
                out.append(pack.compress(size.tobytes() + np.array([i for x in ids for i in x], kind).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["block", "bucket", "ids"])
    return run


def _ids_of_words(lists: dict[int, list[bytes]], coded: dict[int, bytes], width: int) -> dict[bytes, bytes]:
    """Id bytes of each word from the lists of a block and what their buckets sent."""
    out: dict[bytes, bytes] = {}
    for bucket, words in lists.items():
        data = coded[bucket]
        ends = np.cumsum(np.frombuffer(data, "<u4", len(words)), dtype=np.int64) * width + 4 * len(words)
        start = 4 * len(words)
        for w, end in zip(words, ends.tolist()):
            out[w] = data[start:end]
            start = end
    return out


def encode(docs: DataFrame, ranks: bytes, pattern: str, whole: bool = False, block_bytes: int = BLOCK_BYTES,
           decoded: bool = True) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``,
    with ``whole`` also ``ids`` (array<int>) and, unless ``decoded`` is false,
    ``decoded`` (binary).

    ``ranks`` is the content of a rank file, ``pattern`` its pre-token pattern.
    A block's whole output is one batch, so its ids are gathered in one buffer.
    """
    data = docs.sparkSession.sparkContext.broadcast(ranks)      # bounded by the vocabulary
    kind = "<u2" if len(token_bytes(ranks)) <= 1 << 16 else "<u4"
    blocks, n = _blocks(docs, pattern, block_bytes)
    buckets, keep_text = n // 2 + 1, whole and decoded
    lists = blocks.mapInArrow(_distinct_words(buckets), "block int, bucket int, list binary")
    coded = (lists.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_encode_lists(data, pattern, kind), "block int, bucket int, ids binary"))

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        d, table = zstandard.ZstdDecompressor(), token_bytes(data.value)
        packed_docs = left.column("words").to_pylist()
        words: set[bytes] = set()
        for packed in packed_docs:
            words.update(_unpack(packed, d))
        coded_ids = {k: d.decompress(v) for k, v in zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist())}
        ids_of = _ids_of_words(_by_bucket(words, buckets), coded_ids, np.dtype(kind).itemsize).__getitem__
        out = {"doc_id": left.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "decoded": []}
        gathered = bytearray()          # 4 bytes an id, all documents of the block
        for packed in packed_docs:
            ids = np.frombuffer(b"".join(map(ids_of, _unpack(packed, d))), kind).astype("<u4")
            text = decode_ids(ids, table)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(text).hexdigest())
            if whole:
                gathered += ids.tobytes()
            if keep_text:
                out["decoded"].append(text)
        cols = {"doc_id": out["doc_id"], "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                "ids_sha256": pa.array(out["ids_sha256"], pa.string()), "decoded_sha256": pa.array(out["decoded_sha256"], pa.string())}
        if whole:
            ends = pa.array(np.concatenate([[0], np.cumsum(out["n_tokens"])]).astype(np.int32))
            cols["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(gathered, np.int32)))
        if keep_text:
            cols["decoded"] = pa.array(out["decoded"], pa.binary())
        return pa.table(cols)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * whole + ", decoded binary" * keep_text
    return blocks.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(reassemble, schema)


__all__ = ["BLOCK_BYTES", "splitter", "load_ranks", "token_bytes", "decode_ids", "encode"]
