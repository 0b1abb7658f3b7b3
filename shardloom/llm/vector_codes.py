"""Vector code compression: product quantisation by Lloyd rounds, with norm-of-sum bounds.

A vector of whole numbers ``floor(scale * x)`` is cut into ``parts`` equal parts;
each part position has a codebook of ``entries`` entries, and the code of a vector
is the index of the nearest entry of each part.  A round assigns every part and
then moves every entry to the floor of the mean of its parts.

Most parts stay with their entry, so a round avoids the scan of the codebook where
bounds settle the matter.  Kept with each part are

* its entry, an upper bound of the distance to it, and the round of that bound;
* a lower bound of the distance to every other entry, and the round of that bound.

All earlier codebooks are kept too (the history: ``rounds`` times the codebook size).
In round ``t`` a bound of round ``s`` is moved by the *net* displacement of an entry,
the norm of the sum of its moves ``|c(t) - c(s)|``, instead of the sum of the norms of
the single moves, which is never smaller.  Only if the moved bounds overlap is the
distance to the own entry taken exactly, and only if that does not part them is the
codebook scanned; a bound that is taken anew carries the new round as its stamp.

One pass over the table a round: the bounds travel with the vector, each Arrow batch
adds its exact sums and counts in one of its rows, and Spark adds those up; the driver
sees one codebook of sums.  The table of a round is written to the shared scratch
folder, and the one before it is removed.

All arithmetic is exact: squared distances in double precision where they are whole
numbers below 2^53, in unbounded integers otherwise (such parts are always scanned).

Defined results: rows whose vector is null or holds null or non-finite components are
left out; a vector of another length than the most frequent one has null ``code`` and
``error``; components beyond +-2^53 after scaling are cut there; errors beyond a long
are the largest long; a length that ``parts`` does not divide is cut at
``i * length // parts``; rows without id come after all others; rows that share an id
are ordered by their vector, and each is coded; fewer rows than ``entries`` make fewer
entries; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import WHOLE, common_length, finite, matrix, remove, total_by_position, whole_numbers, written


@dataclass(frozen=True)
class Coding:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


LARGEST = 2 ** 63 - 1
CUT = float(2 ** 53)
SLACK = 1e-12            # relative; covers the rounding of the bounds' arithmetic
BOUND = np.dtype([("upper", "<f4"), ("lower", "<f4"), ("upper_round", "u1"), ("lower_round", "u1")])


def scaled(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as doubles that are whole numbers."""
    return np.clip(np.floor(matrix(column, dim) * scale), -CUT, CUT)


def cuts(dim: int, parts: int) -> list[slice]:
    return [slice(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(0))


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every entry; exact for both number kinds."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None, :]


class History:
    """The codebooks of one part position by round, and how far entries moved since."""

    def __init__(self, books: list[list[list[int]]], width: int):
        self.whole = [np.array(b, dtype=object).reshape(len(b), width) for b in books]
        self.books = [b.astype(np.float64) for b in self.whole]
        self.now, self.t = self.books[-1], len(books) - 1
        self.reach = max((float(np.abs(b).max(initial=0)) for b in self.books), default=0.0)
        # the sum of ``width`` squares of differences stays a whole double
        self.limit = float(np.sqrt(2.0 ** 53 / (4 * max(width, 1))))
        moved = np.stack([np.sqrt(((self.now - b) ** 2).sum(axis=1)) for b in self.books])
        self.own = moved                                       # [round of the bound, entry]
        order = np.sort(moved, axis=1)
        most, next_ = order[:, -1:], (order[:, -2:-1] if moved.shape[1] > 1 else np.zeros((len(moved), 1)))
        first = moved.argmax(axis=1)[:, None]
        self.others = np.where(np.arange(moved.shape[1]) == first, next_, most)   # the largest move among the other entries


def assign_part(x: np.ndarray, h: History, code: np.ndarray | None, bound: np.ndarray | None):
    """``(codes, bounds, scanned)`` of one part of every row against the newest codebook."""
    n, k = len(x), len(h.now)
    if max(np.abs(x).max(initial=0), h.reach) >= h.limit:
        whole = np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
        squares = _squares(whole, h.whole[-1])
        code = np.array([min(range(k), key=row.__getitem__) for row in squares.tolist()], np.uint8)
        bound = np.zeros(n, BOUND)
        bound["upper"], bound["upper_round"], bound["lower_round"] = np.inf, h.t, h.t
        return code, bound, np.ones(n, bool)
    if code is None:
        code, bound, scan = np.zeros(n, np.uint8), np.zeros(n, BOUND), np.arange(n)
    else:
        code, bound = code.copy(), bound.copy()
        upper = bound["upper"].astype(np.float64) + h.own[bound["upper_round"], code]
        lower = (bound["lower"].astype(np.float64) - h.others[bound["lower_round"], code]) * (1 - SLACK)
        open_ = np.flatnonzero(~(upper * (1 + SLACK) < lower))
        exact = np.sqrt(((x[open_] - h.now[code[open_]]) ** 2).sum(axis=1))
        bound["upper"][open_], bound["upper_round"][open_] = _up(exact), h.t
        scan = open_[~(exact * (1 + SLACK) < lower[open_])]
    squares = _squares(x[scan], h.now)
    best = squares.argmin(axis=1)                             # the first of equal ones
    rows = np.arange(len(scan))
    least = squares[rows, best]
    squares[rows, best] = np.inf
    code[scan] = best
    bound["upper"][scan], bound["lower"][scan] = _up(np.sqrt(least)), _down(np.sqrt(squares.min(axis=1, initial=np.inf)))
    bound["upper_round"][scan] = bound["lower_round"][scan] = h.t
    scanned = np.zeros(n, bool)
    scanned[scan] = True
    return code, bound, scanned


def _bytes(column: np.ndarray) -> pa.Array:
    """Fixed-width rows as binary values."""
    rows = np.ascontiguousarray(column)
    width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _from_bytes(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _round(books: list[list[list[list[int]]]], dim: int, c: Coding, first: bool):
    """A round's pass: rows with their vector, code, bounds, scans; sums and counts in the last row of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cuts(dim, c.parts)
        past = [History([b[p] for b in books], s.stop - s.start) for p, s in enumerate(at)]
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = scaled(b.column("vector"), dim, c.scale)
            code, bound, scans = _assign(b, x, at, past, c, first)
            k = len(past[0].now)
            sums: list[int] = []
            for p, s in enumerate(at):
                own = (code[:, p][:, None] == np.arange(k)).astype(np.float64)
                small = np.abs(x[:, s]).max(initial=0) * n < CUT
                total = own.T @ x[:, s] if small else _exact_sums(x[:, s], code[:, p], k)
                sums += [int(v) for v in np.concatenate([own.sum(axis=0), np.ravel(total)])]
            rest = pa.concat_arrays([pa.nulls(n - 1, WHOLE), whole_numbers(sums)])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("vector"), _bytes(code), _bytes(bound), pa.array(scans, pa.int32()), rest],
                names=["id", "label", "vector", "code", "bound", "scans", "sums"])
    return run


def _exact_sums(x: np.ndarray, code: np.ndarray, k: int) -> list[int]:
    return [sum(int(v) for v in x[code == j, i]) for j in range(k) for i in range(x.shape[1])]


def _assign(b: pa.RecordBatch, x: np.ndarray, at: list[slice], past: list[History], c: Coding, first: bool):
    code, bound = np.empty((len(x), c.parts), np.uint8), np.empty((len(x), c.parts), BOUND)
    scans = np.zeros(len(x), np.int32) if first else b.column("scans").to_numpy(zero_copy_only=False).copy()
    if not first:
        old_code, old_bound = _from_bytes(b.column("code"), np.uint8, c.parts), _from_bytes(b.column("bound"), BOUND, c.parts)
    for p, s in enumerate(at):
        given = (None, None) if first else (old_code[:, p], old_bound[:, p])
        code[:, p], bound[:, p], scanned = assign_part(x[:, s], past[p], *given)
        scans += scanned
    return code, bound, scans


def _last(books: list[list[list[list[int]]]], dim: int, c: Coding, first: bool):
    """The final assignment: code as text, error, scans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cuts(dim, c.parts)
        past = [History([b[p] for b in books], s.stop - s.start) for p, s in enumerate(at)]
        for b in batches:
            x = scaled(b.column("vector"), dim, c.scale)
            code, _, scans = _assign(b, x, at, past, c, first)
            error = [0] * len(x)
            for p, s in enumerate(at):
                h = past[p]
                if max(np.abs(x[:, s]).max(initial=0), h.reach) < h.limit:
                    own = ((x[:, s] - h.now[code[:, p]]) ** 2).sum(axis=1).astype(np.int64).tolist()
                else:
                    own = [sum((int(a) - e) ** 2 for a, e in zip(row, h.whole[-1][j])) for row, j in zip(x[:, s], code[:, p])]
                error = [a + e for a, e in zip(error, own)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([bytes(row).hex() for row in code], pa.string()),
                 pa.array([min(e, LARGEST) for e in error], pa.int64()), pa.array(scans, pa.int32())],
                names=["id", "label", "code", "error", "scans"])
    return run


def books_sha256(book: list[list[list[int]]]) -> str:
    """Digest of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for part in book for e in part for v in e).encode()).hexdigest()


def _moved(book: list[list[list[int]]], sums: list[int], dim: int, c: Coding) -> list[list[list[int]]]:
    """The codebook after a round: floors of means; an entry without parts stays."""
    out, at = [], 0
    for p, s in enumerate(cuts(dim, c.parts)):
        k, width = len(book[p]), s.stop - s.start
        counts, totals = sums[at:at + k], sums[at + k:at + k + k * width]
        at += k + k * width
        out.append([[totals[j * width + i] // counts[j] for i in range(width)] if counts[j] else book[p][j] for j in range(k)])
    return out


def compress(vectors: DataFrame, coding: Coding = Coding(), id_column: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """``(id, label, code, error, scans)`` of every usable row, and the final codebooks by part and entry.

    ``code`` is two hex digits a part, ``error`` the sum of squared distances,
    ``scans`` how many parts were compared with a whole codebook over all rounds
    (without bounds: ``parts * (rounds + 1)``).
    """
    spark = vectors.sparkSession
    rows = vectors.where(finite(vector)).select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    done = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint, scans int"
    dim = common_length(rows, "vector")
    if dim is None:
        return spark.createDataFrame([], done), []
    other = rows.where(F.size("vector") != dim).selectExpr("id", "label", "CAST(NULL AS string) code", "CAST(NULL AS bigint) error", "CAST(NULL AS int) scans")
    now, path = rows.where(F.size("vector") == dim), None
    seeds = now.orderBy(F.col("id").asc_nulls_last(), "vector").limit(coding.entries).select("vector").toArrow()
    start = scaled(seeds.column("vector").combine_chunks(), dim, coding.scale)
    books = [[[[int(v) for v in row[s]] for row in start] for s in cuts(dim, coding.parts)]]
    state = f"id {kinds['id']}, label {kinds['label']}, vector {kinds['vector']}, code binary, bound binary, scans int, sums array<decimal(38,0)>"
    for t in range(coding.rounds):
        now, new = written(now.mapInArrow(_round(list(books), dim, coding, t == 0), state), "vector-codes")
        if path:
            remove(spark, path)
        path = new
        books.append(_moved(books[-1], total_by_position(now, "sums"), dim, coding))
    coded, _ = written(now.mapInArrow(_last(list(books), dim, coding, coding.rounds == 0), done), "vector-codes")
    if path:
        remove(spark, path)
    return coded.unionByName(other), books[-1]


def decompress(coded: DataFrame, books: list[list[list[int]]], coding: Coding = Coding()) -> DataFrame:
    """``coded`` with ``approximate``: the middle of the cell of every part's entry."""
    table = F.array(*[F.array(*[F.array(*[F.lit((v + 0.5) / coding.scale) for v in e]) for e in part]) for part in books])
    picked = [F.get(F.get(table, p), F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")) for p in range(len(books))]
    return coded.withColumn("approximate", F.when(F.col("code").isNotNull(), F.concat(*picked)))


def code_report(vectors: DataFrame, coding: Coding = Coding(), id_column: str = "vec_id", vector: str = "embedding",
                label: str = "label") -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256, scans)``: a label's error is the
    sum over its rows (null labels together), added up before it is joined on."""
    coded, books = compress(vectors, coding, id_column, vector, label)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    sums = sums.select(F.col("label").alias("of"), F.least("s", F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_column), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"), "scans"))


__all__ = ["Coding", "compress", "decompress", "code_report", "books_sha256", "assign_part", "History"]
