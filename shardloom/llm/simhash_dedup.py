"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  All fingerprints within ``radius`` bits of each other are
linked:

1. Bits are grouped into parts by correlation (bit counts of *all*
   fingerprints), so that the uneven part values gather in few parts.
2. Part thresholds t_i with sum(t_i + 1) = radius + 1 guarantee that two
   fingerprints within the radius agree up to t_i bits in some part i (a part
   with t = -1 is not probed).  Dynamic programming picks the thresholds, and
   the number of parts, of least estimated cost (rows probed + candidates).
3. Each distinct fingerprint is probed once per way to mask t_i bits of part
   i; equal masked values form a bucket.  Buckets larger than ``cell`` are
   cut into chunks and every pair of chunks is compared in its own cell, so no
   task gets an unbounded bucket and no pair is lost.
4. Within a cell the distance of every pair is verified and a spanning forest
   of the true links is returned (not all pairs); components follow from it.

Defined results: a null or blank text has fingerprint 0 and links like any
other; a text with fewer words than a shingle hashes its whole word sequence;
repeated rows share fingerprint and component; rows without ``doc_id`` are
grouped too but never name a component that has an id; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved
from .components import connected_components

BITS = 64
SHINGLE = 4
RADIUS = 4
CELL = 256          # rows of a chunk of a bucket; a cell compares two chunks at most
ROW_COST = 400.0    # a probed row against a compared pair, in the cost estimate
PIECE = 1 << 18     # shingles counted at a time, bounds memory on very long texts


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned 64-bit integer."""
    import xxhash

    words = (text or "").encode().lower().split()   # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size) + np.arange(len(words))
    first = (ends - size)[:n].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, PIECE):
        h = np.fromiter((digest(joined[a:b]) for a, b in zip(first[at:at + PIECE], last[at:at + PIECE])),
                        np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "__llm_fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of column ``text``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(at).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


# --- parts and thresholds -----------------------------------------------------

def bit_counts(fps: DataFrame) -> np.ndarray:
    """64x64 counts of fingerprints with both bits set, over all rows of ``fps(fp)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = np.unpackbits(b.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").astype(np.float32)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel().astype(np.int64))],
            names=["cell", "n"])

    got = np.zeros(BITS * BITS)
    for cell, n in fps.select("fp").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        got[cell] = n          # 4,096 rows at any input size
    return got.reshape(BITS, BITS)


def bit_parts(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal width, correlated bits together."""
    p = np.diag(both) / max(total, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    link = np.abs(both / max(total, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(link, 0)
    left, groups = list(range(BITS)), []
    for i in range(parts):
        width = len(left) // (parts - i)
        group = [max(left, key=lambda b: (link[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (link[b, group].mean(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def near_share(agree: np.ndarray, most: int) -> list[float]:
    """Share of pairs that differ in at most 0..most of some bits, each bit
    agreeing with its own probability."""
    dist = np.zeros(most + 2)
    dist[0] = 1.0
    for a in agree:
        dist[1:] = dist[1:] * a + dist[:-1] * (1 - a)
        dist[0] *= a
    return list(np.cumsum(dist[:most + 1]))


def allocate(cost: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = radius + 1 and the least total
    cost; ``cost[i][t]`` is the cost of threshold t in part i (-1 costs none)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, radius + 1 - used):
                new = (c + (part[t] if t >= 0 else 0.0), [*ts, t])
                if used + t + 1 not in step or new[0] < step[used + t + 1][0]:
                    step[used + t + 1] = new
        best = step
    return best[radius + 1]


def plan_probes(both: np.ndarray, total: int, radius: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each probed part."""
    rows = max(total, 1024)     # of a tiny table, few probes matter more than few candidates
    p = np.diag(both) / max(total, 1)
    agree = p * p + (1 - p) * (1 - p)
    best = None
    for parts in range(2, radius + 3):
        groups = bit_parts(both, total, parts)
        cost = []
        for g in groups:
            share = near_share(agree[g], radius)
            cost.append([rows * comb(len(g), t) * ROW_COST + rows * rows / 2 * share[t] * comb(len(g), t)
                         if t <= len(g) else float("inf") for t in range(radius + 1)])
        found = allocate(cost, radius)
        if best is None or found[0] < best[0]:
            best = (*found, groups)
    return [(g, t) for g, t in zip(best[2], best[1]) if t >= 0]


def probe_masks(plan: list[tuple[list[int], int]]) -> list[int]:
    """One 64-bit mask (signed) per way to leave out t bits of a part."""
    out = []
    for bits, t in plan:
        for skip in combinations(bits, t):
            m = sum(1 << b for b in bits if b not in skip)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


# --- candidates and links -------------------------------------------------------

def _forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the values of one cell."""
    fp = np.unique(fp)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    left = np.ones(len(fp), bool)
    edges = []
    for root in range(len(fp)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            i = front.pop()
            new = np.flatnonzero(near[i] & left)
            left[new] = False
            edges += [(i, j) for j in new.tolist()]
            front += new.tolist()
    return [(int(fp[i]), int(fp[j])) for i, j in edges]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        names = ("mid", "key", "a", "b", "fp")

        def edges(cols, n):
            """Links of the whole cells in the first ``n`` rows."""
            cell = [c[:n] for c in cols[:4]]
            fp = cols[4][:n].view(np.uint64)
            new = np.ones(n, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in cell], axis=0)
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, n))
            src, dst = [], []
            two = starts[sizes == 2]              # most cells hold two values
            ok = np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius
            src += fp[two][ok].tolist()
            dst += fp[two + 1][ok].tolist()
            for s, z in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                for x, y in _forest(fp[s:s + z], radius):
                    src.append(x)
                    dst.append(y)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (src, dst)], names=["src", "dst"])

        for batch in batches:
            cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            n = len(cols[0])
            if not n:
                continue
            same = np.all([c == c[-1] for c in cols[:4]], axis=0)
            cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:                               # the last cell may go on in the next batch
                yield edges(cols, cut)
            carry = [c[cut:] for c in cols]
        if carry is not None and len(carry[0]):
            yield edges(carry, len(carry[0]))

    return run


def hamming_links(fps: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Edges ``(src, dst)`` that connect all values of ``fps(fp)`` (distinct)
    within ``radius`` bits of each other: a forest of each compared cell."""
    both = bit_counts(fps)
    total = fps.count()
    masks = F.array(*[F.lit(m).cast("bigint") for m in probe_masks(plan_probes(both, total, radius))])
    keys = fps.select("fp", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("mid", "key"))
    crowd = keys.groupBy("mid", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    rows = (keys.join(crowd, ["mid", "key"])
            .withColumn("c", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
            .withColumn("x", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("mid", "key", F.least("c", "x").alias("a"), F.greatest("c", "x").alias("b"), "fp"))
    cells = rows.repartition("mid", "key", "a", "b").sortWithinPartitions("mid", "key", "a", "b")
    return cells.mapInArrow(_links(radius), "src bigint, dst bigint").distinct()


def simhash_groups(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id, fp`` (signed) ``, component_id`` - the
    smallest ``doc_id`` reachable over links of at most ``radius`` bits."""
    ids = saved(with_fingerprint(docs.select("doc_id", "text"), shingle=shingle)
                .select("doc_id", F.col("__llm_fp").alias("fp")), "simhash-fp")
    return ids.join(fingerprint_groups(ids, radius), "fp").select("doc_id", "fp", "component_id")


def fingerprint_groups(ids: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, component, component_id)`` for each distinct fingerprint of ``ids(doc_id, fp)``: its
    group, named by a fingerprint, and the smallest id in it (which two groups share where rows
    of one id hold unrelated texts)."""
    classes = saved(ids.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    comp = connected_components(hamming_links(classes.select("fp"), radius))
    labelled = (classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    labelled = saved(labelled, "simhash-labels")
    lowest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    return labelled.join(lowest, "component").select("fp", "component", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id, rows without id
    last, and the first of rows that share it.  Rows of one id whose texts are not near
    are in groups of their own, and each group keeps one."""
    cols = docs.columns
    marked = saved(with_fingerprint(docs, shingle=shingle).withColumn("__llm_uid", F.monotonically_increasing_id()), "simhash-docs")
    ids = marked.select("doc_id", F.col("__llm_fp").alias("fp"), F.col("__llm_uid").alias("uid"))
    groups = fingerprint_groups(ids, radius).select("fp", "component")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("idless"), "doc_id", "uid"))
    won = ids.join(groups, "fp").groupBy("component").agg(first.alias("w")).select(F.col("w.uid").alias("__llm_uid"))
    return marked.join(won, "__llm_uid", "left_semi").select(*cols)


__all__ = ["fingerprint", "with_fingerprint", "bit_counts", "bit_parts", "near_share", "allocate", "plan_probes",
           "probe_masks", "hamming_links", "simhash_groups", "fingerprint_groups", "keep_one"]
