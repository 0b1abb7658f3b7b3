"""Embedding near-duplicates by a forest of random-projection trees.

1. Equal vectors become one class with a count; tasks scale them to length 1.
2. ``trees`` trees split the classes by random hyperplanes at the median of the
   projections.  Classes within a margin of the median go down both sides
   (spill), so a close pair is rarely parted; the margin is the larger of a share
   of the members and half the step along the plane of a pair of cosine
   ``least``.  The first splits are fitted on a bounded sample (``sample``
   classes, chosen by hash) and sent to the tasks; they deal the vectors out to
   buckets.  A bucket is one task's: it splits its members on in memory, by planes
   fitted on them, and compares the classes of a leaf with each other.
   So only the first splits copy vectors on disk.  A pass moves one tree, or a
   part of its buckets, at most about twice the table; its shuffle is dropped when
   it is done, and only edges that join what links join go on.
3. Components follow from the edges.  A link joins two members of a component, so
   the links of a class are counted within its component, each pair once: whole
   components side by side in a task, large ones as pairs of chunks.  A component
   of more than ``whole`` classes of which under ``tight`` of the pairs are links
   is not compared whole, but by leaves of a forest of its own (below).
4. Pairs of cosine ``least`` or more in double precision are links: single
   precision decides where its error cannot matter, double precision the rest.

Near copies: a split where ``tight`` of the sampled pairs or more are links stands
across the direction of the densest group, so wide of it that no link is parted,
and takes that group out.  Where that does not part the members (they are near
copies of each other), a bucket splits them by shares alone, for a group is joined by
any few of its links.

Leaves of a large component that holds few links for its size: the vectors of
its members are routed, leaves larger than four times ``leaf`` are split again,
round by round, each by a subtree fitted on a bounded sample of its own members;
groups of near copies stay whole.  A large leaf is cut into chunks and each pair of
chunks compared in a task of its own.  A link is counted in one leaf only, the
first by hash of those that hold both ends, so the counts add up without a row per
link.

Every vector is routed through every tree; a pair is missed only if all trees
part it and nothing else joins its ends.  Defined results: a vector that is null, empty, zero, or holds null or
non-finite components links with nothing; vectors of different length do not
link; repeated vectors link with each other; rows that share a ``vec_id`` are
separate vectors of one name; a row without ``vec_id`` counts as a link but
names no component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import build_conf
from .common import saved
from .components import connected_components


@dataclass(frozen=True)
class Forest:
    least: float = 0.9        # cosine of a link
    trees: int = 8
    leaf: int = 512           # classes of a leaf, without spill; one is split again, or compared in chunks, beyond four times that
    spill: float = 0.08       # share of a node's members beyond the median that go to the other side too
    sample: int = 16384       # classes the first splits are fitted on
    local: int = 2048         # expected sample of a leaf that is split again
    tight: float = 0.05       # share of links among the pairs of a node at which it is not split
    rounds: int = 8           # further rounds of splits at most
    whole: int = 16384        # classes of a component that one task compares whole
    seed: int = 42


# Every step writes a table; the shuffles before it are dropped then, not at the end of the session.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# --- trees: arrays of planes and thresholds, children of node i at 2i + 1 and 2i + 2 ----

PROBE = 512      # members of a node whose pairs tell how tight it is
GLANCE = 128     # the same where a wrong guess parts near copies that other links join


def link_share(x: np.ndarray, least: float, rng: np.random.Generator, probe: int = PROBE) -> tuple[float, np.ndarray]:
    """Share of links among the pairs of at most ``probe`` members drawn from ``x``, and the
    direction of the one with most links and those it links with."""
    if len(x) > probe:
        x = x[rng.choice(len(x), probe, replace=False)]
    links = x @ x.T >= least
    pairs = len(x) * (len(x) - 1)
    centre = x[links[links.sum(axis=1).argmax()]].sum(axis=0)
    return (float((links.sum() - len(x)) / pairs) if pairs else 0.0), centre / max(float(np.linalg.norm(centre)), 1e-9)


def ball_cut(p: np.ndarray, least: float) -> tuple[float, float, float] | None:
    """Thresholds along the direction of a dense group, for projections ``p`` of unit vectors, that
    leave the group on one side and part no link: linked vectors differ by at most
    ``sqrt(2 - 2 * least)`` along any direction, and those within half of that go to both sides.
    ``None`` if that takes out too few or sends more than a tenth to both sides."""
    half = float(np.sqrt(max(0.0, 2 - 2 * least))) / 2 + 1e-6
    low, high = least - 2 * half, least
    both, outside = np.mean((p >= low) & (p < high)), np.mean(p < low)
    return (low, least - half, high) if both <= 0.1 and outside >= 0.1 else None


def fit_tree(x: np.ndarray, depth: int, forest: Forest, seed, part_copies: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Planes and (low, median, high) thresholds of a full binary tree on sample
    ``x``; a node of near copies alone sends all to its left child, or parts them at
    the median with a spill by shares (``part_copies``)."""
    n = (1 << depth) - 1
    rng = np.random.default_rng(seed)
    half = np.sqrt(max(0.0, 2 - 2 * forest.least) / x.shape[1]) / 2
    planes = rng.standard_normal((n, x.shape[1])).astype(np.float32)
    cuts = np.zeros((n, 3), np.float32)
    members = {0: np.arange(len(x))}
    for i in range(n):
        own = members.pop(i, np.empty(0, int))
        if not len(own):
            continue
        y = x[own]
        share, centre = link_share(y, forest.least, rng, GLANCE if part_copies else PROBE)
        ball = ball_cut(y @ centre, forest.least) if share >= forest.tight else None
        if ball or share >= forest.tight and not part_copies:
            planes[i] = centre
            p = y @ planes[i]
            cuts[i] = ball or (np.inf,) * 3
        else:
            p = y @ planes[i]
            low, mid, high = np.quantile(p, [0.5 - forest.spill, 0.5, 0.5 + forest.spill])
            step = half * np.linalg.norm(planes[i])
            wide = min(low, mid - step), mid, max(high, mid + step)
            cuts[i] = (low, mid, high) if part_copies and (share >= forest.tight or np.mean((p >= wide[0]) & (p < wide[2])) > 0.5) else wide
        if 2 * i + 1 < n:
            left = np.ones(len(own), bool) if np.isinf(cuts[i][1]) else p < cuts[i][1]
            members[2 * i + 1], members[2 * i + 2] = own[left], own[~left]
    return planes, cuts


def leaves_of(x: np.ndarray, planes: np.ndarray, cuts: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``(leaf, rows)`` of every leaf that rows of ``x`` fall in, in order."""
    nodes = [(0, np.arange(len(x)))] if len(x) else []
    for _ in range(int(log2(len(planes) + 1))):
        below = []
        for node, own in nodes:
            p = np.empty(len(own), np.float32)
            for lo in range(0, len(own), 1 << 15):          # bounds memory
                p[lo:lo + (1 << 15)] = x[own[lo:lo + (1 << 15)]] @ planes[node]
            low, _, high = cuts[node]
            left, right = own[p < high], own[p >= low]      # both between the two cuts
            below += [(child, rows) for child, rows in ((2 * node + 1, left), (2 * node + 2, right)) if len(rows)]
        nodes = below
    return [(node - len(planes), own) for node, own in nodes]


def route(x: np.ndarray, planes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, leaf)`` of every leaf each row of ``x`` falls in."""
    found = leaves_of(x, planes, cuts)
    rows = np.concatenate([np.empty(0, int), *(own for _, own in found)])
    return rows, np.repeat(np.array([leaf for leaf, _ in found], np.int64), [len(own) for _, own in found])


def _vectors(column, dim: int) -> np.ndarray:
    """The packed vectors of a column (of one length, none null), one a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32, len(column) + 1, 4 * column.offset) if len(column) else np.zeros(1, np.int32)
    width = int(ends[-1] - ends[0]) // max(1, len(column) * dim) or 8
    return np.frombuffer(data or b"", f"<f{width}", len(column) * dim, int(ends[0])).reshape(-1, dim)


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)       # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _singles(x: np.ndarray) -> np.ndarray:
    """The same in single precision, made piece by piece."""
    out = np.empty(x.shape, np.float32)
    for lo in range(0, len(x), 8192):
        out[lo:lo + 8192] = _units(x[lo:lo + 8192])
    return out


# --- classes -----------------------------------------------------------------------

def _packed(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec``: the components as bytes, null where the vector cannot link."""
    kind = "float" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    dtype = np.dtype("<f4" if kind == "float" else "<f8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("embedding")
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype) + dtype.type(0)      # no negative zero; a null component is NaN
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(size)
            count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.concatenate([[0], end])])
            good = (size > 0) & (count(~np.isfinite(x)) == 0) & (count(x != 0) > 0)
            ends = np.concatenate([[0], np.cumsum(np.where(good, size, 0))]) * dtype.itemsize
            data = np.ascontiguousarray(x[np.repeat(good, size)])
            vec = pa.Array.from_buffers(pa.large_binary(), len(good), [pa.py_buffer(np.packbits(good, bitorder="little")), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), vec.cast(pa.binary())], names=["vec_id", "vec"])

    own = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return own.mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, vec binary")


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows(vec_id, vec)`` with a null ``vec`` where it cannot link, and
    ``classes(class, dim, vec, size, rep)`` of equal vectors; ``vec`` holds the components' bytes."""
    rows = _packed(vectors)
    width = 4 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else 8
    classes = rows.where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("rep"))
    dim = (F.length("vec") / width).cast("int").alias("dim")
    return rows, saved(classes.select(F.monotonically_increasing_id().alias("class"), dim, "vec", "size", "rep"), "embedding-classes")


# --- edges: buckets of the first splits, leaves in memory -----------------------------

MOST = 4096          # members of a leaf compared at once


def _slack(dim: int) -> float:
    """More than single precision can be off in a cosine."""
    return 1e-7 * (dim + 4)


def _hits(x: np.ndarray, y: np.ndarray, exact, least: float) -> np.ndarray:
    """Links between the rows of ``x`` and ``y`` (single precision); ``exact(i, j)`` are their
    cosines in double precision, asked for where single precision cannot tell."""
    s, slack = x @ y.T, _slack(x.shape[1])
    hits = s >= least - slack
    close = s < least + slack
    close &= hits
    if close.any():
        i, j = divmod(np.flatnonzero(close), len(y))
        hits[i, j] = exact(i, j) >= least
    return hits


def _linked(x: np.ndarray, least: float) -> np.ndarray:
    """Whether a row of ``x`` may link with another one: each pair is looked at once."""
    on, turned = np.zeros(len(x), bool), np.ascontiguousarray(x.T)
    for lo in range(0, len(x), 128):
        hits = x[lo:lo + 128] @ turned[:, lo:] >= least - _slack(x.shape[1])
        np.fill_diagonal(hits, False)
        if hits.any():
            on[lo:lo + 128] |= hits.any(axis=1)
            on[lo:] |= hits.any(axis=0)
    return on


def _exact(vectors: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Cosines in double precision of ``vectors[left[i]]`` and ``vectors[right[j]]``."""
    def told(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i))
        for lo in range(0, len(i), 8192):
            a, b = (_units(vectors[k[lo:lo + 8192]]) for k in (left[i], right[j]))
            out[lo:lo + 8192] = np.einsum("ij,ij->i", a, b)
        return out
    return told


def _reached(x: np.ndarray, own: np.ndarray, vectors: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links among the members ``own`` join: from the first of a component to
    the others.  Members are compared with those that are not reached yet only."""
    left, src, dst = own, [own[:0]], [own[:0]]
    while len(left) > 1:
        front, left, start = left[:1], left[1:], left[0]
        while len(front) and len(left):
            found = np.zeros(len(left), bool)
            for lo in range(0, len(front), 1024):
                part, rest = front[lo:lo + 1024], np.flatnonzero(~found)
                found[rest] = _hits(x[part], x[left[rest]], _exact(vectors, part, left[rest]), least).any(axis=0)
            front, left = left[found], left[~found]
            src.append(np.full(len(front), start))
            dst.append(front)
    return np.concatenate(src), np.concatenate(dst)


def _joined(hits: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, from the links of the members ``own`` as a matrix, its diagonal set."""
    at = np.flatnonzero(hits)
    if len(at) <= 16 * len(own):                       # few links: all of them
        i, j = divmod(at, len(own))
        return own[i[i < j]], own[j[i < j]]
    todo, src, dst = np.count_nonzero(hits, axis=1) > 1, [own[:0]], [own[:0]]
    for i in np.flatnonzero(todo):
        if todo[i]:
            got = hits[i].copy()
            front = got.copy()
            front[i] = False
            while front.any():
                front = hits[front].any(axis=0) & ~got
                got |= front
            todo[got] = False
            others = np.flatnonzero(got)
            src.append(np.full(len(others), own[i]))
            dst.append(own[others])
    return np.concatenate(src), np.concatenate(dst)


def _depth(n: float, least: float, share: float) -> int:
    """Splits, each leaving ``share`` of the members on a side, until no more than ``least`` are left."""
    return max(0, ceil(log(max(n, 1) / least) / -log(share)))


def bucket_edges(vectors: np.ndarray, forest: Forest, seed) -> tuple[np.ndarray, np.ndarray]:
    """``(i, j)``: edges that join what the links found among the vectors of one bucket join."""
    x = _singles(vectors)
    rng = np.random.default_rng(seed)
    depth = _depth(len(x), 2 * forest.leaf, 0.5 + forest.spill)
    some = x if len(x) <= 2 * forest.sample else x[rng.choice(len(x), 2 * forest.sample, replace=False)]
    src, dst = [], []
    for _, own in leaves_of(x, *fit_tree(some, depth, forest, seed, part_copies=True)):
        if len(own) > MOST:
            i, j = _reached(x, own, vectors, forest.least)
        else:
            own = own[_linked(x[own], forest.least)]   # most members link with none
            if not len(own):
                continue
            y = x[own]
            hits = _hits(y, y, _exact(vectors, own, own), forest.least)
            np.fill_diagonal(hits, True)
            i, j = _joined(hits, own)
        src.append(i)
        dst.append(j)
    label = np.arange(len(x))
    if src:
        label = _join(label, np.concatenate(src), np.concatenate(dst))
    on = np.flatnonzero(label != np.arange(len(x)))
    return on, label[on]


def _passes(reps: list[float], count: int) -> list[list[tuple[int, int, int]]]:
    """``(tree, part, parts)`` of each pass: trees, or parts of one tree's buckets, that move about
    twice the classes or a million rows together."""
    room, out, used = max(2 * count, 1 << 20), [], 0.0
    for tree, rep in enumerate(reps):
        parts = ceil(rep * count / room)
        for part in range(parts):
            if not out or used + rep * count / parts > room:
                out.append([])
                used = 0.0
            out[-1].append((tree, part, parts))
            used += rep * count / parts
    return out


RUN = 1 << 15        # classes that are dealt out to buckets together


def _edges(classes: DataFrame, forest: Forest, dim: int, width: int, count: int) -> DataFrame:
    """``(src, dst)`` of classes of one dimension (components of ``width`` bytes): edges that join what links join."""
    depth = max(0, ceil(log2(count / (128 * forest.leaf))), min(3, int(log2(max(1, count / (8 * forest.leaf))))))
    depth = min(depth, int(log2(forest.sample)) - 4)             # 16 or more sample points a bucket
    number = forest.trees if count > 2 * forest.leaf else 1     # one leaf holds them all
    if depth:
        share = min(1.0, forest.sample / count)
        picked = classes.where(F.pmod(F.xxhash64("class", F.lit(forest.seed)), F.lit(1_000_000)) < int(1_000_000 * share)).select("vec").toArrow()
        x = _singles(_vectors(picked.column("vec"), dim))        # ``sample`` rows are expected at any input size
        trees = [fit_tree(x, depth, forest, forest.seed + t, part_copies=True) for t in range(number)]
        reps = [len(route(x, *tree)[0]) / len(x) for tree in trees]
    else:
        trees, reps = [(np.empty((0, dim), np.float32), np.empty((0, 3), np.float32))] * number, [1.0] * number
    told = classes.sparkSession.sparkContext.broadcast(trees)    # 2^depth planes a tree, bounded by ``sample``

    def dealt(jobs: list[tuple[int, int, int]]):
        """Vectors side by side in one row for each bucket that a run of classes falls in."""
        mine = {t: (parts, [part for u, part, _ in jobs if u == t]) for t, _, parts in jobs}

        def deal(ids: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
            x = _singles(vectors)
            for t, (parts, own) in mine.items():
                found = [(leaf, rows) for leaf, rows in leaves_of(x, *told.value[t]) if leaf % parts in own]
                yield pa.RecordBatch.from_arrays([pa.array([(t << 32) + leaf for leaf, _ in found], pa.int64()), pa.array([ids[rows].tobytes() for _, rows in found], pa.binary()),
                                                  pa.array([vectors[rows].tobytes() for _, rows in found], pa.binary())], names=["bucket", "ids", "vecs"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors = [], []
            for b in batches:
                ids.append(b.column("class").to_numpy())
                vectors.append(_vectors(b.column("vec"), dim))
                if sum(map(len, ids)) >= RUN:
                    yield from deal(np.concatenate(ids), np.concatenate(vectors))
                    ids, vectors = [], []
            if ids:
                yield from deal(np.concatenate(ids), np.concatenate(vectors))
        return run

    def find(table: pa.Table) -> pa.Table:
        ids = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("ids")])
        vectors = np.concatenate([np.frombuffer(x.as_buffer(), f"<f{width}").reshape(-1, dim) for x in table.column("vecs")])
        i, j = bucket_edges(vectors, forest, (forest.seed, table.column("bucket")[0].as_py()))
        return pa.table({"src": ids[i], "dst": ids[j]})

    out = None
    for jobs in _passes(reps, count):
        moved = classes.select("class", "vec").mapInArrow(dealt(jobs), "bucket bigint, ids binary, vecs binary")
        found = saved(moved.groupBy("bucket").applyInArrow(find, "src bigint, dst bigint"), "embedding-edges")
        out = found if out is None else out.union(found)
    return out


def class_components(classes: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``(node, component)`` of the classes that have a link."""
    out = classes.select(F.col("class").alias("src"), F.col("class").alias("dst")).where("false")
    sizes = classes.groupBy("dim", (F.length("vec") / F.col("dim")).cast("int").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    for dim, width, count in [tuple(r) for r in sizes.where("n > 1").orderBy("dim").collect()]:   # one row per vector length
        out = out.union(_edges(classes.where(F.col("dim") == dim), forest, dim, width, count))
    return connected_components(out)


# --- links of a component ---------------------------------------------------------------

def _count(vectors: np.ndarray, size: np.ndarray, side: np.ndarray, a: int, b: int, least: float) -> np.ndarray:
    """Linked vectors of each class of a component (``a`` and ``b`` are the same), or of two chunks of one."""
    x, near, ones = _singles(vectors), np.zeros(len(vectors), np.int64), bool((size == 1).all())
    left, right = (np.flatnonzero(side == k) for k in (a, b))
    for lo in range(0, len(left), 512):
        part = left[lo:lo + 512]
        hits = _hits(x[part], x[right], _exact(vectors, part, right), least)
        if a == b:
            hits[np.arange(len(part)), lo + np.arange(len(part))] = False
        near[part] += np.count_nonzero(hits, axis=1) if ones else hits @ size[right]
        if a != b:
            near[right] += np.count_nonzero(hits, axis=0) if ones else size[part] @ hits
    return near


def _counted(least: float):
    """``(src, near)`` of the classes of a cell: whole components, or two chunks of one."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("component").combine_chunks()
        ids, component, dims, size, side = (table.column(c).to_numpy() for c in ("class", "component", "dim", "size", "c"))
        a, b, vec = table.column("a")[0].as_py(), table.column("b")[0].as_py(), table.column("vec").chunk(0)
        near = np.zeros(len(ids), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(component)) + 1, [len(ids)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            near[lo:hi] = _count(_vectors(vec.slice(lo, hi - lo), int(dims[lo])), size[lo:hi], side[lo:hi], a, b, least)
        return pa.table({"src": ids[near > 0], "near": near[near > 0]})
    return run


def _dense(large: DataFrame, forest: Forest) -> DataFrame:
    """``component`` of those of ``large(class, dim, vec, component, n)`` of whose pairs a share of ``tight`` or more are links."""
    def tell(table: pa.Table) -> pa.Table:
        share, _ = link_share(_singles(_vectors(table.column("vec"), table.column("dim")[0].as_py())), forest.least, np.random.default_rng(forest.seed))
        return table.select(["component"]).slice(0, int(share >= forest.tight))

    draw = F.pmod(F.xxhash64("class", F.lit(forest.seed)), F.lit(1_000_000))
    return large.where(draw < F.lit(1_000_000) * F.lit(2 * PROBE) / F.col("n")).groupBy("component").applyInArrow(tell, "component bigint")


def component_links(classes: DataFrame, comp: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``(src, near)``: vectors linked with class ``src``, to be summed, counted within components."""
    comp = saved(comp, "embedding-components")
    sizes = saved(comp.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "embedding-sizes")
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    members = (comp.join(sizes, "component").withColumnRenamed("node", "class").join(classes.select("class", "dim", "vec", "size"), "class"))
    large = sparse = None
    if most > forest.whole:
        large = saved(members.where(F.col("n") > forest.whole), "embedding-large")
        dense = saved(_dense(large, forest), "embedding-dense")
        sparse = large.join(dense, "component", "left_anti")
        large = large.join(dense, "component", "left_semi")
    columns = ["class", "dim", "vec", "size", "component"]
    cells = (members.where(F.col("n") <= forest.whole)
             .select(*columns, F.pmod(F.xxhash64("component"), F.lit(max(1, total // 8192))).alias("cell"), *(F.lit(0).alias(k) for k in "cab")))
    if large is not None:
        chunks = F.ceil(F.col("n") / F.lit(forest.whole)).cast("int")
        cells = cells.union(large.withColumn("c", F.pmod(F.xxhash64("class"), chunks).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), chunks - 1)))
                            .select(*columns, (-1 - F.col("component")).alias("cell"), "c", F.least("c", "x").alias("a"), F.greatest("c", "x").alias("b")))
    out = saved(cells.groupBy("cell", "a", "b").applyInArrow(_counted(forest.least), "src bigint, near bigint"), "embedding-near")
    if sparse is not None and not sparse.isEmpty():
        out = out.union(embedding_links(sparse.select("class", "dim", "vec", "size"), forest).select("src", "near"))
    return out


# --- leaves of large components ------------------------------------------------------------------------

_LEAF = ["class", "vec", "tree", "node"]


def _leaf_schema(df: DataFrame) -> str:
    return f"class bigint, vec {df.schema['vec'].dataType.simpleString()}, tree int, node bigint"


def _routed(batch, rows, nodes, tree: int, base: int):
    """Routed rows as columns class, vec, tree, node."""
    take = pa.array(rows)
    return [batch.column("class").take(take), batch.column("vec").take(take), pa.array(np.full(len(rows), tree, np.int32)), pa.array(base + nodes)]


def _plant(classes: DataFrame, forest: Forest, dim: int, count: int) -> DataFrame:
    """All classes of one dimension routed through the trees fitted on a sample."""
    depth = max(0, ceil(log2(max(count, 1) / forest.leaf)))
    depth = min(depth, int(log2(forest.sample)) - 4)             # 16 or more sample points a leaf
    if not depth:
        return classes.select("class", "vec", F.lit(0).alias("tree"), F.lit(0).cast("bigint").alias("node"))
    share = min(1.0, forest.sample / count)
    picked = classes.where(F.pmod(F.xxhash64("class", F.lit(forest.seed)), F.lit(1_000_000)) < int(1_000_000 * share)).select("vec").toArrow()
    x = _singles(_vectors(picked.column("vec"), dim))     # ``sample`` rows are expected at any input size
    trees = [fit_tree(x, depth, forest, forest.seed + t) for t in range(forest.trees)]
    told = classes.sparkSession.sparkContext.broadcast(trees)    # 2^depth planes a tree, bounded by ``sample``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _singles(_vectors(b.column("vec"), dim))
            for t, (planes, cuts) in enumerate(told.value):
                yield pa.RecordBatch.from_arrays(_routed(b, *route(x, planes, cuts), t, 0), names=_LEAF)

    return classes.select("class", "vec").mapInArrow(run, _leaf_schema(classes))


PART = 8192      # members of a crowded leaf that one task routes


def _split_again(leaves: DataFrame, crowd: DataFrame, forest: Forest, dim: int, turn: int) -> DataFrame:
    """Leaves named in ``crowd(tree, node, n)`` split by subtrees fitted on samples of their own members.
    A leaf of near copies alone stays whole, under a negative number."""
    told = leaves.join(crowd, ["tree", "node"], "left")
    members = told.where("n is not null")
    draw = F.pmod(F.xxhash64("class", "tree", F.lit(forest.seed + turn)), F.lit(1_000_000))
    sample = members.where(draw < F.lit(1_000_000) * F.lit(forest.local) / F.col("n"))

    def fit(table: pa.Table) -> pa.Table:
        x = _singles(_vectors(table.column("vec"), dim))
        tree, node, n = (table.column(c)[0].as_py() for c in ("tree", "node", "n"))
        seed = (forest.seed + turn, tree, node % (1 << 31))
        depth = min(max(1, ceil(log2(n / forest.leaf))), 6)
        share, centre = link_share(x, forest.least, np.random.default_rng(seed))
        if share >= forest.tight and ball_cut(x @ centre, forest.least) is None:
            depth = 0
        planes, cuts = fit_tree(x, depth, forest, seed)
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), "n": pa.array([n], pa.int64()),
                         "planes": pa.array([planes.tobytes()], pa.binary()), "cuts": pa.array([cuts.tobytes()], pa.binary())})

    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    fitted = (sample.groupBy("tree", "node").applyInArrow(fit, "tree int, node bigint, n bigint, planes binary, cuts binary")
              .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))))
    members = members.withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))

    def split(table: pa.Table, subtree: pa.Table) -> pa.Table:
        if not table.num_rows or not subtree.num_rows:
            return table.select(_LEAF)
        planes = np.frombuffer(subtree.column("planes")[0].as_py(), np.float32).reshape(-1, dim)
        cuts = np.frombuffer(subtree.column("cuts")[0].as_py(), np.float32).reshape(-1, 3)
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        if not len(planes):
            return pa.Table.from_arrays(_routed(table, np.arange(table.num_rows), np.zeros(table.num_rows, np.int64), tree, -1 - node), names=_LEAF)
        found = route(_singles(_vectors(table.column("vec"), dim)), planes, cuts)
        return pa.Table.from_arrays(_routed(table, *found, tree, (node + 1) * 64 % (1 << 62)), names=_LEAF)

    keys = ("tree", "node", "part")
    return told.where("n is null").select(*_LEAF).union(
        members.groupBy(*keys).cogroup(fitted.groupBy(*keys)).applyInArrow(split, _leaf_schema(leaves)))


def _earlier(table: pa.Table) -> np.ndarray:
    """Per member, bits of the leaves before this one (by hash) that two or more members share."""
    leaf = table.column("leaf")[0].as_py()
    lists = table.column("leaves").combine_chunks()
    held = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    row, held = row[held < leaf], held[held < leaf]
    _, kind, count = np.unique(held, return_inverse=True, return_counts=True)
    many = count > 1
    number = np.cumsum(many) - 1
    row, kind = row[many[kind]], number[kind[many[kind]]]
    bits = np.zeros((len(lists), max(1, -(-int(many.sum()) // 64))), np.uint64)
    np.bitwise_or.at(bits, (row, kind // 64), np.uint64(1) << (kind % 64).astype(np.uint64))
    return bits


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (lowest member) once members ``i`` and ``j`` are joined."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _compare(least: float, dim: int, width: int):
    """Links within a cell (all pairs of a chunk, or of two chunks): per class
    its linked vectors ``near``, and edges ``(src, dst)`` that join what the links join."""
    def run(table: pa.Table) -> pa.Table:
        x = _units(_vectors(table.column("vec"), dim))
        ids, size = table.column("class").to_numpy(), table.column("size").to_numpy()
        bits = _earlier(table)
        first = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        side = table.column("c").to_numpy() == table.column("a")[0].as_py()
        left, right = (np.arange(len(ids)),) * 2 if first else (np.flatnonzero(side), np.flatnonzero(~side))
        near, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        if np.bitwise_and.reduce(bits, axis=0).any():        # an earlier leaf holds all of them
            left = left[:0]
        for lo in range(0, len(left), width):
            part = left[lo:lo + width]
            i, j = np.nonzero(x[part] @ x[right].T >= least)
            i, j = part[i], right[j]
            if first:
                i, j = i[i < j], j[i < j]
            told = np.zeros(len(i), bool)
            for w in range(bits.shape[1]):
                told |= (bits[i, w] & bits[j, w]) != 0
            i, j = i[~told], j[~told]
            near += np.bincount(i, size[j], len(ids)).astype(np.int64) + np.bincount(j, size[i], len(ids)).astype(np.int64)
            label = _join(label, i, j)
        on = np.flatnonzero(near)
        return pa.table({"src": ids[on], "dst": ids[label[on]], "near": near[on]})
    return run


def embedding_links(classes: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``(src, dst, near)``: linked vectors of class ``src``, to be summed, and
    edges whose components are those of the links."""
    out = None
    for dim, count in [tuple(r) for r in classes.groupBy("dim").agg(F.count(F.lit(1))).orderBy("dim").collect()]:   # one row per vector length
        leaves = saved(_plant(classes.where(F.col("dim") == dim), forest, dim, count), "embedding-leaves")
        for turn in range(1, forest.rounds + 1):
            sizes = leaves.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
            crowd = sizes.where((F.col("n") > 4 * forest.leaf) & (F.col("node") >= 0))
            if crowd.isEmpty():
                break
            leaves = saved(_split_again(leaves, crowd, forest, dim, turn), "embedding-leaves")
        sizes = leaves.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        chunks = F.ceil(F.col("n") / F.lit(4 * forest.leaf)).cast("int")
        leaf = F.xxhash64("tree", "node")
        held = leaves.groupBy("class").agg(F.collect_list(leaf).alias("leaves"))      # a few leaves a tree
        cells = (leaves.join(sizes, ["tree", "node"]).join(held, "class").join(classes.select("class", "size"), "class")
                 .withColumn("c", F.pmod(F.xxhash64("class"), chunks).cast("int"))
                 .withColumn("x", F.explode(F.sequence(F.lit(0), chunks - 1)))
                 .select("class", "size", "vec", "tree", "node", leaf.alias("leaf"), "leaves", "c", F.least("c", "x").alias("a"), F.greatest("c", "x").alias("b")))
        found = cells.groupBy("tree", "node", "a", "b").applyInArrow(_compare(forest.least, dim, 1024), "src bigint, dst bigint, near bigint")
        out = found if out is None else out.union(found)
    if out is None:
        return classes.select(F.col("class").alias("src"), F.col("class").alias("dst"), F.col("size").alias("near")).where("false")
    return saved(out, "embedding-links")


def embedding_groups(vectors: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding)``."""
    with build_conf(vectors.sparkSession, TIDY):
        rows, classes = vector_classes(vectors)
        comp = class_components(classes, forest)
        near = component_links(classes, comp, forest).groupBy("src").agg(F.sum("near").alias("near"))
        told = (classes.select("class", "size", "rep").join(near, F.col("class") == F.col("src"), "left").join(comp.withColumnRenamed("node", "class"), "class", "left")
                .select("class", "size", "rep", (F.coalesce("near", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "class").alias("component")))
        told = saved(told, "embedding-told")
        lowest = told.groupBy("component").agg(F.min("rep").alias("component_id"))
        told = saved(told.join(lowest, "component").select("class", "size", "rep", "n_links", "component_id"), "embedding-told")
        repeated = told.where("size > 1").select("class", "n_links", "component_id")
        repeated = saved(classes.where("size > 1").select("class", "vec").join(repeated, "class").select("vec", "n_links", "component_id"), "embedding-repeated")
    got = told.where("size = 1").select(F.col("rep").alias("vec_id"), "n_links", "component_id")
    if not repeated.isEmpty():
        got = got.union(rows.where("vec is not null").join(repeated, "vec").select("vec_id", "n_links", "component_id"))
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return got.union(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


__all__ = ["Forest", "link_share", "fit_tree", "route", "vector_classes", "bucket_edges", "class_components", "component_links", "embedding_links", "embedding_groups"]
