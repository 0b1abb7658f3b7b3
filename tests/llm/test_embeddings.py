"""Embedding near-duplicates against all pairs."""

import os
from pathlib import Path

import numpy as np
import pytest

from shardloom.llm import embedding_dedup as E
from shardloom.llm.catalog import LLM_QUERIES
from shardloom.session import checkpoint_dir


def plain(rows, least=0.9):
    """(n_links, component) of each row by comparing all pairs."""
    unit = []
    for _, v in rows:
        ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        u = np.array(v, float) if ok else None
        u = u / np.abs(u).max() if ok else None
        unit.append(u / np.linalg.norm(u) if ok else None)
    label, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for (i, _), x in zip(rows, label):
        low[x] = min((y for y in (low.get(x), i) if y is not None), default=None)
    return sorted((str(i), n, str(low[x])) for (i, _), n, x in zip(rows, links, label))


def told(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows)
    return sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in rows)


ODD = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [float("nan"), 1.0]),
       (10, [float("inf"), 1.0]), (11, [1.0, 0.0, 0.0]), (12, [1e200, 1e180]), (13, [1e-200, 0.0]), (4, [0.0, 1.0]), (None, [-1.0, 0.0]), (20, [-1.0, 0.01]), (21, [-0.0, 1.0])]


@pytest.mark.parametrize("kind", ["double", "float"])
def test_odd_vectors(spark, kind):
    rows = ODD if kind == "double" else [r for r in ODD if r[0] not in (12, 13)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id bigint, embedding array<{kind}>, class int, rep string")
    assert told(E.embedding_groups(df)) == plain(rows)
    assert E.embedding_groups(df.limit(0)).count() == 0


def test_small_leaves_and_further_splits_find_the_links(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    rows = [(i, (base[i % 60] + 0.08 * rng.standard_normal(16)).tolist()) for i in range(900)]
    rows += [(900 + i, base[0].tolist()) for i in range(200)]
    want = plain(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = told(E.embedding_groups(df, E.Forest(leaf=16, sample=256, local=128)))
    missed = 1 - sum(n for _, n, _ in got) / sum(n for _, n, _ in want)
    assert 0 <= missed < 0.02 and all(a[1] <= b[1] for a, b in zip(got, want))
    assert sum(a[2] == b[2] for a, b in zip(got, want)) > 0.99 * len(rows)


def test_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {r.vec_id: r.n_links for r in LLM_QUERIES["op1_embedding_dedup"](spark, sf).collect()}
    true = ((x @ x.T) >= 0.9).sum(1) - 1
    assert len(got) == len(rows) and sum(got.values()) >= 0.9 * true.sum() and all(got[i] <= t for (i, _), t in zip(rows, true))


def test_large_groups_of_near_copies_keep_their_links(spark):
    """Groups far beyond a leaf: near copies, and pairs inside one topic."""
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    centre = unit(rng.standard_normal((2, 64)))
    copies = unit(np.sqrt(0.95) * centre[0] + np.sqrt(0.05) * unit(rng.standard_normal((10_000, 64))))
    topic = unit(np.sqrt(0.8) * centre[1] + np.sqrt(0.2) * unit(rng.standard_normal((6_000, 64))))
    twins = unit(topic[:500] + 0.48 * unit(rng.standard_normal((500, 64))))
    x = np.concatenate([copies, topic, twins])
    true = np.concatenate([(x[lo:lo + 2000] @ x.T >= 0.9).sum(1) - 1 for lo in range(0, len(x), 2000)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in E.embedding_groups(df).collect()}
    n = np.array([got[i].n_links for i in range(len(x))])
    assert (n <= true).all() and true[:10_000].min() > 9_000
    assert n[:10_000].sum() >= 0.999 * true[:10_000].sum()
    assert true[10_000:].sum() >= 500 and n[10_000:].sum() >= 0.99 * true[10_000:].sum()
    assert {got[i].component_id for i in range(10_000)} == {0}


def test_near_copies_are_taken_out_of_a_node_and_the_rest_is_split():
    """A quarter near copies of one text: they end in one leaf, whole, and the rest in small ones."""
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    copies = unit(np.sqrt(0.95) * unit(rng.standard_normal((1, 64))) + np.sqrt(0.05) * unit(rng.standard_normal((5_000, 64))))
    x = np.concatenate([copies, unit(rng.standard_normal((15_000, 64)))]).astype(np.float32)
    forest = E.Forest()
    planes, cuts = E.fit_tree(x[rng.choice(len(x), 8_000, replace=False)], 6, forest, 3)
    rows, leaves = E.route(x, planes, cuts)
    sizes = np.bincount(leaves, minlength=64)
    ball = leaves[rows < 5_000]
    assert len(np.unique(ball)) == 1 and len(ball) == 5_000                     # no copy goes down both sides
    assert sizes[ball[0]] < 5_100 and np.sort(sizes)[-2] < 2_500
    # linked pairs of the whole table share a leaf
    assert E.ball_cut(np.full(100, 0.95), 0.9) is None and E.ball_cut(np.linspace(0.3, 1, 100), 0.9) is None


def _recall(vectors):
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = (x @ x.T >= 0.9).sum(1) - 1
    assert len(np.unique(x, axis=0)) == len(x) and true.sum() > 0
    got = {r.vec_id: r.n_links for r in E.embedding_groups(vectors).collect()}
    assert all(got[i] <= t for (i, _), t in zip(rows, true)) and sum(got.values()) >= 0.999 * true.sum()


def test_vectors_with_links(spark):
    """The given vectors with near copies of a tenth of them, some many times."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(9)
    at = np.concatenate([rng.integers(0, len(rows), 150), np.repeat(rng.integers(0, len(rows), 5), 40)])
    near = []
    for k, i in enumerate(at):
        v = np.array(rows[i][1], float)
        w = rng.standard_normal(len(v))
        near.append((10**6 + k, (v + w * 0.3 * np.linalg.norm(v) / np.linalg.norm(w)).tolist()))
    _recall(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows + near], "vec_id bigint, embedding array<double>"))


@pytest.mark.parametrize("name", ["check_s", "check_h"])
def test_given_vectors_with_links(spark, name):
    """Recall on larger tables that hold links between different vectors, where they are given."""
    path = f"/root/testdata/{name}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip(f"{path} is not given here")
    _recall(spark.read.parquet(path))


def _links(x, least=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(x[lo:lo + 2000] @ x.T >= least).sum(1) - 1 for lo in range(0, len(x), 2000)])


def test_vectors_are_not_written_for_every_leaf(spark):
    """What the steps write and leave there is a few copies of the vectors, however many leaves hold them."""
    rng = np.random.default_rng(17)
    x = np.concatenate([rng.standard_normal((19_000, 32)), np.repeat(rng.standard_normal((50, 32)), 20, axis=0) + 0.1 * rng.standard_normal((1000, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    kept = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(kept.rglob("*.parquet"))
    got = {r.vec_id: r.n_links for r in E.embedding_groups(df).collect()}
    assert [got[i] for i in range(len(x))] == _links(x.astype(float)).tolist()
    written = sum(f.stat().st_size for f in set(kept.rglob("*.parquet")) - before)
    assert 0 < written < 3 * x.nbytes


def test_large_components_are_counted_in_chunks_or_leaves(spark):
    """Components beyond ``whole``: near copies by pairs of chunks, a thin one (few of its pairs are links) by leaves."""
    rng = np.random.default_rng(23)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    copies = unit(rng.standard_normal((1, 12))) + 0.05 * rng.standard_normal((900, 12))
    thin = np.zeros((3000, 12))
    thin[:, :4] = unit(rng.standard_normal((3000, 4)))          # all over a sphere, each linked with its surroundings only
    x = np.concatenate([copies, copies[:100], thin, rng.standard_normal((200, 12))])
    true = _links(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    forest = E.Forest(leaf=64, sample=1024, local=512, whole=256)
    got = {r.vec_id: r for r in E.embedding_groups(df, forest).collect()}
    n = np.array([got[i].n_links for i in range(len(x))])
    assert (n <= true).all() and (n[:1000] == true[:1000]).all()
    assert n[1000:4000].sum() >= 0.99 * true[1000:4000].sum() and 0 < true[1000:4000].mean() < 0.05 * 3000
    assert {got[i].component_id for i in range(1000, 4000)} == {min(1000, got[1000].component_id)}


def test_links_at_the_very_edge_are_told_in_double_precision(spark):
    """Cosines within 1e-9 of 0.9, on both sides, of vectors in double precision; a direction many times over."""
    rng = np.random.default_rng(29)
    rows, want = [], {}
    for k in range(40):
        a = rng.standard_normal(24)
        w = rng.standard_normal(24)
        a, w = a / np.linalg.norm(a), w - (w @ a) / (a @ a) * a
        cos = 0.9 + (1e-9 if k % 2 else -1e-9)
        rows += [(2 * k, a), (2 * k + 1, 3 * (cos * a + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w)))]
        want |= {2 * k: k % 2, 2 * k + 1: k % 2}
    line = rng.standard_normal(24)
    rows += [(1000 + k, line * (k + 1)) for k in range(5000)]
    want |= {1000 + k: 4999 for k in range(5000)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<double>")
    assert {r.vec_id: r.n_links for r in E.embedding_groups(df).collect()} == want
