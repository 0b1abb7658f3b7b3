"""SimHash near-duplicates against plain-Python fingerprints and all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shardloom.llm import simhash_dedup as S
from shardloom.llm.catalog import LLM_QUERIES

from ..conftest import SF_MID
from .conftest import ROWS


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    n = 4
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=4):
    """Component label of each of the distinct values ``fps`` by comparing all pairs."""
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
    return label


def test_fingerprint_is_the_majority_of_the_shingle_hashes(spark):
    for row in ROWS:
        if row[1] is None or len(row[1]) < 10_000:
            assert S.fingerprint(row[1]) == plain_fingerprint(row[1])
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").orderBy("doc_id").limit(60).collect()
    for r in rows:
        assert S.fingerprint(r.text) == plain_fingerprint(r.text)
    assert S.fingerprint("A b\x0bC d e") == S.fingerprint("a B c\fD\te")
    # long texts are counted in pieces
    old, S.PIECE = S.PIECE, 7
    try:
        assert S.fingerprint(rows[0].text) == plain_fingerprint(rows[0].text)
    finally:
        S.PIECE = old


def test_query_equals_all_pairs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = {r.doc_id: r for r in LLM_QUERIES["op3_simhash_dedup"](spark, SF_MID).collect()}
    assert set(got) == set(docs)
    fp = {i: S.fingerprint(t) for i, t in docs.items()}
    assert all(got[i].fingerprint == f"{fp[i]:016x}" for i in docs)
    kinds = sorted(set(fp.values()))
    label = dict(zip(kinds, components(kinds)))
    low = {}
    for i in docs:
        low[label[fp[i]]] = min(low.get(label[fp[i]], i), i)
    assert all(got[i].component_id == low[label[fp[i]]] for i in docs)
    assert len(set(low.values())) < len(docs)


@pytest.mark.parametrize("cell", [256, 8])
def test_no_link_is_lost_in_crowded_buckets(spark, cell):
    rng = random.Random(7)
    centre = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centre for _ in range(120)}
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    edges = S.hamming_links(df, cell=cell)
    from shardloom.llm.components import connected_components
    comp = {r.node: r.component for r in connected_components(edges).collect()}
    mine = [comp.get(int(np.uint64(f).astype(np.int64)), int(np.uint64(f).astype(np.int64))) for f in fps]
    want = components(fps)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_thresholds_are_allocated_for_the_least_cost():
    cost = [[5, 9, 99, 99, 99], [1, 2, 4, 99, 99], [50, 60, 70, 80, 90]]
    best, t = S.allocate(cost, 4)
    assert sum(x + 1 for x in t) == 5
    from itertools import product
    every = [sum(c[x] if x >= 0 else 0 for c, x in zip(cost, ts)) for ts in product(range(-1, 5), repeat=3) if sum(x + 1 for x in ts) == 5]
    assert best == min(every)


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (4000, 64))
    x[:, 40] = x[:, 3]
    x[:, 17] = x[:, 3]
    parts = S.bit_parts((x.T @ x).astype(float), len(x), 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any({3, 17, 40} <= set(p) for p in parts)


def test_odd_rows(spark, odd_docs, no_docs):
    got = S.simhash_groups(odd_docs)
    rows = [(r.doc_id, r.fp, r.component_id) for r in got.collect()]
    assert len(rows) == len(ROWS)
    assert {c for i, f, c in rows if f == 0} == {3}               # null, empty and blank texts; a null id names nothing
    assert sorted(i for i, f, c in rows if c == 1) == [1, 2, 2]
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [-11, 1, 3, 6, 8, 9, 10] and ids.count(None) == 1
    assert S.simhash_groups(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0


def test_one_of_each_group_stays(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    groups = {r.doc_id: r.component_id for r in S.simhash_groups(docs).collect()}
    kept = [r.doc_id for r in S.keep_one(docs).select("doc_id").collect()]
    assert sorted(kept) == sorted(set(groups.values()))


def test_components_of_a_long_path(spark):
    from shardloom.llm.components import connected_components
    n = 200
    e = [(i, i + 1) for i in range(n)] + [(1000, 1000), (None, 3), (5000, 4000), (4000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(e, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 4000: 4000, 5000: 4000}
    assert connected_components(spark.range(0).select(F.col("id").alias("src"), F.col("id").alias("dst"))).count() == 0


def test_unrelated_texts_of_one_id_all_stay(spark):
    """Groups keep a row each, also where rows share an id; copies still go."""
    text = lambda k: " ".join(f"w{k}_{i}" for i in range(60))
    rows = [(5, text(1)), (5, text(2)), (9, text(3)), (7, text(1)), (5, text(1)), (None, text(4)), (None, text(4)), (None, text(2)), (None, text(5))]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), t) for i, t in [rows[0], rows[1], rows[2], rows[5], rows[8]])
