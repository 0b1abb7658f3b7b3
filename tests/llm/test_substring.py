"""Substring duplicates against every window of every document."""

import hashlib
import random
import re

import pytest

from shardloom.llm import substring_dedup as sd

SMALL = sd.Cover(block_bytes=3000, bucket_bytes=5000)


def plain(rows, n=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - n + 1):
                run = tuple(w[k:k + n])
                least[run] = min(least.get(run, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        if i is not None:
            for k in range(len(w) - n + 1):
                if least[tuple(w[k:k + n])] < i:
                    gone.update(range(k, k + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def check(spark, rows, cover=SMALL):
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id bigint, text string, keys string, block int").repartition(5)
    got = [tuple(r) for r in sd.dedup(df, cover, whole=True).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    want = plain(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    return want


def passages(seed, docs=120):
    """Texts of own words with shared runs of 5 to 60 words at any place, also twice in a text."""
    rng = random.Random(seed)
    shared = [[f"s{k}_{j}" for j in range(rng.randint(5, 60))] for k in range(12)]
    rows = []
    for i in range(docs):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += [f"own{i}_{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 25))]
            run = rng.choice(shared)
            a = rng.randint(0, len(run) // 3)
            w += run[a:rng.randint(a, len(run))]
        rows.append((rng.randint(-50, 10**6), rng.choice([" ", "\n", " \t "]).join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_every_window(spark, seed):
    want = check(spark, passages(seed))
    assert sum(r[2] for r in want) > 500


def test_few_words_and_repeats(spark):
    """Texts over three words: windows repeat inside a text and match at every offset."""
    rng = random.Random(5)
    check(spark, [(i, " ".join(rng.choice("abc") if rng.random() < 0.2 else "a" for _ in range(rng.randint(0, 80)))) for i in range(80)])


def test_a_passage_of_thirteen_words_at_every_pair_of_offsets(spark):
    run = [f"r{k}" for k in range(13)]
    rows = [(i, " ".join([f"x{i}_{k}" for k in range(i)] + run + [f"y{i}"])) for i in range(21)]
    want = check(spark, rows)
    assert [r[2] for r in want] == [0] + [13] * 20
    short = [(i, " ".join([f"x{i}_{k}" for k in range(i)] + run[:12] + [f"y{i}"])) for i in range(21)]
    assert all(r[2] == 0 for r in check(spark, short))


def test_one_document_in_three_is_a_copy(spark):
    same = " ".join(f"w{k}" for k in range(90))
    rows = [(i, same if i % 3 == 0 else f"own{i} " * 3 + " ".join(f"o{i}_{k}" for k in range(40))) for i in range(300)]
    want = check(spark, rows)
    assert sum(r[2] == 90 for r in want) == 99


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = [tuple(r) for r in sd.dedup(odd_docs, SMALL, whole=True).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert sd.dedup(no_docs).count() == 0 and sd.dedup(no_docs).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    base = " ".join(f"w{k}" for k in range(30))
    # equal ids do not remove each other; no id, no part
    check(spark, [(4, base), (4, base + " more"), (None, base), (None, base), (9, "x " + base), (9, None), (10, ""), (2, "é" * 5000)])


def test_covers():
    with pytest.raises(ValueError):
        sd.Cover(residues=(0, 1, 2))
    with pytest.raises(ValueError):
        sd.Cover(window=5)
