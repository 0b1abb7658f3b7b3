"""Toxicity: pairs are learned, held-out accuracy, scores against the formula."""

import random
import zlib

import numpy as np

from shardloom.llm import toxicity_fm as X
from shardloom.llm.catalog import LLM_QUERIES

from .conftest import ROWS


def test_score_is_the_machine_s_formula():
    rng = np.random.default_rng(0)
    at = np.unique(rng.integers(0, 1 << X.HASH_BITS, 50)).astype(np.int32)
    m = X.Machine(at, rng.normal(size=len(at)), rng.normal(size=(len(at), 3)), -0.3)
    for _ in range(20):
        on = np.sort(rng.choice(len(at), rng.integers(0, 9), replace=False))
        found = np.unique(np.concatenate([at[on], rng.integers(0, 1 << X.HASH_BITS, 30).astype(np.int32)]))
        on = [i for i in range(len(at)) if at[i] in found]
        z = m.bias + sum(m.weight[i] for i in on) + sum(m.factor[i] @ m.factor[j] for a, i in enumerate(on) for j in on[a + 1:])
        assert abs(m.score(found) - 1 / (1 + np.exp(-z))) < 1e-9


def test_pairs_that_no_word_gives_away_are_learned(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(["sun", "rain", "wind", "snow"]) for _ in range(6)] + ["insulting"] * a + ["grouping"] * b
        rows.append((int(a and b), X.buckets(" ".join(words)).tolist()))
    m = X.train(spark.createDataFrame(rows, "toxic int, buckets array<int>"), X.Training(steps=200))
    score = lambda t: m.score(X.buckets(t))
    assert score("sun insulting grouping") > 0.5 > max(score("sun insulting rain"), score("grouping wind"), score("snow"), score(""))
    i = [list(m.at).index(X.buckets(w)[k]) for w in ("insulting", "grouping") for k in [0]]
    assert np.abs(m.factor[i]).sum() > 0


def test_a_word_that_is_neutral_alone_enters_beside_another(spark):
    """A group's name: toxic beside an insult, and as rare in toxic rows as elsewhere."""
    rng = random.Random(3)
    texts = []
    for i in range(4000):
        insult, group = rng.random() < 0.15, rng.random() < 0.2
        toxic = insult and (group or rng.random() < 0.3)
        if not insult and rng.random() < 0.17:                 # toxic for other words, mostly without the group's name
            toxic, group = True, group and rng.random() < 0.1
        words = [rng.choice(["sun", "rain", "wind", "snow", "hill"]) for _ in range(6)] + ["scum"] * insult + ["folk"] * group
        words += ["filth"] * (toxic and not insult)
        texts.append((int(toxic), " ".join(words)))
    rows = spark.createDataFrame([(t, X.buckets(x).tolist()) for t, x in texts], "toxic int, buckets array<int>")
    folk = int(X.buckets("folk")[0])
    share = lambda rows: sum(t for t, _ in rows) / len(rows)
    assert abs(share([r for r in texts if "folk" in r[1]]) - share(texts)) < 0.05
    t = X.Training(steps=200)
    assert folk in X.train(rows, t).at and folk not in X.train(rows, X.Training(steps=5, partners=0)).at
    m = X.train(rows, t)
    score = lambda x: m.score(X.buckets(x))
    assert score("sun scum folk") > 0.5 > max(score("sun scum hill"), score("rain folk wind"))
    assert score("sun scum folk") > score("sun scum hill") + 0.3


def test_held_out_rows_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    truth = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        truth[r.doc_id] = max(truth.get(r.doc_id, 0), r.toxic)
    rows = LLM_QUERIES["op10_toxicity_fm"](spark, sf).collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p for t, p in held if t]) > 0.8 and np.mean([p for t, p in held if not t]) < 0.02


def test_odd_rows(spark, odd_docs, no_docs):
    label = "doc_id bigint, toxic int, text string"
    for rows in ([], [(1, 1, "t")], [(1, 0, "t"), (2, 0, "t")], [(1, None, "t"), (None, 1, "t")], [(1, 1, "t"), (1, 0, "t"), (2, 0, "t"), (6, 0, "t"), (8, 1, "t")]):
        t = X.Training(least=1)
        m = X.train(X.training_rows(odd_docs, spark.createDataFrame(rows, label), t), t)
        got = X.score(odd_docs, m).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
        assert len(empty) == 1
    assert X.score(no_docs, m).count() == 0
