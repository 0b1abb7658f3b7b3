"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct lower-case words and their beginnings (4 to 8
letters, for inflected and compounded forms), hashed to ``2^HASH_BITS`` buckets.  The machine scores a text by a bias, a weight per bucket present and
the product of the factors of every pair of buckets present, so a pair of words
can count although neither does alone.

Training takes a bounded sample of the labelled rows (``rows`` expected, chosen
by a hash of ``doc_id``); buckets are ranked by chi-square on that sample and
the best ``terms`` of those beyond ``chance`` enter the machine, which Spark
ML fits.  A word that says nothing alone may say much beside another: among the rows
that hold one of the best ``anchors`` buckets, every other bucket is tested for a
difference it makes there, and the best ``partners`` of those beyond ``pair_chance``
(which many tests need) enter too.  Scoring reads every
whole text; a text's cost is its number of words.

Defined results: a null or empty text has no terms and gets the score of the
bias; rows without ``doc_id`` are never held out and never trained on; labels
that disagree count as toxic and null labels do not count; without both labels
the score is the share of toxic rows; repeated rows are scored each; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

HASH_BITS = 22
STEMS = range(4, 9)
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    rows: int = 20_000        # bound of the training sample (expected size)
    terms: int = 1024         # buckets that enter the machine at most
    chance: float = 15.0      # chi-square that a bucket has at least
    least: int = 5            # training texts that a bucket is in at least
    anchors: int = 64         # buckets that partners are looked for beside
    partners: int = 128       # further buckets that enter for their part in a pair, at most
    pair_chance: float = 40.0
    factors: int = 4
    start: float = 0.01       # spread of the factors at the start
    steps: int = 60
    rate: float = 0.1
    penalty: float = 1e-4
    seed: int = 42


def buckets(text: str | None) -> np.ndarray:
    """Distinct hash buckets of the words of a text."""
    terms = set(_WORDS.findall((text or "").lower()))
    terms |= {w[:n] + "*" for w in terms for n in STEMS if len(w) > n}
    return np.unique(np.fromiter((zlib.crc32(w.encode()) for w in terms), np.uint32, len(terms)) & np.uint32((1 << HASH_BITS) - 1)).astype(np.int32)


@dataclass
class Machine:
    """Buckets (sorted) with their weights and factors, and the bias."""
    at: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        if not len(self.at):
            return float(1 / (1 + np.exp(-self.bias)))
        i = np.minimum(np.searchsorted(self.at, found), len(self.at) - 1)
        i = i[self.at[i] == found]
        v = self.factor[i]
        z = self.bias + self.weight[i].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def is_held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, training: Training) -> DataFrame:
    """``(toxic, buckets)`` of the training sample."""
    told = (labels.where("doc_id is not null and toxic is not null").where(~is_held_out("doc_id"))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = told.count()
    if n > training.rows:
        told = told.where(F.pmod(F.xxhash64("doc_id", F.lit(training.seed)), F.lit(1_000_000)) < int(1_000_000 * training.rows / n))
    picked = docs.select("doc_id", "text").join(F.broadcast(told), "doc_id")      # bounded by ``rows``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [buckets(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "buckets"])

    return saved(picked.select("text", "toxic").mapInArrow(run, "toxic int, buckets array<int>"), "toxic-training")


def partners(rows: DataFrame, best: list[int], training: Training) -> list[int]:
    """Buckets outside ``best`` that tell toxic from other rows among those that hold one of
    its first ``anchors``, by chi-square of the pair; at most ``partners``."""
    anchors = np.array(best[:training.anchors], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, toxic = [], []
            for t, found in zip(b.column(0).to_pylist(), b.column(1)):
                own = np.asarray(found.values, np.int64)
                for a in np.flatnonzero(np.isin(anchors, own)).tolist():
                    keys.append(own | a << HASH_BITS)
                    toxic.append(np.full(len(own), t, np.int64))
            if keys:
                pair, at = np.unique(np.concatenate(keys), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.bincount(at)), pa.array(np.bincount(at, np.concatenate(toxic)).astype(np.int64))],
                                                 names=["pair", "c", "t"])

    # the rows of each anchor and the toxic ones among them: ``anchors`` numbers
    held = F.explode(F.array_intersect("buckets", F.array(*[F.lit(int(a)) for a in anchors]))).alias("bucket")
    alone = {r.bucket: r for r in rows.select("toxic", held).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).collect()}
    of = lambda name: F.get(F.array(*[F.lit(alone[int(a)][name]) for a in anchors]), F.col("a"))
    both = (rows.select("toxic", "buckets").mapInArrow(run, "pair bigint, c bigint, t bigint").groupBy("pair").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
            .where(F.col("c") >= training.least)
            .select(F.shiftright("pair", HASH_BITS).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << HASH_BITS) - 1)).cast("int").alias("bucket"), "c", "t")
            .withColumns({"n": of("n"), "pos": of("pos")})
            .where((F.col("c") < F.col("n")) & F.col("pos").between(1, F.col("n") - 1) & ~F.col("bucket").isin(best)))
    share = F.col("pos") / F.col("n")
    chi = (F.col("t") - F.col("c") * share) ** 2 / (F.col("c") * share * (1 - share) * (1 - F.col("c") / F.col("n")))
    top = (both.select("bucket", chi.alias("chi")).where(F.col("chi") >= training.pair_chance)
           .groupBy("bucket").agg(F.max("chi").alias("chi")).orderBy(F.desc("chi"), "bucket").limit(training.partners))
    return [r.bucket for r in top.collect()]


def train(rows: DataFrame, training: Training = Training()) -> Machine:
    """Fit the machine on ``rows(toxic, buckets)``."""
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.linalg import Vectors, VectorUDT

    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    none = Machine(np.empty(0, np.int32), np.empty(0), np.empty((0, training.factors)), 0.0)
    if pos in (0, n):
        share = min(max((pos + 0.5) / (n + 1), 1e-6), 1 - 1e-6) if n else 0.01
        none.bias = float(np.log(share / (1 - share)))
        return none
    seen = (rows.select("toxic", F.explode("buckets").alias("bucket")).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("c"), F.sum("toxic").alias("t")).where(F.col("c") >= training.least))
    expected = F.col("c") * F.lit(pos / n)
    chi = (F.col("t") - expected) ** 2 / (expected * F.lit(1 - pos / n) * (1 - F.col("c") / F.lit(n + 1)))
    best = seen.where(chi >= training.chance).orderBy(chi.desc(), "bucket").limit(training.terms).select("bucket").collect()      # bounded by ``terms``
    if not best:
        none.bias = float(np.log(pos / (n - pos)))
        return none
    best = [r.bucket for r in best]
    at = np.array(sorted(best + partners(rows, best, training)), np.int32)
    index, size = {int(b): i for i, b in enumerate(at)}, len(at)

    @F.udf(VectorUDT())
    def vector(found):
        on = sorted(index[b] for b in found if b in index)
        return Vectors.sparse(size, on, [1.0] * len(on))

    data = saved(rows.select(F.col("toxic").cast("double").alias("label"), vector("buckets").alias("features")), "toxic-vectors")
    fit = FMClassifier(factorSize=training.factors, maxIter=training.steps, stepSize=training.rate, regParam=training.penalty,
                       seed=training.seed, initStd=training.start, tol=1e-5).fit(data)
    return Machine(at, fit.linear.toArray(), fit.factors.toArray(), float(fit.intercept))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    told = docs.sparkSession.sparkContext.broadcast(machine)       # bounded by the number of terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = told.value
        for b in batches:
            s = np.array([m.score(buckets(t)) for t in b.column(2).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", is_held_out("doc_id").alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int"))


__all__ = ["Training", "Machine", "buckets", "is_held_out", "training_rows", "partners", "train", "score"]
