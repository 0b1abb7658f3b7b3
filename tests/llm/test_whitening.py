"""Whitening against numpy in double precision, and the eigensolver on clustered matrices."""

import numpy as np
import pytest
from pyspark.sql import types as T

from shardloom.llm import whitening as wh

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("id", T.StringType()), T.StructField("n", T.StringType()), T.StructField("whitened", T.IntegerType())])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "i", "n", 1) for i, v in rows], SCHEMA)


def random_rows(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dim)) * np.linspace(2, 0.2, dim) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return [(i, v.tolist()) for i, v in enumerate(x)]


def check(spark, rows, dim, k=8):
    got = wh.components(wh.whiten(table(spark, rows))).collect()
    x = np.array([[int(np.floor(1024 * a)) + 100_000 for a in v] for _, v in rows], object)
    n, s = len(rows), x.sum(axis=0)
    deviation = [int(((n * row - s) ** 2).sum()) for row in x]
    z = (x - np.array([v // n for v in s], object)).astype(float) - np.array([(v % n) / n for v in s])
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(k, dim)
    assert len(got) == n * k and {r.n for r in got} == {n}
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, k + 1):
        own = np.array([by[i, c].whitened for i, _ in rows])
        want = z @ v[:, c - 1] / np.sqrt(e[c - 1])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8
        assert abs(by[0, c].explained - e[c - 1] / e.sum()) < 1e-12
    assert [by[i, 1].deviation for i, _ in rows] == [min(d, wh.LARGEST) for d in deviation]
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("n,dim", [(500, 16), (300, 5)])
def test_equals_plain_whitening(spark, n, dim):
    check(spark, random_rows(n, dim), dim)


def test_large_values_stay_exact(spark):
    check(spark, [(i, [x * 40_000 for x in v]) for i, v in random_rows(200, 9)], 9)


def test_odd_rows(spark):
    rows = random_rows(100, 10)
    v = rows[0][1]
    odd = [(200, None), (201, [*v[:9], None]), (202, [*v[:9], float("nan")]), (203, [*v[:9], float("-inf")]), (204, []), (205, [1.0, 2.0])]
    more = [(7, v), (7, v), (None, v)]
    got = wh.components(wh.whiten(table(spark, rows + odd + more))).collect()
    assert len(got) == 8 * (100 + 3 + 2) and {r.n for r in got} == {103}
    assert {r.vec_id for r in got if r.whitened is None} == {204, 205} and all(r.deviation is None for r in got if r.whitened is None)
    assert got[0].identity_error < 1e-9


def test_no_variance_and_no_rows(spark):
    got = wh.components(wh.whiten(table(spark, [(i, [0.25] * 9) for i in range(20)]))).collect()
    assert len(got) == 160 and all(r.whitened == 0 and r.explained == 0 and r.deviation == 0 for r in got) and got[0].identity_error == 1
    # three rows span two components at most
    got = wh.components(wh.whiten(table(spark, random_rows(3, 9)))).collect()
    assert {r.component for r in got if r.whitened != 0} == {1, 2}
    got = wh.components(wh.whiten(table(spark, [(1, [1.0, 2.0])]))).collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in got] == [(1, 1, 0, 0.0), (2, 1, 0, 0.0)]
    assert wh.components(wh.whiten(table(spark, [(1, []), (2, [])]))).count() == 0          # no components
    for rows in ([], [(1, None)]):
        got = wh.components(wh.whiten(table(spark, rows)))
        assert got.count() == 0 and set(got.columns) == {"vec_id", "n", "deviation", "identity_error", "component", "whitened", "explained"}


@pytest.mark.parametrize("values", [
    [3, 2, 1, 0.5, 0.25],
    [1, 1, 1, 0.5, 0.5, 0.1],                                  # equal ones: any basis of their space
    [1, 1 + 1e-9, 1 + 1e-12, 0.5, 0.5 + 1e-13, 1e-8, 0],       # single precision sees one value
    [1e6, 1, 1e-3, 1e-3 + 1e-9],
])
def test_eigenvectors_of_clustered_matrices(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(wh.HIGH)
    for _ in range(3):                                          # orthogonal in extended precision
        q = q @ (3 * np.eye(len(values), dtype=wh.HIGH) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, wh.HIGH)) @ q.T
    a = (a + a.T) / 2
    e, x, steps = wh.eigenvectors(a)
    top = max(values)
    assert np.abs(e - np.sort(values)[::-1]).max() <= 4e-16 * top and steps <= 12
    x = x.astype(wh.HIGH)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15
    assert np.abs(x.T @ a @ x - np.diag(e.astype(wh.HIGH))).max() < 1e-15 * top
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(wh.HIGH)
    assert np.abs(single.T @ a @ single - np.diag(np.diag(single.T @ a @ single))).max() > 1e-9 * top


def test_the_covariance_does_not_depend_on_the_partitions(spark):
    df = table(spark, random_rows(200, 12))
    one, many = (wh.whiten(df.repartition(k)).orderBy("vec_id").collect() for k in (1, 7))
    assert [(r.deviation, r.explained) for r in one] == [(r.deviation, r.explained) for r in many]
    # the projection is a product per batch, so its last bits may differ
    assert np.abs(np.array([r.whitened for r in one]) - np.array([r.whitened for r in many])).max() < 1e-13
