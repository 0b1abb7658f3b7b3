"""Product codes against plain rounds in Python whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm import vector_codes as vc

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    # names that the operator uses inside
    T.StructField("id", T.StringType()), T.StructField("code", T.IntegerType()), T.StructField("sums", T.StringType()), T.StructField("of", T.StringType()),
])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "i", 1, "s", "o") for i, v, lab in rows], SCHEMA)


def plain(rows, c, dim):
    """``[(id, code, error, label)]`` and the codebooks, by the definition."""
    usable = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = sorted((r for r in usable if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[max(-2 ** 53, min(2 ** 53, math.floor(c.scale * float(np.float32(a))))) for a in v] for _, v, _ in kept]
    cut = [(p * dim // c.parts, (p + 1) * dim // c.parts) for p in range(c.parts)]
    books = [[row[a:b] for row in x[:c.entries]] for a, b in cut]
    dist = lambda u, e: sum((s - t) ** 2 for s, t in zip(u, e))
    nearest = lambda row: [min(range(len(k)), key=lambda j: (dist(row[a:b], k[j]), j)) for (a, b), k in zip(cut, books)]
    for _ in range(c.rounds):
        codes = [nearest(row) for row in x]
        for p, (a, b) in enumerate(cut):
            for j in range(len(books[p])):
                own = [row[a:b] for row, code in zip(x, codes) if code[p] == j]
                if own:
                    books[p][j] = [sum(col) // len(own) for col in zip(*own)]
    out = []
    for (i, _, lab), row in zip(kept, x):
        code = nearest(row)
        out.append((i, "".join(f"{j:02x}" for j in code), min(vc.LARGEST, sum(dist(row[a:b], k[j]) for (a, b), k, j in zip(cut, books, code))), lab))
    return out, books


def same(spark, rows, c=vc.Coding(), dim=16):
    want, books = plain(rows, c, dim)
    errors = {}
    for _, _, e, lab in want:
        errors[lab] = errors.get(lab, 0) + e
    got = vc.code_report(table(spark, rows), c).where("code is not null").collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=key) == sorted(
        ((i, code, e, min(vc.LARGEST, errors[lab])) for i, code, e, lab in want), key=key)
    assert {r.codebooks_sha256 for r in got} == {vc.books_sha256(books)}
    return got


def random_rows(n, dim=16, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (12, dim))
    return [(i, [float(np.float32(v)) for v in middles[i % 12] + rng.normal(0, spread, dim)], None if i % 7 == 0 else i % 3) for i in range(n)]


def test_codes_equal_plain_rounds(spark):
    got = same(spark, random_rows(400))
    # bounds settle most parts without a scan of the codebook
    assert sum(r.scans for r in got) < 0.7 * len(got) * 8 * 7


def test_odd_rows(spark):
    rows = random_rows(60, seed=2)
    v = rows[0][1]
    rows += [(100, None, 1), (101, [*v[:15], None], 1), (102, [*v[:15], float("nan")], 1), (103, [*v[:15], float("inf")], None),
             (5, v, 1), (5, v, 1), (None, v, 2), (None, rows[3][1], 2), (-9, [0.0] * 16, None), (104, [], 1), (105, [1.0] * 7, 2)]
    same(spark, rows)
    got = vc.code_report(table(spark, rows)).where("code is null").collect()
    assert sorted(r.vec_id for r in got) == [104, 105] and all(r.error is None for r in got)


@pytest.mark.parametrize("size", [5e4, 1e30])
def test_very_large_components_stay_exact(spark, size):
    rows = random_rows(50, seed=3)
    rows += [(200 + i, [x * size * (i % 3 - 1) for x in v], 1) for i, v, _ in random_rows(20, seed=4)]
    same(spark, rows)


def test_few_equal_and_no_rows(spark):
    same(spark, random_rows(5))
    same(spark, [(i, [0.5] * 16, 1) for i in range(40)])
    same(spark, [(i, [float(i % 5)] * 5, None) for i in range(30)], dim=5)         # fewer components than parts
    same(spark, [(1, [], None), (2, [], 3)], dim=0)                                # vectors without components
    for rows in ([], [(1, None, 1)]):
        got = vc.code_report(table(spark, rows))
        assert got.count() == 0 and got.columns[:5] == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_bounds_move_by_the_net_displacement():
    """An entry that went and came back has moved by nothing, not by the sum of its moves."""
    h = vc.History([[[0, 0], [50, 0]], [[40, 0], [50, 0]], [[0, 0], [50, 0]]], 2)
    assert h.own[0].tolist() == [0, 0] and h.own[1].tolist() == [40, 0] and h.others[1].tolist() == [0, 40]
    x = np.array([[1.0, 0], [49.0, 0]])
    code, bound, scanned = vc.assign_part(x, vc.History([[[0, 0], [50, 0]]], 2), None, None)
    assert scanned.all() and code.tolist() == [0, 1]
    code, _, scanned = vc.assign_part(x, h, code, bound)
    assert code.tolist() == [0, 1] and not scanned.any()


def test_decompressed_vectors_are_near(spark):
    df = table(spark, random_rows(400, spread=0.05))
    coded, books = vc.compress(df)
    back = vc.decompress(coded, books).join(df.select(F.col("vec_id").alias("id"), "embedding"), "id").collect()
    off = np.array([np.linalg.norm(np.array(r.approximate) - np.array(r.embedding)) for r in back])
    error = np.array([math.sqrt(r.error) / 4096 for r in back])
    assert len(back) == 400 and np.abs(off - error).max() < 4 * 16 / 4096 and np.median(off) < 1
