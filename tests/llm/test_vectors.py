"""Exact search against every product, and what the bounds spare."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from assaykit.llm import vectors


def brute(rows, k=5):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in usable]
    out = []
    for at, (q, v) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(whole) if j != at)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string")
    return sorted(map(tuple, vectors.top_inner_products(df, F.col("vec_id") % 50 == 0, **more).collect()))


def test_random_and_copies(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) * (1 + i % 7) for _ in range(12)]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 1000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block=64) == brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (50, [0.0, 0.0]), (1, [1.0, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, []),
        (6, [-1.0, -2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0]), (None, [9.0, 9.0]), (100, [-0.001, 0.001, 2.0]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, None)]) == []
    assert run(spark, []) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(50, [1.0, 2.0]), (50, [1.0, 3.0]), (51, [2.0, 2.0]), (52, [0.5, 1.0]), (52, [4.0, 1.0]), (50, [1.0, 2.0])]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 15 and (50, 1, 50, 7 * 256 * 256) in got


def test_bounds_spare_products():
    rng = np.random.default_rng(4)
    c = np.floor(rng.normal(size=(4000, 32)) * np.linspace(40, 1, 32) * rng.uniform(0.1, 3, (4000, 1)))
    c = c[np.argsort(-(c * c).sum(1))]
    q = c[::200].copy()
    ids = np.arange(4000)
    _, _, basis = np.linalg.svd(c, full_matrices=False)
    got, best, full = vectors.search_tile(ids[::200], q, np.full(20, -np.inf), ids, c, basis.T.copy(), 5, head=8)
    scores = q @ c.T
    scores[np.arange(20), ids[::200]] = -np.inf
    assert np.array_equal(best, -np.sort(-scores, axis=1)[:, :5])
    assert full < 0.3 * scores.size


def test_large_components_are_exact(spark):
    rnd = random.Random(5)
    rows = [(i, [float(np.float32(rnd.choice([1e4, 1e6, 2e6, 1.0]) * rnd.gauss(0, 1))) for _ in range(6)]) for i in range(300)]
    base = [float(np.float32(2.0**22 + i)) for i in range(6)]
    # scores of some 2^62 that differ by less than a double tells apart
    rows += [(300 + i, [*base[:5], i / 256]) for i in range(60)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block=64) == brute(rows)


def test_products_beyond_doubles():
    q = np.array([[2.0**40, 1.0, 3.0], [2.0**31, -(2.0**31), 1.0]])
    c = np.array([[1.0, 2.0**40, 5.0], [2.0**31, 2.0**30, 7.0], [-(2.0**60), 0.0, 0.0], [2.0**60, 1.0, 1.0]])
    exact = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in c] for a in q]
    ends = np.iinfo(np.int64).max
    assert vectors.products(q, c).tolist() == [[max(-ends, min(ends, v)) for v in row] for row in exact]
