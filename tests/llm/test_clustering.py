"""Centroid clustering against plain loops over exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from assaykit.llm import clustering

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, dims, k=clustering.CLUSTERS, rounds=clustering.ROUNDS):
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        top = clustering.LARGEST
        kept.append((key, [math.floor(max(-top, min(top, x * clustering.SCALE))) for x in vector]))
    digest = lambda key: hashlib.sha256(f"3:{key}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]
    centroids = [x for _, x in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [x for (_, x), (_, at) in zip(kept, found) if at == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    total = sum(d for d, _ in found)
    inertia = [sum(d for d, at in found if at == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((key, at, d, inertia[at], total, sha[at]) for (key, _), (d, at) in zip(kept, found)), key=repr
    )


def run(spark, rows, dims, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = clustering.with_digests(*clustering.cluster(df, dims=dims, **more))
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def floats(values):
    return [float(np.float32(v)) for v in values]


def test_groups_ties_and_repeated_rows(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(150):
        centre = rnd.choice([-2, 0, 0.5, 3])
        rows.append((i, floats([centre + rnd.choice([0, 0, rnd.random()]) for _ in range(4)])))
    rows += [(500 + i, floats([1, 1, 1, 1])) for i in range(100)]  # a third of the rows, all equal
    rows += [(500, floats([1, 1, 1, 1])), (500, floats([9, 9, 9, 9])), (3, rows[3][1]), (None, floats([2, 2, 0, 0]))]
    assert run(spark, rows, 4, rounds=5) == brute(rows, 4, rounds=5)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]),
        (7, [1.0, 2.0, 3.0]), (8, [0.5, -0.25]), (9, [-1e30, 1e30]), (10, [0.0, -0.0]),
    ]
    found = run(spark, rows, 2, rounds=2)
    assert [r[0] for r in found] == [10, 8, 9]
    assert found == brute(rows, 2, rounds=2)


def test_empty_table_and_other_columns(spark):
    assert run(spark, [], 2) == []
    assert run(spark, [(1, None)], 2) == []
    df = spark.createDataFrame(
        [(1, [0.0, 1.0], 7, "a", 3)], "vec_id long, embedding array<float>, x int, id string, cluster int"
    )
    found, centroids = clustering.cluster(df, dims=2)
    assert [tuple(r) for r in found.collect()] == [(1, 0, 0, 0, 0)] and centroids.tolist() == [[0, 1024]]


@pytest.mark.parametrize("k", [1, 2, 40])
def test_orchard_search_is_exact_and_prunes(k):
    rng = np.random.default_rng(k)
    centroids = rng.integers(-3, 4, (k, 3)) * 100
    vectors = np.repeat(centroids, 20, axis=0) + rng.integers(-50, 51, (20 * k, 3))
    at, best, measured = clustering.nearest(vectors, centroids, *clustering.neighbour_lists(centroids))
    far = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (best == far.min(1)).all() and (at == far.argmin(1)).all()
    assert measured <= len(vectors) * k and (k < 40 or measured < 0.7 * len(vectors) * k)


def test_orchard_search_at_equal_distances():
    centroids = np.array([[2, 0], [-2, 0], [0, 2], [0, -2], [-2, 0]])
    vectors = np.array([[0, 0], [-2, 0], [-1, 1], [-5, 0]])
    at, best, _ = clustering.nearest(vectors, centroids, *clustering.neighbour_lists(centroids))
    assert at.tolist() == [0, 1, 1, 1] and best.tolist() == [4, 0, 2, 9]
