import hashlib
import math
import random

import numpy as np

from driftmend.llm.centroids import Search, clustered

SCHEMA = "vec_id long, embedding array<double>, cluster string, vector string, label int"


def expected(rows, k, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    drawn = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centroids = [list(v) for _, v in sorted(kept, key=lambda r: drawn(r[0]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [min((apart(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        of = assigned()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, of, strict=True) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    of = assigned()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for d, c in of if c == j) for j in range(len(centroids))]
    return sorted(((i, c, d, inertia[c], sum(inertia), digests[c]) for (i, _), (d, c) in zip(kept, of, strict=True)), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", 1) for i, v in rows], SCHEMA)


def drawn_rows(n, seed):
    draw = random.Random(seed)
    middles = [[draw.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [m + draw.gauss(0, 0.3) for m in draw.choice(middles)]) for i in range(n)]


def test_agrees_with_brute_force(spark):
    rows = drawn_rows(300, 1)
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 63 + [None]), (304, [1.0] * 63 + [float("nan")]), (305, [float("inf")] * 64)]
    rows += [(306, [-0.0] * 64), (307, [0.0] * 64), (308, [-1e-9] * 64), (309, [100_000.0] * 64), rows[5], rows[5], (None, rows[7][1])]
    found = clustered(table(spark, rows))
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, 8, 10)


def test_few_and_equal_vectors(spark):
    """Fewer vectors than centroids; equal vectors, of which the centroid with the smallest number takes all."""
    rows = drawn_rows(3, 2)
    assert sorted((tuple(r) for r in clustered(table(spark, rows)).collect()), key=str) == expected(rows, 8, 10)
    rows = [(i, [0.5] * 64) for i in range(30)]
    found = clustered(table(spark, rows)).collect()
    assert {r.cluster for r in found} == {0} and {r.inertia for r in found} == {0}


def test_empty_tables(spark):
    assert clustered(table(spark, [])).collect() == []
    found = clustered(table(spark, [(1, None), (2, [1.0])]))
    assert found.collect() == [] and found.columns[:3] == ["vec_id", "cluster", "distance"]


def test_search_is_exact_and_passes_over_far_centroids():
    draw = np.random.default_rng(3)
    centroids = draw.integers(-3000, 3000, (200, 1)) + draw.integers(-200, 200, (200, 64))
    centroids = np.vstack([centroids, centroids[:20]])
    vectors = np.vstack([centroids[draw.integers(0, 220, 500)] + draw.integers(-50, 50, (500, 64)), centroids[:30], np.full((1, 64), 1 << 27), np.full((1, 64), -(1 << 27))])
    found, distance, compared = Search(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (found == every.argmin(axis=1)).all()
    assert compared < 0.2 * every.size
