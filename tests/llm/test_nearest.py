import numpy as np
import pytest
from pyspark.sql import functions as F

from driftmend.llm.nearest import hilbert, nearest


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_places_next_to_each_other_are_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
    order = np.argsort(hilbert(cells, bits))
    assert sorted(hilbert(cells, bits)) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def table(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def brute(vectors, asked, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if asked(q):
            scores = []
            for i, y in good:
                if i != q:
                    s = 0.0
                    for a, b in zip(x, y, strict=True):
                        s += a * b
                    scores.append((-s, i))
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_odd_vectors_ties_and_copies_agree_with_brute_force(spark):
    draw = np.random.default_rng(1)
    vectors = [(i, list(draw.normal(size=4).astype(np.float32))) for i in range(60)]
    vectors += [(100 + i, [1.0, 0.5, 0.0, 0.25]) for i in range(70)]
    vectors += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0, 0, 0]), (205, [float("inf"), 0, 0, 0])]
    expected = brute(vectors, lambda q: q % 20 == 0, 20)
    vectors += [(220, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    found = {}
    for r in nearest(table(spark, vectors), F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found == expected


def test_recall(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(20, 32))
    x = (centres[draw.integers(0, 20, 3000)] + 0.7 * draw.normal(size=(3000, 32))) * draw.uniform(0.5, 2, (3000, 1))
    x = x.astype(np.float32).astype(float)
    rows = nearest(table(spark, list(enumerate(x.tolist()))), F.col("vec_id") % 20 == 0).collect()
    assert len(rows) == 150 * 20
    hits = 0
    for q in range(0, 3000, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({r.vec_id for r in rows if r.query_id == q} & set(np.argsort(-scores)[:20].tolist()))
    assert hits / len(rows) >= 0.9


def test_few_rows_and_none(spark):
    rows = nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0.5)]
    assert nearest(table(spark, [(0, [1.0])]), F.lit(True)).collect() == []
    assert nearest(table(spark, []), F.lit(True)).collect() == []
    assert nearest(table(spark, [(0, None)]), F.lit(True)).collect() == []


def test_a_third_of_the_rows_in_one_jittered_cluster(spark, monkeypatch):
    from driftmend.llm import nearest as module

    compared = module._compared

    def bounded(keep):
        inner = compared(keep)

        def run(left, right):
            assert left.num_rows <= 4 * 64 and right.num_rows <= 2 * 64, (left.num_rows, right.num_rows)
            return inner(left, right)

        return run

    monkeypatch.setattr(module, "BLOCK", 64)
    monkeypatch.setattr(module, "_compared", bounded)
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1800, 16))
    x[::3] = draw.normal(size=16) + 1e-4 * draw.normal(size=(600, 16))
    x = x.astype(np.float32).astype(float)
    rows = nearest(table(spark, list(enumerate(x.tolist()))), F.col("vec_id") % 3 == 0, k=10).collect()
    assert len(rows) == 600 * 10
    hits = 0
    for q in range(0, 1800, 3):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({r.vec_id for r in rows if r.query_id == q} & set(np.argsort(-scores)[:10].tolist()))
    assert hits / len(rows) >= 0.95
