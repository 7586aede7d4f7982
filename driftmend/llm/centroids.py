"""Centroid clustering in whole numbers, with the nearest centroid found by equal-average equal-variance search.

Centroids are sorted by the mean of their components. A vector's search begins where its own mean would stand and goes
outward, the nearer mean first. For vectors x and c of d components with means m and deviations v (the norm of what is
left after taking off the mean), |x - c|^2 >= d (m_x - m_c)^2 + (v_x - v_c)^2. By the first term alone the search ends
as soon as the means are too far apart, since they only get farther; by both a centroid is passed over. What is
left is compared exactly, in whole numbers, and of equal distances the smaller number wins.

A round is one pass: tasks search and add up their own vectors, and a sum per task, centroid and component is shuffled.
Only the centroids, as many as asked for, come to the driver, which divides; rows and assignments never do.

Defined cases: vectors that are NULL, of another length, or with a NULL or non-finite component take no part; fewer
vectors than centroids give as many centroids as there are vectors; rows without an id are clustered and start a centroid
last; repeated rows are vectors of their own; a centroid without vectors stays where it is; an empty table
gives no rows. Components beyond 2^27 after scaling raise an error, as their distances need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.sources.sinks import staged

#: The largest component after scaling: 64 squares of differences of such fit a long.
LARGEST = 1 << 27
#: Vectors searched at a time.
BLOCK = 4096
#: Room for rounding in the two inequalities, which decide what is compared but never the result.
SLACK = 1e-9
FAR = np.iinfo(np.int64).max
HALF = 31


class Search:
    """The centroids (k x d whole numbers), sorted by the mean of their components."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.numbers = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.numbers]
        self.sums = sums[self.numbers]
        self.deviations = _deviations(self.centroids, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance) of each vector, and how many distances that took."""
        n, d = vectors.shape
        k = len(self.sums)
        sums = vectors.sum(axis=1)
        deviations = _deviations(vectors, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, found = np.full(n, FAR), np.full(n, k)
        compared, rows = 0, np.arange(n)
        while len(rows):
            low, high = left[rows], right[rows]
            down = np.where(low >= 0, sums[rows] - self.sums[np.maximum(low, 0)], FAR)
            up = np.where(high < k, self.sums[np.minimum(high, k - 1)] - sums[rows], FAR)
            downward = down <= up
            gap, at = np.where(downward, down, up), np.where(downward, low, high)
            left[rows] -= downward
            right[rows] += ~downward
            apart = gap.astype(np.float64) ** 2 / d
            going = (gap < FAR) & (apart <= best[rows] * (1 + SLACK) + 1)
            rows, at, apart = rows[going], at[going], apart[going]
            a, b = deviations[rows], self.deviations[at]
            uneven = np.maximum(np.abs(a - b) - SLACK * (1 + a + b + np.abs(sums[rows])), 0)
            near = apart + uneven**2 <= best[rows] * (1 + SLACK) + 1
            r, c = rows[near], at[near]
            distance = ((vectors[r] - self.centroids[c]) ** 2).sum(axis=1)
            number = self.numbers[c]
            better = (distance < best[r]) | ((distance == best[r]) & (number < found[r]))
            best[r[better]], found[r[better]] = distance[better], number[better]
            compared += len(r)
        return found, best, compared


def _deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - (sums / vectors.shape[1])[:, None]) ** 2).sum(axis=1))


def integer_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, vector): the vectors that take part, as ``dims`` whole numbers of four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False))
            cells = batch.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
            whole = np.isfinite(cells).all(axis=1)
            scaled = np.floor(cells[whole] * scale)
            if scaled.size and np.abs(scaled).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}; distances would not fit a long")
            width, m = 4 * dims, len(scaled)
            if not m:
                continue
            packed = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(np.arange(0, (m + 1) * width, width, dtype=np.int32)), pa.py_buffer(scaled.astype("<i4"))])
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(whole)), packed], names=["vec_id", "vector"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, vector binary")


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    for low in range(0, batch.num_rows, BLOCK):
        part = batch.column("vector").slice(low, BLOCK)
        yield low, np.frombuffer(b"".join(part.to_pylist()), dtype="<i4").reshape(-1, dims).astype(np.int64)


def _totals(rows: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[list[int]], list[int]]:
    """Of each centroid's vectors: their number, the sums of their components, the sum of their distances."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, sums = Search(centroids), np.zeros((k, dims + 3), np.int64)
        for batch in batches:
            for _, block in _blocks(batch, dims):
                found, distance, _ = search.nearest(block)
                facts = np.column_stack([block, np.ones(len(block), np.int64), distance >> HALF, distance & ((1 << HALF) - 1)])
                for c in np.unique(found):
                    sums[c] += facts[found == c].sum(axis=0)
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[cluster, place])], names=["cluster", "place", "total"])

    each = rows.select("vector").mapInArrow(run, "cluster int, place int, total long")
    sums = [[0] * (dims + 3) for _ in range(k)]
    for row in each.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        sums[row.cluster][row.place] = int(row.total)
    return [s[dims] for s in sums], [s[:dims] for s in sums], [(s[dims + 1] << HALF) + s[dims + 2] for s in sums]


def starting_centroids(rows: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of ``seed:vec_id``; rows without an id come last."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), "vector").limit(k).collect()
    return np.array([np.frombuffer(r.vector, dtype="<i4") for r in first], dtype=np.int64).reshape(-1, dims)


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row per vector: its ``cluster``, the squared ``distance`` to the centroid, the sums of these over its cluster
    and over all, and the centroid's digest."""
    rows = staged(integer_vectors(vectors, dims, scale), "vectors")
    centroids = starting_centroids(rows, k, seed, dims)
    kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], kind)
    for _ in range(rounds):
        counts, sums, _ = _totals(rows, centroids)
        moved = np.array([[s // n for s in own] if n else old for n, own, old in zip(counts, sums, centroids.tolist(), strict=True)], dtype=np.int64)
        if (moved == centroids).all():
            break
        centroids = moved
    _, _, inertias = _totals(rows, centroids)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, own, every = Search(centroids), pa.array(inertias, pa.int64()), pa.scalar(sum(inertias), pa.int64())
        for batch in batches:
            for low, block in _blocks(batch, dims):
                found, distance, _ = search.nearest(block)
                at = pa.array(found)
                columns = [batch.column("vec_id").slice(low, BLOCK), at.cast(pa.int32()), pa.array(distance), own.take(at), pa.repeat(every, len(block)), pa.array(digests).take(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return rows.mapInArrow(run, kind)


def oracle_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same by comparing every vector with every centroid."""
    parts = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dims})""",
        f"cells AS MATERIALIZED (SELECT r, unnest(range(1, {dims + 1})) AS i, unnest(v) AS x FROM kept)",
        f"""starts AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS c FROM kept)""",
        f"c0 AS MATERIALIZED (SELECT c, i, x FROM starts JOIN cells USING (r) WHERE c < {k})",
    ]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (
    SELECT r, c, d FROM (SELECT r, c, sum((v.x - c{t}.x) * (v.x - c{t}.x)) AS d FROM cells v JOIN c{t} USING (i) GROUP BY r, c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (
    SELECT c, i, coalesce(m, x) AS x FROM c{t} LEFT JOIN (
        SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
            SELECT c, i, sum(x) AS s, count(*) AS n FROM a{t} JOIN cells USING (r) GROUP BY c, i)) USING (c, i))""")
    last = rounds
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{last} a JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c) USING (c)
"""
