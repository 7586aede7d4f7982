"""Nearest neighbours by inner product along shifted Hilbert curves.

Every vector is projected to a few random dimensions, shifted, and ordered by its place on a Hilbert curve; several
projections and shifts give several orderings. Vectors of one place are ordered by a hash of their id, so that each
ordering is cut into blocks of about BLOCK rows however many share a place. A query is compared with all blocks of its
own place and those around. What the orderings find is merged, scored on the original vectors and ranked.

The width of the window is a share of all vectors: the least one with which a bounded sample reaches the asked recall
against brute force. In a smaller sample neighbours are further apart, so the sample errs towards wide windows.
Vectors without structure need wide ones; then most pairs are compared, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmend.llm.texts import mixed
from driftmend.sources.sinks import staged

BLOCK = 4096
LEAST_BLOCKS = 16
SPARE = 4


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2**bits, (points, dimensions)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of ever smaller cells
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


@dataclass(frozen=True)
class Curves:
    """``count`` orderings of vectors of one length."""

    axes: np.ndarray  # (curves, length + 1, dimensions)
    low: np.ndarray  # (curves, dimensions)
    step: np.ndarray  # (curves, dimensions)
    bits: int
    reach: float  # the longest vector's length

    @staticmethod
    def fitted(sample: np.ndarray, reach: float, count: int, dimensions: int, bits: int, seed: int) -> Curves:
        draw = np.random.default_rng(seed)
        axes = draw.normal(size=(count, sample.shape[1] + 1, dimensions))
        low, step = np.zeros((count, dimensions)), np.ones((count, dimensions))
        raised = Curves.raised(sample, reach)
        for c in range(count):
            seen = raised @ axes[c]
            below, above = np.quantile(seen, 0.005, axis=0), np.quantile(seen, 0.995, axis=0)
            # The grid is wider than the points by a quarter, and shifted by up to that.
            width = np.maximum(above - below, 1e-12) * 1.25
            step[c] = width / (1 << bits)
            low[c] = below - draw.random(dimensions) * 0.2 * width
        return Curves(axes, low, step, bits, reach)

    @staticmethod
    def raised(vectors: np.ndarray, reach: float) -> np.ndarray:
        """One more coordinate gives all vectors one length, so that near and large inner product agree."""
        squares = np.einsum("ij,ij->i", vectors, vectors)
        return np.column_stack((vectors, np.sqrt(np.maximum(reach * reach - squares, 0))))

    def places(self, vectors: np.ndarray, as_queries: bool) -> np.ndarray:
        """(vectors, curves): the place of each vector on each curve; a query is stretched to the full length."""
        if as_queries:
            sizes = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            raised = np.column_stack((vectors * (self.reach / sizes)[:, None], np.zeros(len(vectors))))
        else:
            raised = self.raised(vectors, self.reach)
        out = []
        for axes, low, step in zip(self.axes, self.low, self.step, strict=True):
            cells = np.clip(np.floor((raised @ axes - low) / step), 0, (1 << self.bits) - 1)
            out.append(hilbert(cells, self.bits))
        return np.stack(out, axis=1)


def window_share(curves: Curves, sample: np.ndarray, k: int, recall: float, queries: int = 256) -> float:
    """The least share of vectors on either side of a query that reaches ``recall`` among the sample's own vectors."""
    n = len(sample)
    if n <= k + 1:
        return 1.0
    chosen = np.unique(np.linspace(0, n - 1, min(queries, n)).astype(np.int64))
    scores = sample[chosen] @ sample.T
    scores[np.arange(len(chosen)), chosen] = -np.inf
    nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    own, asked = curves.places(sample, False), curves.places(sample[chosen], True)
    gap = np.full(nearest.shape, n)
    for c in range(own.shape[1]):
        order = np.sort(own[:, c])
        at, mine = np.searchsorted(order, own[:, c]), np.searchsorted(order, asked[:, c])
        gap = np.minimum(gap, np.abs(at[nearest] - mine[:, None]))
    return float(min(1.0, (np.quantile(gap, recall) + 1) / n))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _spread(ids: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` bits of a hash of each id."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _placed(vectors: DataFrame, curves: Curves, as_queries: bool, spare: int) -> DataFrame:
    """(curve, id, place, vector) of each vector on each curve; the last ``spare`` bits of place are of the id's hash."""
    shared = vectors.sparkSession.sparkContext.broadcast(curves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 8192) for i in range(0, batch.num_rows, 8192)):
                places = shared.value.places(_matrix(part.column(1)), as_queries) << spare | _spread(part.column(0).to_numpy(), spare)[:, None]
                for c in range(places.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), c, np.int32)), part.column(0), pa.array(places[:, c]), part.column(1)], names=["curve", "id", "place", "vector"]
                    )

    return vectors.select("id", "vector").mapInArrow(run, "curve int, id long, place long, vector array<double>")


def _reached(cuts: np.ndarray, n_blocks: int, chunk: int, side: int, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last block that each chunk of query blocks is compared with.

    These are ``side`` blocks around all blocks of the places that the chunk holds.
    """
    first = np.arange(0, n_blocks, chunk)
    last = np.minimum(first + chunk, n_blocks) - 1
    begin = np.where(first > 0, cuts[np.maximum(first - 1, 0)] >> spare << spare, np.iinfo(np.int64).min)
    end = np.where(last < n_blocks - 1, cuts[np.minimum(last, n_blocks - 2)] | ((1 << spare) - 1), np.iinfo(np.int64).max)
    low = np.minimum(np.searchsorted(cuts, begin, "right"), first) - side
    high = np.maximum(np.searchsorted(cuts, end, "right"), last) + side
    return np.maximum(low, 0), np.minimum(high, n_blocks - 1)


def _compared(keep: int):
    """The best ``keep`` candidates of each query of a cell; a cell has about a block of each."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "candidate", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "candidate": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        left, right = left.combine_chunks(), right.combine_chunks()
        ids, candidates = left.column("id").to_numpy(), right.column("id").to_numpy()
        among = _matrix(right.column("vector").chunk(0))
        asked = _matrix(left.column("vector").chunk(0))
        found = []
        for i in range(0, len(ids), 512):
            scores = asked[i : i + 512] @ among.T
            k = min(keep, scores.shape[1])
            best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            found.append((np.repeat(ids[i : i + 512], k), candidates[best].ravel(), np.take_along_axis(scores, best, axis=1).ravel()))
        return pa.table(dict(zip(names, (np.concatenate(x) for x in zip(*found, strict=True)), strict=True)))

    return run


def inner_product(a: Column, b: Column) -> Column:
    """Products added from the first to the last, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda sum, x: sum + x)


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, curves: int = 8, dimensions: int = 4, bits: int = 8, recall: float = 0.93, sample: int = 4096, seed: int = 9
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows found nearest to each row that ``queries`` picks, but itself.

    ``vectors`` has vec_id and embedding. Nearest is the largest inner product, ties go to the smaller vec_id. Rows
    without an id, and vectors that are null, empty, zero, of another length than most, or hold null or non-finite
    numbers take no part. Equal vectors are searched for once; of each, the k + 1 smallest ids can be a result. A
    query with fewer candidates than k gets them all. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = vectors.select(F.col("vec_id").cast("long"), vector.alias("vector"), queries.alias("asked"))
    sound = sound.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    by_length = sound.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if by_length is None:
        return spark.createDataFrame([], schema)
    sound = staged(sound.where(F.size("vector") == by_length.n), "vectors")

    each = staged(sound.groupBy("vector").agg(F.min("vec_id").alias("id"), F.max("asked").alias("asked")), "distinct")
    drawn = each.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toPandas()
    points = np.array(drawn["vector"].tolist(), np.float64)
    stats = each.agg(F.count("*").alias("n"), F.sqrt(F.max(inner_product(F.col("vector"), F.col("vector")))).alias("reach")).first()
    shape = Curves.fitted(points, stats.reach, curves, dimensions, bits, seed)
    share = window_share(shape, points, min(k, max(1, len(points) - 1)), recall)

    # Cuts by quantiles of each curve; a block's rows are about BLOCK, a cell is some blocks of queries by one block.
    # Cuts are exact to 53 bits, so hashes of more bits could not cut a place further.
    spare = max(0, min(31, 53 - dimensions * bits))
    places = staged(_placed(each, shape, False, spare), "places")
    n_blocks = max(LEAST_BLOCKS, -(-stats.n // BLOCK))
    inner = F.array(*[F.lit(i / n_blocks) for i in range(1, n_blocks)])
    cuts = places.groupBy("curve").agg(F.percentile_approx("place", inner, 20 * n_blocks).alias("cuts")).collect()
    side = int(np.ceil(share * n_blocks))
    chunk = 2
    cuts = {r.curve: np.array(r.cuts, np.int64) for r in cuts}
    # Queries lie elsewhere than vectors do: those of a chunk are dealt to as many parts as they fill.
    wanted = staged(_placed(each.where("asked"), shape, True, spare), "asked")
    n_parts = {c: np.zeros(-(-n_blocks // chunk), np.int64) for c in cuts}
    shared = spark.sparkContext.broadcast(cuts)

    def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = np.zeros(len(curve), np.int64)
            for c, edges in shared.value.items():
                own[curve == c] = np.searchsorted(edges, place[curve == c], "right") // chunk
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], names=["curve", "chunk"])

    for r in wanted.select("curve", "place").mapInArrow(chunks_of, "curve int, chunk long").groupBy("curve", "chunk").count().collect():
        n_parts[r.curve][r.chunk] = -(-r["count"] // (chunk * BLOCK))
    windows = spark.sparkContext.broadcast({c: (own, *_reached(own, n_blocks, chunk, side, spare), n_parts[c]) for c, own in cuts.items()})

    def dealt(as_queries: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                curve, place = batch.column("curve").to_numpy(), batch.column("place").to_numpy()
                block, low, high = (np.zeros(len(curve), np.int64) for _ in range(3))
                # A chunk of query blocks is compared with all blocks that any of its queries' windows reaches.
                for c, (own, begin, end, _) in windows.value.items():
                    on = curve == c
                    block[on] = np.searchsorted(own, place[on], "right")
                    if as_queries:
                        low[on], high[on] = begin[block[on] // chunk], end[block[on] // chunk]
                    else:
                        low[on], high[on] = np.searchsorted(end, block[on], "left"), np.searchsorted(begin, block[on], "right") - 1
                times = high - low + 1
                row = np.repeat(np.arange(len(curve)), times)
                other = np.repeat(low, times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                own = (block // chunk if as_queries else block)[row]
                chunks, blocks = (own, other) if as_queries else (other, own)
                times = np.zeros(len(row), np.int64)
                for c, (_, _, _, parts) in windows.value.items():
                    on = curve[row] == c
                    times[on] = parts[chunks[on]]
                if as_queries:
                    share = _spread(batch.column("id").to_numpy(), 62)[row] // (1 << 31) % times
                else:
                    again = np.repeat(np.arange(len(row)), times)
                    share = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                    row, chunks, blocks = row[again], chunks[again], blocks[again]
                for i in range(0, len(row), 8192):
                    part = pa.array(row[i : i + 8192])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("curve").take(part), pa.array(chunks[i : i + 8192]), pa.array(blocks[i : i + 8192]), pa.array(share[i : i + 8192]), batch.column("id").take(part), batch.column("vector").take(part)],
                        names=["curve", "chunk", "block", "share", "id", "vector"],
                    )

        return run

    cell = "curve int, chunk long, block long, share long, id long, vector array<double>"
    asked = wanted.mapInArrow(dealt(True), cell).groupBy("curve", "chunk", "block", "share")
    among = places.mapInArrow(dealt(False), cell).groupBy("curve", "chunk", "block", "share")
    keep = k + 1 + SPARE
    found = asked.cogroup(among).applyInArrow(_compared(keep), "query long, candidate long, score double")
    merged = found.groupBy("query", "candidate").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "candidate")
    merged = staged(merged.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep).select("query", "candidate"), "candidates")

    of = lambda name: each.select(F.col("id").alias(name), F.col("vector").alias(f"v_{name}"))
    exact = merged.join(of("query"), "query").join(of("candidate"), "candidate")
    exact = exact.select("query", "candidate", inner_product(F.col("v_query"), F.col("v_candidate")).alias("score"))
    named = sound.join(each.select("vector", "id"), "vector").select("vec_id", "id", "asked")
    first = Window.partitionBy("id").orderBy("vec_id")
    members = named.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).select(F.col("id").alias("candidate"), "vec_id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = exact.join(members, "candidate").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    own = named.where("asked").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
    rows = own.join(top.select("query", "vec_id", "score"), "query").where("query_id <> vec_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
