"""Near-duplicate documents by SetSketch.

A document is the set of its word shingles. Its sketch holds, per register, the least of the set's exponential
variates on a logarithmic scale cut to 16 bits: a union's register is the greater of the two, and two registers are
equal with about the Jaccard similarity of the sets. Bands of registers propose pairs, the likelihood of all
registers together rules out pairs that cannot be similar enough, and full shingle sets decide.

How pairs are found without forming all pairs of a group:

1. Documents with equal sets fold into one class by a 128-bit digest.
2. Within a band's bucket each class meets the bucket's smallest class only.
3. Buckets that then still hold several components are cut into blocks; in cells of two blocks, classes outside the
   bucket's largest component meet all classes of other components. A pair is tested in the first band it shares and in
   no other, and of the links found a class reports one to each component.

So any two classes that share a band are compared unless they already are in one component, and what is written is
links, not pairs. Sets travel as sorted hashes of 40 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import expm1, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.llm.graph import components, joined_components
from driftmend.llm.texts import LOWER, NOT_BLANK, binary_array, long_array, mixed, numbers, pieces, words_of
from driftmend.sources.sinks import staged

BLOCK = 1024
#: Rows of cells that one call gets, about.
ROWS = 20_000


@dataclass(frozen=True)
class SetSketch:
    """``bands`` bands of ``rows`` registers; register values are powers of ``base``, cut to 0..65535.

    ``slack``: how much less likely than the best one the asked similarity may be (natural logarithm) before a pair is
    ruled out; 18 is six standard deviations.
    """

    rows: int = 5
    bands: int = 20
    base: float = 1.001
    rate: float = 20.0
    slack: float = 18.0

    @property
    def registers(self) -> int:
        return self.rows * self.bands

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """The sketch of a set of hashes; an empty set's registers are 0."""
        if not len(shingles):
            return np.zeros(self.registers, np.uint16)
        factors, shifts = numbers(7, self.registers) | np.uint64(1), numbers(8, self.registers)
        least = np.full(self.registers, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingles), 512):
            part = shingles[i : i + 512, None] * factors
            part += shifts
            np.minimum(least, part.min(axis=0), out=least)
        variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / self.rate
        return np.clip(np.floor(1 - np.log(variate) / log(self.base)), 0, 65535).astype(np.uint16)

    @staticmethod
    def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The sketch of the union of two sets."""
        return np.maximum(a, b)

    def log_likelihood(self, more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of similarity ``j``, where ``more`` registers are greater and ``less`` smaller; n and m are the set sizes."""

        def probability(x):
            return -np.log1p(x * expm1(-log(self.base))) / log(self.base)

        share = n / (n + m)
        up = np.clip(probability(share - (1 - share) * j), 1e-12, 1)
        down = np.clip(probability((1 - share) - share * j), 1e-12, 1)
        equal = np.clip(1 - up - down, 1e-12, 1)
        return more * np.log(up) + less * np.log(down) + (self.registers - more - less) * np.log(equal)

    def estimate(self, more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The most likely similarity, found by golden sections between 0 and the ratio of the sizes."""
        low, high = np.zeros(np.shape(more)), np.minimum(n / m, m / n) * np.ones(np.shape(more))
        ratio = 0.6180339887498949
        for _ in range(24):
            left, right = high - ratio * (high - low), low + ratio * (high - low)
            better = self.log_likelihood(more, less, n, m, left) > self.log_likelihood(more, less, n, m, right)
            low, high = np.where(better, low, left), np.where(better, right, high)
        return (low + high) / 2

    def plausible(self, more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(whether similarity may reach ``least``, the most likely similarity)"""
        n, m = n.astype(np.float64), m.astype(np.float64)
        found = self.estimate(more, less, n, m)
        most = np.minimum(n / m, m / n)
        gap = self.log_likelihood(more, less, n, m, found) - self.log_likelihood(more, less, n, m, np.minimum(least, most))
        return (most >= least - 1e-9) & ((found >= least) | (gap <= self.slack)), found


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a piece."""
    words = words_of(LOWER[data], offsets, NOT_BLANK)
    hashes = words.hashes()
    factors = numbers(11, k + 1) | np.uint64(1)
    window = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for i in range(k):
        window += hashes[i : len(hashes) - k + 1 + i] * factors[i]
    window = mixed(window)
    for low, high in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if high - low >= k:
            own = np.sort(window[low : high - k + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif high > low:
            parts = np.append(hashes[low:high] * factors[: high - low], factors[high - low])
            yield mixed(parts.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.zeros(0, np.uint64)


def signatures(docs: DataFrame, k: int, sketch: SetSketch) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, sketch) of each row; d1 and d2 are a digest of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = numbers(13, 2)
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                sizes, digests, sketches = [], [], []
                for own in shingle_sets(data, offsets, k):
                    sizes.append(len(own))
                    digests.append((mixed(own ^ first).sum(dtype=np.uint64), mixed(own + second).sum(dtype=np.uint64)))
                    sketches.append(sketch.of(own).tobytes())
                both = np.array(digests, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(sizes, pa.int64()), long_array(both[:, 0]), long_array(both[:, 1]), binary_array(sketches)],
                    names=["doc_id", "n_shingles", "d1", "d2", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary"
    )


def _packed(shingles: np.ndarray) -> bytes:
    """40 bits of each hash, sorted."""
    short = np.sort(shingles >> np.uint64(24))
    return np.ascontiguousarray(short.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _full(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, sketch, shingles) of the classes ``wanted`` (node, n, d1, sketch), from the text of their smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = numbers(13, 2)[0]
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(4)):
                node, n, d1, sketch = (c.slice(low, high - low) for c in batch.columns[:4])
                rows = list(shingle_sets(data, offsets, k))
                digest = np.array([mixed(own ^ first).sum(dtype=np.uint64) for own in rows], np.uint64).view(np.int64)
                # Another text under the same id is of another class.
                same = pa.array(digest == d1.to_numpy())
                columns = [node, n, sketch, binary_array([_packed(own) for own in rows])]
                yield pa.RecordBatch.from_arrays([c.filter(same) for c in columns], names=["node", "n", "sketch", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string"))
    joined = wanted.join(texts, "node").select("node", "n", "d1", "sketch", "text")
    return joined.mapInArrow(run, "node long, n long, sketch binary, shingles binary").distinct()


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    begins = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat((one[at] == flat).astype(np.int64), begins)


def _marks(column: pa.Array, sketch: SetSketch) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, sketch.registers)


def _star_links(pairs: DataFrame, full: DataFrame, sketch: SetSketch, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sketches leave it possible and whose sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                x, y = _marks(part.column(4), sketch), _marks(part.column(5), sketch)
                n, m = part.column(2).to_numpy(), part.column(3).to_numpy()
                keep, _ = sketch.plausible((x > y).sum(axis=1), (x < y).sum(axis=1), n, m, percent / 100)
                for i in np.flatnonzero(keep):
                    common = _common(_unpacked(part.column(6)[i].as_py()), [_unpacked(part.column(7)[i].as_py())])[0]
                    keep[i] = 100 * common >= percent * (n[i] + m[i] - common)
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in part.columns[:2]], names=["a", "b"])

    sides = [full.select(F.col("node").alias(e), *[F.col(c).alias(f"{c}_{e}") for c in ("n", "sketch", "shingles")]) for e in ("a", "b")]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def _cell_links(cells: DataFrame, full: DataFrame, sketch: SetSketch, percent: int) -> DataFrame:
    """Links (a, b) between a cell's ``outer`` classes and its other ones, one to each component.

    A cell holds at most about two blocks; many small ones are put through together.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("band", "ascending"), ("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("outer", "descending")])
        outer = table.column("outer").to_numpy(zero_copy_only=False)
        band, key, i, j, node, comp, size, hub = (table.column(c).to_numpy() for c in ("band", "key", "i", "j", "node", "component", "n", "hub"))
        marks = _marks(table.column("sketch"), sketch)
        packed = table.column("shingles")
        cell = np.cumsum(np.concatenate(([0], (np.diff(band) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0))))
        ends = np.concatenate((np.flatnonzero(np.diff(cell)) + 1, [len(cell)]))
        middles = ends - np.bincount(cell, weights=~outer).astype(np.int64)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # Outer classes in turn, so many at a time that their pairs fill a small array. The hub has met everyone.
        asked = np.flatnonzero(outer & (node != hub))
        times = ends[cell[asked]] - middles[cell[asked]]
        turn = np.cumsum(times) // 16384
        sets: dict[int, np.ndarray] = {}
        for t in np.unique(turn):
            own, many = asked[turn == t], times[turn == t]
            u = np.repeat(own, many)
            v = np.repeat(middles[cell[own]], many) + np.arange(len(u)) - np.repeat(np.cumsum(many) - many, many)
            apart = (comp[u] != comp[v]) & (node[v] != hub[u]) & (100 * np.minimum(size[u], size[v]) >= percent * np.maximum(size[u], size[v]))
            u, v = u[apart], v[apart]
            # Only the first band that two classes share tests them.
            together = (marks[u] == marks[v]).reshape(len(u), sketch.bands, sketch.rows).all(axis=2)
            first = together.argmax(axis=1) == band[u]
            u, v = u[first], v[first]
            keep, _ = sketch.plausible((marks[u] > marks[v]).sum(axis=1), (marks[u] < marks[v]).sum(axis=1), size[u], size[v], percent / 100)
            u, v = u[keep], v[keep]
            if not len(u):
                continue
            if sum(map(len, sets.values())) > 1 << 22:
                sets.clear()
            for x in {*u.tolist(), *v.tolist()} - sets.keys():
                sets[x] = _unpacked(packed[x].as_py())
            begins = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
            for low, high in zip(begins, [*begins[1:], len(u)], strict=True):
                x, others = u[low], v[low:high]
                common = _common(sets[x], [sets[y] for y in others.tolist()])
                others = others[100 * common >= percent * (size[x] + size[others] - common)]
                others = others[np.unique(comp[others], return_index=True)[1]]
                found_a.append(np.full(len(others), node[x]))
                found_b.append(node[others])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    calls = max(1, -(-cells.count() // ROWS))
    group = F.pmod(F.xxhash64("band", "key", "i", "j"), F.lit(calls))
    return cells.join(full, "node").withColumn("_group", group).groupBy("_group").applyInArrow(run, "a long, b long")


def _cells(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to cells of an outer and an any block."""
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = placed.groupBy("band", "key", "component").agg(F.count("*").alias("c"))
    buckets = each.groupBy("band", "key").agg(
        F.count("*").alias("n_components"), F.sum("c").alias("n_all"), F.max(F.struct("c", "component")).alias("top")
    )
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ones = buckets.where("n_components > 1 AND n_all > 2").select(
        "band",
        "key",
        F.col("top.component").alias("main"),
        blocks(F.col("n_all") - F.col("top.c")).alias("outer_blocks"),
        blocks(F.col("n_all")).alias("all_blocks"),
    )
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    inside = placed.join(open_ones, ["band", "key"])
    outer = inside.where("component <> main").select(
        "*", F.lit(True).alias("outer"), block(F.col("outer_blocks")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j")
    )
    anyone = inside.select(
        "*", F.lit(False).alias("outer"), F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)).alias("i"), block(F.col("all_blocks")).alias("j")
    )
    return staged(outer.unionByName(anyone).select("band", "key", "i", "j", "outer", "node", "component", "hub"), "cells")


def classes_and_components(docs: DataFrame, k: int, percent: int, sketch: SetSketch) -> tuple[DataFrame, DataFrame]:
    """(signatures with class ids, components of classes); both are written tables."""
    signed = staged(signatures(docs, k, sketch), "signatures")
    full_rows = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    head = F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("head")
    heads = staged(full_rows.groupBy("d1", "d2").agg(head).select("d1", "d2", "head.*"), "classes")
    digests = heads.select("d1", "d2", F.col("doc_id").alias("node"))

    width = 2 * sketch.rows
    parts = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("sketch", 1 + width * i, width)).alias("key")) for i in range(sketch.bands)]
    banded = heads.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.explode(F.array(*parts)).alias("b"))
    banded = banded.select("node", "n", "b.band", "b.key")
    shared = banded.groupBy("band", "key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("c")).where("c > 1")
    shared = shared.select("band", "key", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    members = staged(banded.join(shared, ["band", "key"]), "members")
    wanted = heads.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "d1", "sketch")
    full = staged(_full(docs, wanted.join(members.select("node").distinct(), "node", "left_semi"), k), "shingles")

    # Sizes alone bound the similarity.
    near = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    star = members.where((F.col("node") != F.col("hub")) & near).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    found = staged(components(_star_links(star, full, sketch, percent)), "components")
    cells = _cells(members, found)
    more = staged(_cell_links(cells, full, sketch, percent), "links")
    if not more.isEmpty():
        found = staged(joined_components(found, more), "components")
    return signed.join(digests, ["d1", "d2"], "left"), found


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, sketch: SetSketch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text, ...).

    Words are runs of anything but blanks, with A-Z lower-cased; the set of a text with fewer than ``shingle`` words is
    the whole sequence. Two documents are linked if 100 * intersection >= percent * union of their sets. component_id
    is the smallest doc_id that links reach, kept says that it is the row's own.

    A null or blank text has 0 shingles and is linked with nothing. A row without doc_id is not compared: component_id
    is null and it is kept. Repeated rows each get their row. Other columns of ``docs`` play no part; an empty table
    gives an empty one.
    """
    sketch = sketch or SetSketch()
    signed, found = classes_and_components(docs, shingle, percent, sketch)
    placed = signed.select("doc_id", "n_shingles", "node").join(found, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
