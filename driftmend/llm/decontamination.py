"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ``size`` words (the whole item if it has fewer). A window is the set of its shingles;
to hold the whole window a text must hold its rarest shingle, so with shingles ordered by how often they occur in the
corpus one prefix token per window is enough. Positions of that shingle in the text and in the window fix where the
window would begin and whether it fits; the words there are then compared.

Tasks drop all shingles that no window needs by a bitmap of fixed size; only what passes is joined, so neither the
benchmark nor the corpus has to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.llm.texts import ALPHANUMERIC, LOWER, Words, long_array, mixed, numbers, pieces, words_of
from driftmend.sources.sinks import staged

BITS = 1 << 22
SHINGLE = 3


def _shingles(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of ``length`` words, whether each lies within one row)"""
    n = max(0, len(hashes) - length + 1)
    out = np.full(n, np.uint64(length))
    for i, factor in enumerate(numbers(23, length) | np.uint64(1)):
        out += hashes[i : n + i] * factor
    row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    return mixed(out), row[:n] == row[length - 1 :]


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """(item, window, n, shingles): each distinct window of each item as text, its words and its shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                words = words_of(LOWER[data], offsets, ALPHANUMERIC)
                hashes = words.hashes()
                items, texts, counts, marks = [], [], [], []
                all_shingles = {k: _shingles(words, hashes, k)[0] for k in range(1, SHINGLE + 1)}
                for i in range(high - low):
                    begin, end = words.bounds[i], words.bounds[i + 1]
                    own = [words.text(j) for j in range(begin, end)]
                    n = min(size, len(own))
                    k = min(SHINGLE, n)
                    for p in range(len(own) - n + 1) if n else ():
                        items.append(i)
                        texts.append(b" ".join(own[p : p + n]).decode("utf-8", "replace"))
                        counts.append(n)
                        marks.append(all_shingles[k][begin + p : begin + p + n - k + 1].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).take(pa.array(items, pa.int64())),
                        pa.array(texts, pa.string()),
                        pa.array(counts, pa.int32()),
                        pa.array(marks, pa.list_(pa.int64())),
                    ],
                    names=["item", "window", "n", "shingles"],
                )

    named = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return named.mapInArrow(run, "item string, window string, n int, shingles array<long>").distinct()


def _bitmap(shingles: DataFrame) -> np.ndarray:
    """Which of BITS residues occur: at most BITS numbers reach the driver."""
    marks = np.zeros(BITS, bool)
    residues = shingles.select(F.pmod("shingle", F.lit(BITS)).cast("int").alias("bit")).distinct().toPandas()
    marks[residues["bit"].to_numpy(np.int64)] = True
    return np.packbits(marks)


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(BITS - 1)
    return (bitmap[bit >> np.uint64(3)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1


def _rarity(docs: DataFrame, shingles: DataFrame, lengths: list[int]) -> DataFrame:
    """(shingle, occurrences) of the windows' shingles that occur in ``docs`` at all."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(shingles))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, _, data, offsets in pieces(batch.column(0)):
                words = words_of(LOWER[data], offsets, ALPHANUMERIC)
                hashes = words.hashes()
                for k in lengths:
                    own, inside = _shingles(words, hashes, k)
                    found.append(own[inside & _passes(shared.value, own)])
            own, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([long_array(own), pa.array(n)], names=["shingle", "n"])

    each = docs.select(F.col("text").cast("string")).mapInArrow(run, "shingle long, n long")
    counted = each.groupBy("shingle").agg(F.sum("n").alias("occurrences"))
    return counted.join(shingles, "shingle", "left_semi")


def _places(docs: DataFrame, prefixes: DataFrame, lengths: list[int], size: int) -> DataFrame:
    """One row per document, and one for each place where a prefix shingle may stand, with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(prefixes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(2)):
                words = words_of(LOWER[data], offsets, ALPHANUMERIC)
                hashes = words.hashes()
                n_words = np.diff(words.bounds)
                row = np.repeat(np.arange(high - low), n_words)
                rows, marks, places, before, around = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], []
                for k in lengths:
                    own, inside = _shingles(words, hashes, k)
                    at = np.flatnonzero(inside & _passes(shared.value, own))
                    rows.append(row[at])
                    marks.append(own[at])
                    places.append(at - words.bounds[row[at]])
                    for p, r in zip(at.tolist(), row[at].tolist(), strict=True):
                        begin, end = max(words.bounds[r], p - size + 1), min(words.bounds[r + 1], p + size)
                        before.append(p - begin)
                        around.append(b" ".join(words.text(j) for j in range(begin, end)).decode("utf-8", "replace"))
                ids, digests = batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low)
                m, owner = high - low, pa.array(np.concatenate(rows))
                names = ["doc_id", "digest", "n_words", "shingle", "place", "before", "around"]
                yield pa.RecordBatch.from_arrays(
                    [ids, digests, pa.array(n_words), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.string())], names=names
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(owner),
                        digests.take(owner),
                        pa.array(n_words).take(owner),
                        long_array(np.concatenate(marks)),
                        pa.array(np.concatenate(places)),
                        pa.array(before, pa.int64()),
                        pa.array(around, pa.string()),
                    ],
                    names=names,
                )

    schema = "doc_id long, digest long, n_words long, shingle long, place long, before long, around string"
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), F.col("text").cast("string"))
    return texts.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """(one row per document, hits): the words of each document, and each place where a window stands.

    Documents are (doc_id, digest, n_words), hits (doc_id, digest, start, n, window, item), both written tables;
    digest tells apart rows that share a doc_id.
    """
    windows = staged(windows_of(benchmark, size), "windows")
    each = windows.select("window", "n", "shingles").distinct()
    shingles = each.select(F.explode("shingles").alias("shingle")).distinct()
    # Windows of one or two words are their own shingle.
    lengths = sorted(r.k for r in windows.select(F.least(F.col("n"), F.lit(SHINGLE)).alias("k")).distinct().collect())
    rarity = staged(_rarity(docs, shingles, lengths), "rarity")
    placed = each.select("window", "n", F.posexplode("shingles").alias("at", "shingle"))
    rarest = placed.join(rarity, "shingle", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("occurrences", F.lit(0)).alias("occurrences"), "shingle", "at")).alias("prefix")
    )
    prefixes = staged(rarest.where("prefix.occurrences > 0").select("window", "n", "prefix.shingle", "prefix.at"), "prefixes")
    rows = staged(_places(docs, prefixes, lengths, size), "places")
    documents = rows.where("shingle IS NULL").select("doc_id", "digest", "n_words")

    candidates = rows.where("shingle IS NOT NULL").join(prefixes, "shingle")
    fits = candidates.where("before >= at AND place - at + n <= n_words")
    same = F.array_join(F.slice(F.split("around", " "), (F.col("before") - F.col("at") + 1).cast("int"), F.col("n")), " ") == F.col("window")
    found = fits.where(same).select("doc_id", "digest", (F.col("place") - F.col("at")).alias("start"), "n", "window").distinct()
    return documents, staged(found.join(windows.select("window", "item"), "window"), "hits")


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of ``docs`` (doc_id, text, ...).

    Words are runs of letters a-z, digits and characters beyond ASCII, with A-Z lower-cased. n_hit counts the words
    inside any window of ``benchmark`` (item_id, text, ...), n_items the items with such windows, items_sha256 is of
    their ids, sorted as text and joined by commas. A null or wordless text has 0 words and no hits; an item without
    words or id has no windows; equal items count one each. Repeated rows each get their row, a null doc_id is passed
    on, and an empty benchmark hits nothing.
    """
    documents, hits = contamination(docs, benchmark.where("item_id IS NOT NULL"), size)
    key = ["doc_id", "digest"]
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    # Words covered by spans in order of their starts: each adds what lies beyond the furthest end so far.
    step = lambda sum, s: F.struct(
        F.greatest(sum["upto"], s["end"]).alias("upto"),
        (sum["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(sum["upto"], s["start"]))).alias("n"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    covered = hits.select(*key, "start", "n").distinct().groupBy(*key).agg(spans.alias("spans"))
    covered = covered.select(*key, F.aggregate("spans", zero, step)["n"].alias("n_hit"))
    items = hits.select(*key, "item").distinct().groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    both = covered.join(items, [covered[c].eqNullSafe(items[c]) for c in key]).select(*[covered[c] for c in key], "n_hit", "items")
    joined = documents.alias("d").join(both.alias("h"), [F.col(f"d.{c}").eqNullSafe(F.col(f"h.{c}")) for c in key], "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "d.doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
