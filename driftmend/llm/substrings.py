"""Removing word sequences that stand elsewhere too, found by anchors at difference-cover positions.

A window is ``size`` words in a row. A difference cover of a period is a set of residues such that any two places can
be moved on by less than a period to stand on residues of the set both. So two equal windows, wherever they begin, share
a run of ``size - period + 1`` words that begins at a cover position of either text: an aligned anchor. Only such anchors
are hashed and compared: they are sorted across tasks, where equal ones stand next to each other, and a text gets back
those of its anchors that occur again. As texts are part of the order, an anchor in any share of the texts
is dealt to as many tasks; the runs at a task's ends, whose neighbours it does not see, count as occurring again.

Where an anchor occurs again, it is extended: the windows that hold it are compared in full, by 96 bits of hash, in
one aggregation in which equal windows fold to a count. The windows that turn out to stand alone are what a text gets
back; its other candidates are repeated. No occurrences are paired.

Equal texts (128 bits of hash) are folded to one first. Every window of a text that several documents have stands elsewhere, so
of those documents nothing is kept, and their number is never gathered; each other text is one document. All of this
reads one shuffle of the texts.

Defined cases: a NULL text has no words; texts of fewer than ``size`` words keep all of them; a repeated row is
another document, so each of its windows stands elsewhere; rows without an id are documents like others; an empty table gives no
rows. A task holds some tens of bytes for each word of its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmend.llm.texts import NOT_BLANK, PIECE, Words, long_array, mixed, numbers, pieces, words_of
from driftmend.sources.sinks import staged

# Perfect difference covers, by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

#: Window starts looked at together.
CHUNK = 1 << 17
BASES = numbers(41, 3) | np.uint64(1)

KEYS = ["key_1", "key_2"]
RESULT = ["doc_id", "n_words", "n_removed", "kept_text"]


@dataclass(frozen=True)
class Cover:
    """Windows of ``size`` words, and the longest period that leaves anchors of two fifths of that."""

    size: int

    @property
    def period(self) -> int:
        return max(p for p in COVERS if p == 1 or self.size - p + 1 >= 2 * self.size / 5)

    @property
    def anchor(self) -> int:
        return self.size - self.period + 1

    def marks(self) -> np.ndarray:
        out = np.zeros(self.period, bool)
        out[list(COVERS[self.period])] = True
        return out


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``base`` and of its inverse."""
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(n, factor, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def run_hashes(hashes: np.ndarray, length: int, which: int) -> np.ndarray:
    """A 64-bit hash of each ``length`` words in a row; each ``which`` has its own."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(int(BASES[which]), 1 << max(CHUNK.bit_length(), len(hashes).bit_length()))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * down[:n])


def word_hashes(words: Words) -> np.ndarray:
    """The words' hashes, worked out for some of the bytes at a time."""
    out, low = np.zeros(len(words.starts), np.uint64), 0
    while low < len(out):
        high = max(low + 1, int(np.searchsorted(words.ends, words.starts[low] + PIECE, "right")))
        begin = words.starts[low]
        part = Words(words.data[begin : words.ends[high - 1]], words.starts[low:high] - begin, words.ends[low:high] - begin, words.bounds)
        out[low:high] = part.hashes()
        low = high
    return out


@dataclass
class Chunk:
    """Some words in a row, with where each stands in its text and how many words are left there."""

    first: int
    hashes: np.ndarray
    row: np.ndarray
    place: np.ndarray
    left: np.ndarray
    whole: np.ndarray
    starts: int

    def anchors(self, cover: Cover) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the anchor at each word, whether there is one at a cover position)"""
        found = run_hashes(self.hashes, cover.anchor, 0)
        m = len(found)
        return found, cover.marks()[self.place[:m] % cover.period] & (self.left[:m] >= cover.anchor) & (self.whole[:m] >= cover.size)


def chunks(words: Words, size: int) -> Iterator[Chunk]:
    """All window starts, ``CHUNK`` at a time, each with the words of its window."""
    hashes = word_hashes(words)
    for first in range(0, len(hashes), CHUNK):
        end = min(len(hashes), first + CHUNK + size - 1)
        index = np.arange(first, end)
        row = np.searchsorted(words.bounds, index, "right") - 1
        begin, after = words.bounds[row], words.bounds[row + 1]
        yield Chunk(first, hashes[first:end], row, index - begin, after - index, after - begin, min(CHUNK, len(hashes) - first))


def _lists(column: pa.Array, low: int, high: int) -> list[np.ndarray]:
    """The lists of 64-bit numbers of some rows; a NULL is an empty one."""
    part = column.slice(low, high - low)
    cells = part.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum([0, *(n or 0 for n in part.value_lengths().to_pylist())])
    return [cells[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _among(values: np.ndarray, rows: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Whether each value is among those known of its row; ``rows`` ascends."""
    out = np.zeros(len(values), bool)
    present, begins = np.unique(rows, return_index=True)
    ends = np.append(begins, len(rows))[1:]
    for r, a, b in zip(present.tolist(), begins.tolist(), ends.tolist(), strict=True):
        if len(known[r]):
            out[a:b] = np.isin(values[a:b], known[r])
    return out


def candidates(chunk: Chunk, cover: Cover, again: list[np.ndarray]) -> np.ndarray:
    """The words at which windows begin that hold an anchor of the row's ``again``; counted from the chunk's first word."""
    anchors, there = chunk.anchors(cover)
    at = np.flatnonzero(there)
    there[at] = _among(anchors[at], chunk.row[at], again)
    flagged = np.zeros(len(anchors) + 1, np.int64)
    np.cumsum(there, out=flagged[1:])
    starts = np.flatnonzero(chunk.left[: chunk.starts] >= cover.size)
    return starts[flagged[starts + cover.period] > flagged[starts]]


def measured(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, key_1, key_2, n_words, kept_text): the words of each document, spelt out if they are too few for a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column("text")):
                words = words_of(data, offsets, NOT_BLANK)
                n_words = np.diff(words.bounds)
                short = np.repeat(n_words < size, n_words)
                kept = [t if n < size else None for t, n in zip(_kept_texts(words, offsets, ~short), n_words.tolist(), strict=True)]
                own = [batch.column(c).slice(low, high - low) for c in ("doc_id", *KEYS)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n_words), pa.array(kept, pa.string())], names=["doc_id", *KEYS, "n_words", "kept_text"])

    return texts.mapInArrow(run, "doc_id long, key_1 long, key_2 long, n_words long, kept_text string")


def anchors_again(folded: DataFrame, cover: Cover) -> DataFrame:
    """(key_1, again): of each text the anchors that occur again, in it or in another."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key_1").to_numpy()
            for low, _, data, offsets in pieces(batch.column("text")):
                for chunk in chunks(words_of(data, offsets, NOT_BLANK), cover.size):
                    anchors, there = chunk.anchors(cover)
                    at = np.flatnonzero(there[: chunk.starts])
                    yield pa.RecordBatch.from_arrays([long_array(anchors[at]), pa.array(keys[low + chunk.row[at]])], names=["anchor", "key_1"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of sorted rows those whose anchor a neighbour has too, and the first and the last anchor's.

        The last row seen waits for the one behind it.
        """
        first, waiting, known = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if waiting is None else [waiting, batch]).combine_chunks().to_batches()[0]
            anchors = rows.column(0).to_numpy()
            first = anchors[0] if first is None else first
            again = anchors == first
            again[0] |= known
            equal = anchors[1:] == anchors[:-1]
            again[1:] |= equal
            again[:-1] |= equal
            yield rows.slice(0, len(anchors) - 1).filter(pa.array(again[:-1]))
            waiting, known = rows.slice(len(anchors) - 1), bool(again[-1])
        if waiting is not None:
            yield waiting

    ordered = folded.mapInArrow(emitted, "anchor long, key_1 long").repartitionByRange("anchor", "key_1").sortWithinPartitions("anchor", "key_1")
    return ordered.mapInArrow(repeated, "anchor long, key_1 long").groupBy("key_1").agg(F.collect_set("anchor").alias("again"))


def windows_alone(held: DataFrame, cover: Cover) -> DataFrame:
    """(key_1, alone): the candidate windows of each text of (key_1, text, again) that stand nowhere else, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key_1").to_numpy()
            for low, high, data, offsets in pieces(batch.column("text")):
                known = _lists(batch.column("again"), low, high)
                for chunk in chunks(words_of(data, offsets, NOT_BLANK), cover.size):
                    at = candidates(chunk, cover, known)
                    if len(at):
                        one, two = (run_hashes(chunk.hashes, cover.size, which)[at] for which in (1, 2))
                        columns = [long_array(one), pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(keys[low + chunk.row[at]])]
                        yield pa.RecordBatch.from_arrays(columns, names=["one", "two", "key_1"])

    counted = held.mapInArrow(run, "one long, two int, key_1 long").groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.min("key_1").alias("key_1"))
    return counted.where("n = 1").groupBy("key_1").agg(F.collect_list("one").alias("alone"))


def _kept_texts(words: Words, offsets: np.ndarray, gone: np.ndarray) -> list[str]:
    """The words of each row that are not ``gone``, with one blank between them."""
    kept = ~gone
    # A kept word takes the blank behind it along; the last of a row may have none, and else loses it below.
    after = np.minimum(words.ends + 1, np.repeat(offsets[1:], np.diff(words.bounds)))
    edges = np.zeros(len(words.data) + 1, np.int8)
    edges[words.starts[kept]] += 1
    edges[after[kept]] -= 1
    chosen = np.cumsum(edges[:-1], dtype=np.int8) > 0
    spelt = np.where(NOT_BLANK[words.data], words.data, np.uint8(0x20))[chosen].tobytes()
    lengths = np.concatenate([[0], np.cumsum(np.where(kept, after - words.starts, 0))])[words.bounds]
    return [spelt[a:b].rstrip(b" ").decode("utf-8", "replace") for a, b in zip(lengths[:-1].tolist(), lengths[1:].tolist(), strict=True)]


def kept(told: DataFrame, cover: Cover) -> DataFrame:
    """What is left of each row (doc_id, text, again, alone) that has a window at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column("text")):
                words = words_of(data, offsets, NOT_BLANK)
                again, alone = (_lists(batch.column(c), low, high) for c in ("again", "alone"))
                depth = np.zeros(len(words.starts) + 1, np.int32)
                for chunk in chunks(words, cover.size):
                    at = candidates(chunk, cover, again)
                    if len(at):
                        at = at[~_among(run_hashes(chunk.hashes, cover.size, 1)[at], chunk.row[at], alone)] + chunk.first
                        depth[at] += 1
                        depth[at + cover.size] -= 1
                gone = np.cumsum(depth[:-1]) > 0
                removed = np.concatenate([[0], np.cumsum(gone)])[words.bounds]
                n_words = np.diff(words.bounds)
                columns = [batch.column("doc_id").slice(low, high - low), pa.array(n_words), pa.array(np.diff(removed)), pa.array(_kept_texts(words, offsets, gone), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=RESULT).filter(pa.array(n_words >= cover.size))

    return told.select("doc_id", "text", "again", "alone").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def without_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """One row per document: ``n_words``, ``n_removed`` and ``kept_text``, the words that no window covers which also
    begins anywhere else, with one blank between them."""
    cover = Cover(size)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumns({"key_1": F.xxhash64("text"), "key_2": F.xxhash64(F.lit(1), "text")})

    facts = staged(measured(texts, size), "measured")
    long = facts.where(F.col("n_words") >= size)
    classes = staged(long.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "classes")
    nothing = long.join(classes.where("n > 1"), KEYS, "left_semi").select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit("").alias("kept_text"))
    short = facts.where(F.col("n_words") < size).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_text")

    folded = texts.groupBy(*KEYS).agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.count(F.lit(1)).alias("n"))
    again = classes.select(*KEYS).join(anchors_again(folded, cover), "key_1")
    alone = classes.select(*KEYS).join(windows_alone(folded.join(again, KEYS), cover), "key_1")
    told = folded.where("n = 1").join(again, KEYS, "left").join(alone, KEYS, "left")
    return short.unionByName(nothing).unionByName(kept(told, cover))
