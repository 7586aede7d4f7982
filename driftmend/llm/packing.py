"""Best-fit packing of token pieces into sequences by patterns.

Only the histogram of piece lengths decides how sequences are filled. Patterns of a few lengths that fill a sequence are
enumerated, non-negative least squares finds how often each should repeat to use up the histogram, the counts are
rounded down, and what is left is packed best fit, longest first. The plan's size depends on the capacity, not on the
corpus. Each piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftmend.llm.texts import LOWER, NOT_BLANK, Places, Words, pieces, words_of
from driftmend.sources.sinks import staged

# What a tokenizer file must say for its words to be tokenized one by one (fixed values of a public format).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]


_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_KINDS = np.full(256, _SIGN, np.uint8)
_KINDS[~NOT_BLANK] = _BLANK
_KINDS[0x61:0x7B] = _LETTER
_KINDS[0x80:] = _LETTER
_KINDS[0x30:0x3A] = _DIGIT


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokens:
    """Token ids of words, remembered within a worker.

    Tokens never cross white space if the file splits at it; then a text's ids are those of its words one after the
    other. A file of another kind is given whole texts.
    """

    KEPT = 200_000
    known: dict[str, WordTokens] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and splits[0].get("pattern") == {"Regex": _SPLIT}
            and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
            and all("<|" in t["content"] for t in spec["added_tokens"])
        )
        self.letters = _byte_letters()
        # Ids of remembered units one after the other, and where those of each end.
        self.at = Places(self.KEPT)
        self.flat, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    @classmethod
    def of(cls, path: str) -> WordTokens:
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def text(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def run(self, run: bytes) -> bytes:
        """Ids of lower-case letters, of one digit or of signs, which the file never splits before its merges."""
        letters = run.decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()

    def units(self, units: Words, odd: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each distinct unit begin, their number) of the units ``first``, whose ``hashes`` ascend.

        ``odd`` units have characters that the file treats in a way of its own.
        """
        place = self.at.of(hashes)
        fresh = np.flatnonzero(place < 0)
        own = units.data.tobytes()
        new = zip(units.starts[first[fresh]].tolist(), units.ends[first[fresh]].tolist(), odd[first[fresh]].tolist(), strict=True)
        each = [self.text(own[a:b].decode("utf-8")) if o else self.run(own[a:b]) for a, b, o in new]
        sizes = np.array([len(e) // 4 for e in each], np.int64)
        flat = np.concatenate((self.flat, np.frombuffer(b"".join(each), "<u4")))
        ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        place[fresh] = len(self.at) + np.arange(len(fresh))
        begins, length = ends[place], ends[place + 1] - ends[place]
        if len(self.at) + len(fresh) > self.KEPT or len(flat) > 8 * self.KEPT:
            self.at.clear()
            self.flat, self.ends = flat[:0].copy(), ends[:1].copy()
        else:
            self.at.add(hashes[fresh])
            self.flat, self.ends = flat, ends
        return flat, begins, length

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text of a piece."""
        if not self.by_word:
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                yield np.frombuffer(self.text(data[a:b].tobytes().decode("utf-8")), "<u4")
            return
        units, odd = _units(data, offsets)
        hashes, first, back = np.unique(units.hashes(), return_index=True, return_inverse=True)
        flat, begins, sizes = self.units(units, odd, hashes, first)
        length = sizes[back]
        upto = np.concatenate(([0], np.cumsum(length)))
        ids = flat[np.repeat(begins[back] - upto[:-1], length) + np.arange(upto[-1])]
        ends = upto[units.bounds]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield ids[a:b]


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """What is tokenized by itself, and which of it are whole words.

    Words of ASCII and of the letters from U+00C0 to U+00FF, without apostrophes and angle brackets, are lower-cased and
    cut into runs of letters, single digits and runs of signs. All others stay whole and as they are.
    """
    before = np.concatenate(([0], data[:-1])).astype(np.uint8) if len(data) else data
    lead, tail = data == 0xC3, (before == 0xC3) & (data != 0x97) & (data != 0xB7)
    low = LOWER[data]
    low[tail & (data <= 0x9E)] += 0x20
    strange = ((data >= 0x80) & ~lead & ~tail) | (data == 0x27) | (data == 0x3C)
    words = words_of(data, offsets, NOT_BLANK)
    counts = np.concatenate(([0], np.cumsum(strange)))
    whole = counts[words.ends] > counts[words.starts]
    change = np.zeros(len(data) + 1, np.int8)
    change[words.starts[whole]] += 1
    np.add.at(change, words.ends[whole], -1)
    within = np.cumsum(change[:-1]) > 0
    kind = _KINDS[low]
    begins = np.zeros(len(data), bool)
    begins[1:] = ~within[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (kind[1:] != _BLANK)
    begins[words.starts] = True
    starts = np.flatnonzero(begins)
    ends = words.ends[np.searchsorted(words.starts, starts, "right") - 1] if len(starts) else starts
    ends[:-1] = np.minimum(ends[:-1], starts[1:])
    return Words(np.where(within, data, low), starts, ends, np.searchsorted(starts, offsets)), within[starts]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids) of each document: its token ids and then ``end``, cut every ``capacity``.

    ids are little-endian unsigned 32-bit numbers. A null text is empty and gives one piece, the end alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.of(tokenizer)
        for batch in batches:
            for low, _, data, offsets in pieces(batch.column(1)):
                owner, number, start, length, ids = [], [], [], [], []
                for i, own in enumerate(tokens.rows(data, offsets)):
                    own = np.append(own, np.uint32(end)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity]
                        owner.append(low + i)
                        number.append(k)
                        start.append(at)
                        length.append(len(part))
                        ids.append(part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def _best_below(support: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The largest of ``support`` up to ``room``, 0 where there is none."""
    at = np.searchsorted(support, room, "right") - 1
    return np.where(at >= 0, support[np.maximum(at, 0)], 0)


def patterns(lengths: np.ndarray, capacity: int, choices: int = 24) -> np.ndarray:
    """Rows of up to four lengths, 0 where unused, that fill a sequence as well as their last length can; the plan uses
    those that leave at most a five-hundredth of it empty."""
    s = np.sort(lengths)
    picks = lambda n: s[np.unique(np.linspace(0, len(s) - 1, min(n, len(s))).round().astype(np.int64))]
    a2 = s
    a3, b3 = (x.ravel() for x in np.meshgrid(s, picks(choices)))
    a4, b4, c4 = (x.ravel() for x in np.meshgrid(picks(8 * choices), picks(choices), picks(8)))
    zero = lambda x: np.zeros(len(x), np.int64)
    starts = [np.stack(x, axis=1) for x in ((a2, zero(a2), zero(a2)), (a3, b3, zero(a3)), (a4, b4, c4))]
    heads = np.concatenate(starts)
    heads = heads[heads.sum(axis=1) <= capacity]
    tails = _best_below(s, capacity - heads.sum(axis=1))
    full = -np.sort(-np.column_stack((heads, tails)), axis=1)
    return np.unique(full, axis=0)


def repeat_counts(rows: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative x that brings the lengths used by x patterns close to the histogram, by projected gradient."""
    scale = 1 / np.sqrt(np.maximum(histogram, 1.0))
    scale[0] = 0
    weights = scale[rows]
    target = histogram * scale

    def image(x: np.ndarray) -> np.ndarray:
        return np.bincount(rows.ravel(), weights=(weights * x[:, None]).ravel(), minlength=len(histogram))

    probe = np.ones(len(rows))
    norm = 1.0
    for _ in range(12):
        probe = (weights * image(probe)[rows]).sum(axis=1)
        norm = np.linalg.norm(probe)
        probe /= max(norm, 1e-300)
    x = v = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        gradient = (weights * (image(v) - target)[rows]).sum(axis=1)
        moved = np.maximum(v - gradient / (1.1 * norm), 0)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, x, t = moved + (t - 1) / after * (moved - x), moved, after
    return x


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), using up the histogram exactly."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: dict[tuple[int, ...], int] = {}

    def take(pattern: list[int], n: int) -> None:
        out[tuple(pattern)] = out.get(tuple(pattern), 0) + n
        for length in pattern:
            left[length] -= n

    if left[capacity]:
        take([capacity], int(left[capacity]))
    support = np.flatnonzero(left)
    if len(support):
        rows = patterns(support, capacity)
        rows = rows[rows.sum(axis=1) >= capacity - capacity // 500]
        x = repeat_counts(rows, left.astype(np.float64))
        used = rows.sum(axis=1)
        for i in np.lexsort((-np.floor(x), -used)):
            pattern = [int(length) for length in rows[i] if length]
            room = min(int(left[length]) // pattern.count(length) for length in pattern)
            if (n := min(int(x[i]), room)) > 0:
                take(pattern, n)
    while left.any():
        support = np.flatnonzero(left)
        pattern = [int(support[-1])]
        left[pattern[0]] -= 1
        while True:
            support = np.flatnonzero(left)
            room = capacity - sum(pattern)
            if not len(support) or support[0] > room:
                break
            first = support[support <= room]
            # The pair that fills best; a length stands for itself twice only if two are left.
            free = left.copy()
            second = _best_below(support, room - first)
            twice = (second == first) & (free[first] < 2)
            second = np.where(twice, _best_below(support, np.minimum(room - first, first - 1)), second)
            best = int(np.lexsort((-first, -(first + second)))[0])
            pattern.append(int(first[best]))
            left[first[best]] -= 1
        for length in pattern:
            left[length] += 1
        n = min(int(left[length]) // pattern.count(length) for length in set(pattern))
        take(sorted(pattern, reverse=True), max(1, n))
    return sorted(out.items(), reverse=True)


def _slots(chosen: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Runs of places: length, first rank, rank after the last, sequence of the first piece, offset in each sequence."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in chosen:
        offset = 0
        for length in pattern:
            first = ranks.get(length, 0)
            rows.append((length, first, first + n, sequence, offset))
            ranks[length] = first + n
            offset += length
        sequence += n
    return rows


GROUP = 100_000


def packed(pieces_of: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces_of`` (length, ...) with sequence_id and offset: as few sequences of ``capacity`` as the plan finds.

    Pieces are cut to groups of about GROUP by a stored number, ranked within their group, and a group's first rank is
    the sum of the groups before it, so a length may have any share of the pieces.
    """
    spark = pieces_of.sparkSession
    rows = staged(pieces_of.withColumn("_draw", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    # As many rows as the plan has lengths, which the capacity bounds.
    columns = np.array(_slots(plan(histogram, capacity)), np.int64).reshape(-1, 5).T
    # From Arrow, so that no further Python workers start for a list of rows.
    slots = spark.createDataFrame(pa.Table.from_arrays([pa.array(c) for c in columns], names=["_length", "_low", "_high", "_sequence", "_offset"]))
    groups = np.ones(capacity + 1, np.int64)
    for length, n in histogram.items():
        groups[length] = -(-n // GROUP)
    many = F.create_map(*[F.lit(int(x)) for length, n in enumerate(groups) if n > 1 for x in (length, n)]) if groups.max() > 1 else None
    of_length = F.coalesce(F.element_at(many, F.col("length").cast("int")), F.lit(1)) if many is not None else F.lit(1)
    dealt = rows.withColumn("_group", F.pmod("_draw", of_length))
    sizes = dealt.groupBy("length", "_group").count()
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("length", "_group").orderBy("_draw")
    ranked = dealt.withColumn("_own", F.row_number().over(own) - 1).join(first, ["length", "_group"])
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_first")).select(*pieces_of.columns, "_rank")
    inside = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    placed = ranked.join(F.broadcast(slots), inside)
    return placed.select(
        *pieces_of.columns, (F.col("_sequence") + F.col("_rank") - F.col("_low")).alias("sequence_id"), F.col("_offset").alias("offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every document's tokens, placed.

    Only documents of more than ``capacity`` tokens are cut. A null or empty text is its end alone. Repeated rows are
    packed once each, a null doc_id is passed on, other columns of ``docs`` play no part, an empty table gives none.
    """
    return packed(token_pieces(docs, tokenizer, capacity, end), capacity)
