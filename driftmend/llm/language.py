"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads each run of letter bytes forwards and backwards and gives every position a probability of each
language; a text's probabilities are the means over its positions. Its state is reset between runs, so what a run
contributes does not depend on where it stands: tasks put each distinct run through the network once and remember it.
The network is trained here by backpropagation through time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmend.llm.texts import LOWER, Places, Words, byte_class, pieces, words_of

LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
#: Longer runs are read in parts of so many bytes.
LONGEST = 32
UNKNOWN = "und"


def _runs(data: np.ndarray, offsets: np.ndarray) -> Words:
    words = words_of(LOWER[data], offsets, LETTERS)
    sizes = words.ends - words.starts
    if not (sizes > LONGEST).any():
        return words
    parts = -(-sizes // LONGEST)
    first = np.concatenate(([0], np.cumsum(parts)))
    step = np.arange(first[-1]) - np.repeat(first[:-1], parts)
    starts = np.repeat(words.starts, parts) + step * LONGEST
    return Words(words.data, starts, np.minimum(starts + LONGEST, np.repeat(words.ends, parts)), first[words.bounds])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Direction:
    """One gated recurrent layer: update gate, reset gate and candidate side by side."""

    inputs: np.ndarray  # (256, 3 h)
    states: np.ndarray  # (h, 3 h)

    @staticmethod
    def fresh(h: int, draw: np.random.Generator) -> Direction:
        return Direction(draw.normal(0, 0.3, (256, 3 * h)).astype(np.float32), draw.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32))

    def forward(self, symbols: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each symbol, (steps, rows, h), of rows of equal length."""
        h = self.states.shape[0]
        rows, steps = symbols.shape
        state = np.zeros((rows, h), np.float32)
        out = np.empty((steps, rows, h), np.float32)
        for t in range(steps):
            x, u = self.inputs[symbols[:, t]], state @ self.states
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            if trace is not None:
                trace.append((state, z, r, new, u[:, 2 * h :]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def backward(self, symbols: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and states, given those of the states after each symbol."""
        h = self.states.shape[0]
        d_states = np.zeros_like(self.states)
        carried = np.zeros_like(d_out[0])
        d_symbols = np.empty((len(trace), len(symbols), 3 * h), np.float32)
        for t in range(len(trace) - 1, -1, -1):
            state, z, r, new, u = trace[t]
            d = d_out[t] + carried
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (state - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            d_x = np.concatenate((d_z, d_r, d_new), axis=1)
            d_u = np.concatenate((d_z, d_r, d_new * r), axis=1)
            d_symbols[t] = d_x
            d_states += state.T @ d_u
            carried = d * z + d_u @ self.states.T
        # Add up the rows of equal symbols.
        flat = symbols.T.ravel()
        order = np.argsort(flat, kind="stable")
        own, first = np.unique(flat[order], return_index=True)
        d_inputs = np.zeros_like(self.inputs)
        d_inputs[own] = np.add.reduceat(d_symbols.reshape(-1, 3 * h)[order], first, axis=0)
        return d_inputs, d_states


@dataclass
class Network:
    ahead: Direction
    back: Direction
    out: np.ndarray  # (2 h + 1, languages); the last row is the bias
    languages: list[str]

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.states, self.back.inputs, self.back.states, self.out]

    def name(self) -> str:
        digest = hashlib.sha256("\n".join(self.languages).encode())
        for p in self.parameters():
            digest.update(p.tobytes())
        return digest.hexdigest()

    def _states(self, symbols: np.ndarray, traces: tuple[list | None, list | None] = (None, None)) -> np.ndarray:
        ahead = self.ahead.forward(symbols, traces[0])
        back = self.back.forward(symbols[:, ::-1], traces[1])[::-1]
        return np.concatenate((ahead, back, np.ones_like(ahead[..., :1])), axis=2)

    def label(self, symbols: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each position, (steps, rows, languages)."""
        scores = self._states(symbols) @ self.out
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, symbols: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """(mean loss a position, gradients of parameters), every position of a row having the row's language."""
        traces: tuple[list, list] = ([], [])
        states = self._states(symbols, traces)
        scores = states @ self.out
        scores -= scores.max(axis=2, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=2, keepdims=True)
        rows = np.arange(len(target))
        loss = -np.log(np.maximum(p[:, rows, target], 1e-30)).mean()
        p[:, rows, target] -= 1
        p /= p.shape[0] * p.shape[1]
        d_out = np.einsum("tri,trj->ij", states, p, optimize=True)
        d_states = p @ self.out.T
        h = self.ahead.states.shape[0]
        ahead = self.ahead.backward(symbols, traces[0], d_states[..., :h])
        back = self.back.backward(symbols[:, ::-1], traces[1], d_states[::-1, :, h : 2 * h])
        return float(loss), [*ahead, *back, d_out]


def trained(units: list[bytes], labels: np.ndarray, weights: np.ndarray, languages: list[str], hidden: int = 16, steps: int = 900, batch: int = 192, seed: int = 3) -> Network:
    """A network fitted by Adam on runs drawn by weight; the runs of a step have one length."""
    draw = np.random.default_rng(seed)
    network = Network(Direction.fresh(hidden, draw), Direction.fresh(hidden, draw), draw.normal(0, 0.1, (2 * hidden + 1, len(languages))).astype(np.float32), languages)
    lengths = np.array([len(u) for u in units])
    groups = []
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        share = weights[own] / weights[own].sum()
        symbols = np.frombuffer(b"".join(units[i] for i in own), np.uint8).reshape(-1, n)
        groups.append((weights[own].sum() * n, symbols, labels[own], np.cumsum(share)))
    odds = np.cumsum([g[0] for g in groups])
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    for step in range(1, steps + 1):
        _, symbols, target, upto = groups[int(np.searchsorted(odds, draw.random() * odds[-1]))]
        picked = np.minimum(np.searchsorted(upto, draw.random(batch)), len(upto) - 1)
        _, gradients = network.gradients(symbols[picked], target[picked])
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients))
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(network.parameters(), gradients, first, second, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.002 * (g * g - b)
            p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.998**step)) + 1e-8)).astype(np.float32)
    return network


class Memory:
    """What a worker remembers of runs under one network: sums of probabilities over their positions."""

    known: dict[str, Memory] = {}

    def __init__(self, languages: int):
        self.size = max(1000, min(200_000, 4_000_000 // languages))
        self.sums = np.zeros((self.size, languages), np.float32)
        self.at = Places(self.size)

    @classmethod
    def of(cls, name: str, languages: int) -> Memory:
        if name not in cls.known:
            cls.known.clear()
            cls.known[name] = cls(languages)
        return cls.known[name]

    def sums_of(self, network: Network, words: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sums for the distinct runs that begin at the words ``first`` with ``hashes``, which ascend."""
        place = self.at.of(hashes)
        fresh = np.flatnonzero(place < 0)
        found = self.sums[np.maximum(place, 0)]
        sizes = (words.ends - words.starts)[first[fresh]]
        for n in np.unique(sizes):
            own = fresh[sizes == n]
            for i in range(0, len(own), 4096):
                part = own[i : i + 4096]
                symbols = words.data[words.starts[first[part]][:, None] + np.arange(n)]
                found[part] = network.label(symbols).sum(axis=0)
        if len(self.at) + len(fresh) > self.size:
            self.at.clear()
        keep = fresh[: self.size - len(self.at)]
        self.sums[len(self.at) : len(self.at) + len(keep)] = found[keep]
        self.at.add(hashes[keep])
        return found


def _has_letter(data: np.ndarray) -> bool:
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def sampled_runs(docs: DataFrame, per_language: int, per_document: int) -> DataFrame:
    """(lang, unit, n): runs of a bounded sample, those documents of each language whose ids hash lowest.

    Of a longer document runs at even distances are taken.
    """
    own = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    sizes = own.groupBy("lang").agg(F.count("*").alias("_n"))
    # Twice the sample by the hash alone, so that few rows are ranked.
    near = own.join(F.broadcast(sizes), "lang").withColumn("_draw", draw).where(F.col("_draw") * F.col("_n") <= 2e6 * per_language)
    order = Window.partitionBy("lang").orderBy("_draw", "doc_id")
    drawn = near.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_language).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in pieces(batch.column(1)):
                words = _runs(data, offsets)
                owner, units = [], []
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                    for j in np.unique(np.linspace(a, b - 1, min(per_document, b - a)).round().astype(np.int64)) if b > a else ():
                        owner.append(low + i)
                        units.append(words.text(j))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(units, pa.binary())], names=["lang", "unit"])

    return drawn.mapInArrow(run, "lang string, unit binary").groupBy("lang", "unit").agg(F.count("*").alias("n"))


def learned(docs: DataFrame, training: Column, per_language: int = 400, per_document: int = 100) -> Network | None:
    """A network learned from at most ``per_language`` documents a language among the rows that ``training`` picks."""
    found = sampled_runs(docs.where(training), per_language, per_document).toPandas()
    if not len(found):
        return None
    found["unit"] = found["unit"].map(bytes)
    found = found.sort_values(["lang", "unit"])
    languages = sorted(found["lang"].unique())
    labels = found["lang"].map({c: i for i, c in enumerate(languages)}).to_numpy(np.int64)
    # Languages count alike however many documents they have.
    n = found["n"].to_numpy(np.float64)
    weights = n / np.bincount(labels, weights=n)[labels]
    return trained(found["unit"].tolist(), labels, weights, languages)


def identify(docs: DataFrame, network: Network | None, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` (text, ...) with the columns ``language`` and ``score`` added.

    score is the mean probability of the language over all positions. A null text, or one without a letter, is ``und``
    with score 0, and so is every text if nothing was learned. Ties go to the language that sorts first. Other columns
    are passed on as they are, but for those of the same two names, which are replaced; repeated rows each get their
    row, an empty table gives an empty one.
    """
    docs = docs.drop(language, score).withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")
    if network is None:
        return docs.withColumns({language: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast((network, network.name()))
    names = [*docs.columns, language, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, name = shared.value
        memory = Memory.of(name, len(network.languages))
        kinds = pa.array([*network.languages, UNKNOWN])
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(at)):
                m = high - low
                words = _runs(data, offsets)
                rows = np.repeat(np.arange(m), np.diff(words.bounds))
                total = np.zeros((m, len(network.languages)))
                if len(rows):
                    hashes, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
                    each = memory.sums_of(network, words, hashes, first)
                    for i in range(total.shape[1]):
                        total[:, i] = np.bincount(rows, weights=each[back, i], minlength=m)
                positions = np.bincount(rows, weights=words.ends - words.starts, minlength=m)
                mean = total / np.maximum(positions, 1)[:, None]
                best, top = mean.argmax(axis=1), np.minimum(mean.max(axis=1), 1.0)
                ascii_letters = np.concatenate(([0], np.cumsum((LOWER[data] >= 0x61) & (LOWER[data] <= 0x7A))))
                plain = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
                for i in np.flatnonzero(~plain):
                    if not (positions[i] and _has_letter(data[offsets[i] : offsets[i + 1]])):
                        best[i], top[i] = len(network.languages), 0.0
                kept = batch.slice(low, m).columns
                yield pa.RecordBatch.from_arrays([*kept, kinds.take(pa.array(best)), pa.array(top)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{language}` string, `{score}` double")
