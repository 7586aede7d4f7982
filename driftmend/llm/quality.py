"""Text quality by a sparse ensemble of rules.

Shallow boosted trees over statistics of a text give conjunctive rules (every path from a root to a node is one);
a lasso logistic regression keeps few of them; what is kept becomes one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmend.llm.texts import LOWER, NOT_BLANK, byte_class, mixed, numbers, pieces, words_of

STATISTICS = (
    "log_words", "log_bytes", "mean_word", "longest_word", "upper", "lower", "digits", "beyond_ascii", "symbols", "marks",
    "exclamations", "pipes", "stops", "lines_per_word", "distinct_words", "repeated_neighbours", "top_word", "repeated_lines",
    "capital_words", "marked_words",
)

_LINE = ~byte_class((0x0A, 0x0A))
_GROUPS = {
    "upper": byte_class((0x41, 0x5A)),
    "lower": byte_class((0x61, 0x7A)),
    "digits": byte_class((0x30, 0x39)),
    "beyond_ascii": byte_class((0x80, 0xFF)),
    "symbols": byte_class((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5C, 0x5C), (0x5E, 0x60), (0x7B, 0x7E)),
    "marks": byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
    "exclamations": byte_class((0x21, 0x21)),
    "pipes": byte_class((0x7C, 0x7C)),
    "stops": byte_class((0x2E, 0x2E)),
}
_GROUP_MATRIX = np.stack([_GROUPS[g] for g in _GROUPS], axis=1).astype(np.float64)
_MARK_END = _GROUPS["symbols"] | _GROUPS["exclamations"]


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes of each row, count of its most frequent one)"""
    keyed = hashes ^ mixed(rows.astype(np.uint64) + numbers(17, 1))
    _, first, counts = np.unique(keyed, return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, rows[first], counts)
    return np.bincount(rows[first], minlength=n).astype(np.float64), top


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text of a piece."""
    n, sizes = len(offsets) - 1, np.diff(offsets).astype(np.float64)
    per = np.maximum(sizes, 1)
    row_of = np.repeat(np.arange(n), np.diff(offsets))
    shares = (np.bincount(row_of * 256 + data, minlength=n * 256).reshape(n, 256) @ _GROUP_MATRIX) / per[:, None]
    out = dict(zip(_GROUPS, shares.T, strict=True))

    words = words_of(LOWER[data], offsets, NOT_BLANK)
    lengths = (words.ends - words.starts).astype(np.float64)
    rows = np.repeat(np.arange(n), np.diff(words.bounds))
    count = np.diff(words.bounds).astype(np.float64)
    each = np.maximum(count, 1)
    total = lambda values: np.bincount(rows, weights=values, minlength=n)
    hashes = words.hashes()
    distinct, top = _distinct(rows, hashes, n)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, rows, lengths)
    first, last = data[words.starts], data[words.ends - 1]
    second = data[np.minimum(words.starts + 1, words.ends - 1)]
    capitals = _GROUPS["upper"][first] & _GROUPS["upper"][second] & (lengths > 1)

    lines = words_of(data, offsets, _LINE)
    line_rows = np.repeat(np.arange(n), np.diff(lines.bounds))
    line_count = np.diff(lines.bounds).astype(np.float64)
    line_distinct, _ = _distinct(line_rows, lines.hashes(), n)
    out |= {
        "log_words": np.log1p(count),
        "log_bytes": np.log1p(sizes),
        "mean_word": total(lengths) / each,
        "longest_word": longest,
        "lines_per_word": line_count / each,
        "distinct_words": distinct / each,
        "repeated_neighbours": total(same) / each,
        "top_word": top / each,
        "repeated_lines": (line_count - line_distinct) / np.maximum(line_count, 1),
        "capital_words": total(capitals.astype(np.float64)) / each,
        "marked_words": total(_MARK_END[last].astype(np.float64)) / each,
    }
    return np.stack([out[s] for s in STATISTICS], axis=1)


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one column for each of STATISTICS) of each row; a null text counts as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column(1)):
                found = statistics_of(data, offsets)
                columns = [batch.column(0).slice(low, high - low), *(pa.array(found[:, i]) for i in range(found.shape[1]))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


# A rule is a set of (statistic number, whether above, threshold) that must all hold.
Rule = tuple[tuple[int, bool, float], ...]


def _grown_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, bins: int, rate: float, seed: int) -> list[Rule]:
    """All paths of boosted regression trees on logistic residuals, each tree grown on a random half of the rows."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    draw, guess, rules = np.random.default_rng(seed), np.zeros(len(y)), {}
    least = max(5, len(y) // 500)

    def split(rows: np.ndarray, target: np.ndarray) -> tuple[int, int] | None:
        best, found = 1e-9, None
        all_n, all_sum = len(rows), target[rows].sum()
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            n = np.cumsum(np.bincount(binned[rows, f], minlength=len(c) + 1))[:-1]
            s = np.cumsum(np.bincount(binned[rows, f], weights=target[rows], minlength=len(c) + 1))[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = s**2 / n + (all_sum - s) ** 2 / (all_n - n) - all_sum**2 / all_n
            gain[(n < least) | (all_n - n < least)] = -1
            if gain.max() > best:
                best, found = gain.max(), (f, int(gain.argmax()))
        return found

    for _ in range(trees):
        target = y - 1 / (1 + np.exp(-guess))
        sampled = draw.random(len(y)) < 0.5
        level: list[tuple[np.ndarray, Rule]] = [(np.ones(len(y), bool), ())]
        for _ in range(depth):
            below = []
            for inside, rule in level:
                cut = split(np.flatnonzero(inside & sampled), target) if (inside & sampled).sum() > 2 * least else None
                if cut is None:
                    below.append((inside, rule))
                    continue
                f, at = cut
                for above in (False, True):
                    part = (*rule, (f, above, float(cuts[f][at])))
                    rules.setdefault(tuple(sorted(set(part))))
                    below.append((inside & ((binned[:, f] > at) == above), part))
            level = below
        for inside, _ in level:
            if (inside & sampled).any():
                guess[inside] += rate * 4 * target[inside & sampled].mean()
    return list(rules)


def _holds(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for f, above, threshold in rule:
            out[:, j] *= (x[:, f] > threshold) == above
    return out


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, steps: int) -> np.ndarray:
    """Weights (the last is the intercept, which is not penalised) by accelerated proximal gradient."""
    n, w = len(y), start.copy()
    v, t = w.copy(), 1.0
    probe = np.ones(a.shape[1] + 1)
    for _ in range(15):  # the largest eigenvalue bounds the curvature
        image = a @ probe[:-1] + probe[-1]
        probe = np.append(a.T @ image, image.sum()) / n
        norm = np.linalg.norm(probe)
        probe /= norm
    size = 4 / (norm * 1.05)
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-(a @ v[:-1] + v[-1]))) - y
        moved = v - size * np.append(a.T @ wrong, wrong.sum()) / n
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - size * penalty, 0)
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = moved + (t - 1) / t_next * (moved - w), moved, t_next
    return w


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """The probability of a good text as an expression over the columns of STATISTICS."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for f, above, threshold in rule:
                column = F.col(STATISTICS[f])
                holds = holds & ((column > threshold) if above else (column <= threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fitted(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32, seed: int = 5) -> RuleModel:
    """The rule model of labelled statistics. The penalty is the one that does best on a fifth of the rows left out.

    Without rows, or with labels of one kind only, the model is a constant: the smoothed share of good texts.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    if len(y) < 20 or y.min() == y.max():
        return RuleModel((), (), intercept)
    rules = _grown_rules(x, y, trees, depth, bins, 0.3, seed)
    if not rules:
        return RuleModel((), (), intercept)
    a = _holds(x, rules)
    held = np.random.default_rng(seed).random(len(y)) < 0.2
    largest = np.abs(a.T @ (y - y.mean())).max() / len(y)
    path = largest * np.geomspace(0.2, 0.002, 6)
    w, losses = np.zeros(len(rules) + 1), []
    w[-1] = intercept
    for penalty in path:
        w = _lasso(a[~held], y[~held], penalty, w, 120)
        z = a[held] @ w[:-1] + w[-1]
        losses.append(np.mean(np.logaddexp(0, z) - y[held] * z))
    w = np.zeros(len(rules) + 1)
    w[-1] = intercept
    for penalty in path[: int(np.argmin(losses)) + 1]:
        w = _lasso(a, y, penalty, w, 150)
    used = [i for i in np.flatnonzero(w[:-1])]
    return RuleModel(tuple(rules[i] for i in used), tuple(float(w[i]) for i in used), float(w[-1]))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def learned(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> RuleModel:
    """Fit on at most ``sample`` labelled documents outside the held-out third: those whose ids hash lowest.

    The sample's ids and statistics are all that reaches the driver. Rows of ``labels`` without an id or a quality of
    0 or 1 teach nothing; several labels of a document count one each.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    marked = marked.where((remainder("doc_id", 3) != 1) & F.col("quality").isin(0, 1))
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    # Bounded by the sample: ids and labels only.
    wanted = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = with_statistics(wanted).join(F.broadcast(drawn), "doc_id").toPandas()
    rows = rows.sort_values(["doc_id", "quality", *STATISTICS])
    return fitted(rows[list(STATISTICS)].to_numpy(np.float64), rows["quality"].to_numpy(np.float64))


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """(doc_id, score, predicted) of each row of ``docs`` (doc_id, text, ...).

    score is the probability of label 1, predicted 1 from a score of 0.5. A null or empty text has statistics of 0 and
    a score like any other. Repeated rows each get their row, a null doc_id is passed on, other columns play no part.
    """
    scored = with_statistics(docs).select("doc_id", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
