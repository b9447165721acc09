"""Quality classifier: a sparse ensemble of rules over text statistics.

Small regression trees are boosted on labelled rows; every path from a root to a node becomes a conjunctive rule. A logistic
model with lasso penalty weighs the rules, most of them at 0, and the rest are compiled into one Spark column expression.

Only the fit is bounded: ``SAMPLE`` labelled rows, chosen by a hash of their id; statistics and scores cover every document and
whole texts.

Defined results: null and empty texts have statistics 0 and a score like any text; null ids belong to the remainder of the empty
text and are never trained on, as no label joins them. Of several labels of one id the lowest counts. With no labels, or one
class only, the score is the smoothed share of label 1. Repeated rows are scored each. Empty tables give an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm import text as T
from cotalake.llm.common import bounded_sample, remainder, written

#: Most labelled rows that the fit takes.
SAMPLE = 12_000
TREES, DEPTH, BINS = 24, 3, 24
PENALTY = 1.5e-3
SEED = 4

STATISTICS = [
    "log_chars", "log_words", "word_length", "upper", "digit", "symbol", "pipe", "exclaim", "stop", "blank",
    "wide", "distinct", "line_words", "short_words", "long_words", "top_repeat",
]

_B = T._BYTES
_CLASSES = {
    "upper": (_B >= 0x41) & (_B <= 0x5A),
    "digit": (_B >= 0x30) & (_B <= 0x39),
    "symbol": np.isin(_B, np.frombuffer(b"#$%&*@^~<>=+_/\\{}[]", np.uint8)),
    "pipe": _B == 0x7C,
    "exclaim": (_B == 0x21) | (_B == 0x3F),
    "stop": (_B == 0x2E) | (_B == 0x2C) | (_B == 0x3B) | (_B == 0x3A),
    "blank": ~T.VISIBLE,
    "wide": (_B & 0xC0) == 0xC0,
    "follow": (_B & 0xC0) == 0x80,
    "line": _B == 0x0A,
}


def statistics_of(column: pa.Array) -> np.ndarray:
    """One row of statistics per text, in the order of ``STATISTICS``."""
    out = np.zeros((len(column), len(STATISTICS)))
    data, offsets = T.utf8(column)
    ranges = iter(T.groups(offsets))
    for first, counts, hashes in T.words(column, T.VISIBLE):
        lo, hi = next(ranges)
        part, bounds = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        size = np.diff(bounds)
        of = {name: T.sums(table[part], size) for name, table in _CLASSES.items()}
        chars = size - of["follow"]
        per = np.maximum(chars, 1).astype(float)
        starts, ends = T.spans(part, bounds, T.VISIBLE)
        lengths = ends - starts
        words = np.maximum(counts, 1).astype(float)
        # Distinct words and the most frequent one, from one sort of (row, hash).
        owner = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((hashes, owner))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][new], minlength=len(counts))
        runs = np.diff(np.append(np.flatnonzero(new), len(order)))
        most = np.zeros(len(counts))
        np.maximum.at(most, owner[order][new], runs)
        out[lo:hi] = np.column_stack([
            np.log1p(chars), np.log1p(counts), T.sums(lengths, counts) / words,
            *[of[k] / per for k in ("upper", "digit", "symbol", "pipe", "exclaim", "stop", "blank", "wide")],
            distinct / words, counts / (of["line"] + 1.0), T.sums((lengths <= 2).astype(np.int64), counts) / words,
            T.sums((lengths >= 16).astype(np.int64), counts) / words, most / words,
        ])
    return out


def statistics(text: Column) -> Column:
    """An array of doubles, one for each of ``STATISTICS``."""

    @F.arrow_udf("array<double>")
    def run(column: pa.Array) -> pa.Array:
        found = statistics_of(column)
        return pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1], pa.array(found.ravel()))

    return run(text)


#: A condition: statistic, whether at most (else above), bound.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]

    def score(self, stats: Column) -> Column:
        """The ensemble as one expression over the array of statistics."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            holds = None
            for index, at_most, bound in rule:
                value = F.element_at(stats, index + 1)
                test = value <= bound if at_most else value > bound
                holds = test if holds is None else holds & test
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def describe(self) -> list[str]:
        return [
            f"{weight:+.3f} if " + " and ".join(f"{STATISTICS[i]} {'<=' if low else '>'} {bound:.4g}" for i, low, bound in rule)
            for rule, weight in sorted(zip(self.rules, self.weights), key=lambda x: -abs(x[1]))
        ]


def _grow(codes: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray, list[tuple[Condition, ...]]]:
    """One tree: the value it adds to each row, and the paths to all its nodes but the root."""
    value = np.zeros(len(codes))
    paths: list[tuple[Condition, ...]] = []

    def split(rows: np.ndarray, path: tuple[Condition, ...], depth: int) -> None:
        g, h = gradient[rows], curvature[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-6, -1, 0)
        if depth < DEPTH and len(rows) >= 20:
            for f in range(codes.shape[1]):
                if not len(edges[f]):
                    continue
                gs = np.cumsum(np.bincount(codes[rows, f], g, len(edges[f]) + 1))[:-1]
                hs = np.cumsum(np.bincount(codes[rows, f], h, len(edges[f]) + 1))[:-1]
                n = np.cumsum(np.bincount(codes[rows, f], minlength=len(edges[f]) + 1))[:-1]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                gain[(n < 5) | (len(rows) - n < 5)] = -1
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        _, f, at = best
        if f < 0:
            value[rows] = total_g / (total_h + 1)
            return
        low = codes[rows, f] <= at
        for side, at_most in ((low, True), (~low, False)):
            longer = (*path, (f, at_most, float(edges[f][at])))
            paths.append(longer)
            split(rows[side], longer, depth + 1)

    split(np.arange(len(codes)), (), 0)
    return value, paths


def fit(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """Boosted trees for the rules, then their lasso weights."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    bias = float(np.log(share / (1 - share)))
    if len(y) < 20 or y.min() == y.max():
        return RuleEnsemble(bias, (), ())
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    random, total = np.random.default_rng(SEED), np.full(len(y), bias)
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        part = random.random(len(y)) < 0.7
        value = np.zeros(len(y))
        value[part], paths = _grow(codes[part], edges, (y - p)[part], (p * (1 - p))[part])
        total += 0.4 * value
        for path in paths:
            rules[path] = None
    listed = list(rules)
    holds = np.ones((len(y), len(listed)), bool)
    for k, rule in enumerate(listed):
        for f, at_most, bound in rule:
            holds[:, k] &= (x[:, f] <= bound) if at_most else (x[:, f] > bound)
    # Rules that hold for the same rows are one rule.
    _, unique = np.unique(holds, axis=1, return_index=True)
    listed, design = [listed[i] for i in sorted(unique)], holds[:, sorted(unique)].astype(np.float64)
    weights, bias = _lasso(design, y, bias)
    used = np.flatnonzero(np.abs(weights) > 1e-4)
    return RuleEnsemble(bias, tuple(listed[i] for i in used), tuple(float(weights[i]) for i in used))


def _lasso(design: np.ndarray, y: np.ndarray, bias: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an absolute penalty, by accelerated proximal gradient steps."""
    n = len(y)
    spread = np.sqrt(np.maximum(design.var(axis=0), 1e-4))
    scaled, centre = design / spread, design.mean(axis=0) / spread
    scaled = scaled - centre
    vector = np.ones(scaled.shape[1])
    for _ in range(20):
        vector = scaled.T @ (scaled @ vector)
        vector /= np.linalg.norm(vector) or 1.0
    step = 4 * n / max(float(np.linalg.norm(scaled.T @ (scaled @ vector))), float(n))
    weights = previous = np.zeros(scaled.shape[1])
    b = before = bias
    momentum = 1.0
    for _ in range(rounds):
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, ahead_b = weights + (momentum - 1) / grown * (weights - previous), b + (momentum - 1) / grown * (b - before)
        error = 1 / (1 + np.exp(-(scaled @ ahead + ahead_b))) - y
        moved = ahead - step * (scaled.T @ error) / n
        previous, before = weights, b
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        b, momentum = ahead_b - step * error.mean(), grown
    return weights / spread, float(b - (weights * centre).sum())


def score_documents(docs: DataFrame, labels: DataFrame, divisor: int = 3, held: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; labels of held-out rows are never read.

    Every text is read once; its statistics are stored, and the score is computed from them.
    """
    stats = written(docs.select("doc_id", statistics(F.col("text")).alias("stats")), "quality_statistics")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), divisor) != held))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = bounded_sample(known.join(stats, "doc_id"), "doc_id", SAMPLE, SEED).select("stats", "quality").collect()
    x = np.array([r[0] for r in rows], float).reshape(len(rows), len(STATISTICS))
    model = fit(x, np.array([r[1] for r in rows], float))
    scored = stats.select("doc_id", (remainder(F.col("doc_id"), divisor) == held).alias("held_out"), model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
