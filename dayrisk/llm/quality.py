"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are grown on histograms, keep chosen features monotonic and are flattened into node arrays that score
whole batches level by level.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from dayrisk.llm.common import Words, narrowed, with_arrow_columns
from dayrisk.llm.labelled import SAMPLE, labelled_sample

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics of a document and the direction that quality must follow: -1 falls as it grows, 1 rises, 0 free.
FEATURES = {
    "words": 0, "mean_length": 0, "words_per_line": 0, "distinct_share": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "unlettered_share": -1, "stutter_share": -1, "bang_share": -1, "digit_share": -1,
}
TREES, DEPTH, RATE, BINS, LEAST_ROWS, RIDGE = 80, 4, 0.15, 64, 20, 1.0
LEAST_WORDS = 50


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(codes) < 4:
        return 0
    c = codes.astype(np.int64)
    windows = (c[:-2] * distinct + c[1:-1]) * distinct + c[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : len(again) + shift] |= again
    return int(covered.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word equal to an earlier line, and all lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\v\f")]
    return len(lines) - len(set(lines)), len(lines)


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (a row of BASE for each text) and FEATURES; words are runs of anything but ASCII white space."""
    words = Words(pc.split_pattern_regex(texts, r"[\x20\x09-\x0D]+"))
    unique = pa.array(words.unique, pa.large_string())
    number = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64)
    length = number(pc.utf8_length(unique))
    traits = [
        length,
        number(pc.count_substring_regex(unique, r"[#*$%&|<>]")),
        number(pc.match_substring_regex(unique, r"\p{Lu}\P{Ll}*\p{Lu}")) * number(pc.invert(pc.match_substring_regex(unique, r"\p{Ll}"))),
        number(pc.invert(pc.match_substring_regex(unique, r"\pL"))),
        number(pc.match_substring_regex(unique, r"!!")),
        number(pc.count_substring_regex(unique, r"\pN")),
    ]
    base, features = np.zeros((len(words), len(BASE)), np.int64), np.zeros((len(words), len(FEATURES)))
    for i, text in enumerate(texts.to_pylist()):
        codes = words.of(i)
        n = len(codes)
        chars, symbols, upper, unlettered, bang, digits = (int(t[codes].sum()) for t in traits)
        dup, lines = duplicate_lines(text)
        repeat = repeated_words(codes, max(1, len(words.unique)))
        base[i] = n, chars, symbols, dup, repeat
        m = max(1, n)
        stutter = int((codes[1:] == codes[:-1]).sum())
        features[i] = n, chars / m, n / max(1, lines), len(np.unique(codes)) / m, symbols / max(1, chars), dup / max(1, lines), repeat / m, upper / m, unlettered / m, stutter / m, bang / m, digits / max(1, chars)
    return base, features


class BoostedTrees:
    """Node arrays of all trees: feature (-1 at a leaf), threshold, left and right child, value."""

    def __init__(self, roots, feature, threshold, left, right, value, start):
        self.roots, self.feature, self.threshold, self.left, self.right, self.value, self.start = roots, feature, threshold, left, right, value, start

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row: all rows walk one tree after another, a level at a time."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                below = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, directions: list[int]) -> BoostedTrees:
        """Second-order boosting of the log-loss over quantile bins; a split against a direction is not taken, and the bounds of a
        monotonic split hold below it. With one label only, or no rows, the model is a constant."""
        nodes: list[list] = []
        if not len(y) or y.min() == y.max():
            start = 0.0 if not len(y) else 4.0 * (2 * float(y.min()) - 1)
            return cls(*(np.empty(0, int) for _ in range(2)), np.empty(0), *(np.empty(0, int) for _ in range(2)), np.empty(0), start)
        start = float(np.log(y.mean() / (1 - y.mean())))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        margin, roots = np.full(len(y), start), []

        def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
            g, h = gradient[rows].sum(), hessian[rows].sum()
            own = len(nodes)
            value = float(np.clip(-g / (h + RIDGE), low, high))
            nodes.append([-1, 0.0, own, own, RATE * value])
            best = (1e-6, None)
            if depth and len(rows) >= 2 * LEAST_ROWS:
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, j]
                    gs, hs, ns = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (gradient[rows], hessian[rows], None))
                    lv, rv = np.clip(-gs / (hs + RIDGE), low, high), np.clip(-(g - gs) / (h - hs + RIDGE), low, high)
                    loss = lambda v, a, d: a * v + 0.5 * (d + RIDGE) * v * v
                    gain = loss(value, g, h) - loss(lv, gs, hs) - loss(rv, g - gs, h - hs)
                    gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS) | (directions[j] * (rv - lv) < 0)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), (j, k, float(lv[k]), float(rv[k])))
            if best[1]:
                j, k, lv, rv = best[1]
                below, middle = binned[rows, j] <= k, (lv + rv) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[directions[j]]
                left = grow(rows[below], depth - 1, *bounds[0])
                right = grow(rows[~below], depth - 1, *bounds[1])
                nodes[own][:4] = j, float(cuts[j][k]), left, right
            return own

        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            gradient, hessian = p - y, p * (1 - p)
            first = len(nodes)
            roots.append(grow(np.arange(len(y)), DEPTH, -8.0, 8.0))
            own = cls(np.array([0]), *(np.array(c) for c in zip(*[[f, t, a - first, b - first, v] for f, t, a, b, v in nodes[first:]])), 0.0)
            margin += own.margin(x)
        f, t, a, b, v = zip(*nodes)
        return cls(np.array(roots), np.array(f), np.array(t), np.array(a), np.array(b), np.array(v), start)


FIELDS = [T.StructField(n, T.LongType()) for n in BASE] + [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]


class QualityModel:
    def __init__(self, trees: BoostedTrees):
        self.trees = trees

    @classmethod
    def learn(cls, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> QualityModel:
        """Fit on at most ``bound`` labelled documents; their statistics (a dozen numbers each) are what reaches the driver."""
        sample = labelled_sample(docs, labels, "quality", bound=bound)
        fields = [T.StructField(n, T.DoubleType()) for n in FEATURES]
        columns = lambda texts: [pa.array(c, pa.float64()) for c in statistics(texts)[1].T]
        rows: pd.DataFrame = with_arrow_columns(sample, columns, fields, carry=["doc_id", "label"]).toPandas().sort_values("doc_id")
        return cls(BoostedTrees.fit(rows[list(FEATURES)].to_numpy(float), (rows["label"] > 0).to_numpy(float), list(FEATURES.values())))

    def add_verdict(self, docs: DataFrame, text: str = "text", carry: list[str] | None = None, prefix: str = "") -> DataFrame:
        """``docs`` with BASE, ``base_failed``, ``probability`` and ``kept``; null text has no words and fails the base rules."""
        trees = self.trees

        def make(texts: pa.Array) -> list:
            base, features = statistics(texts)
            n, repeat = base[:, 0], base[:, 4]
            failed = (n < LEAST_WORDS) | (100 * repeat > 50 * n)
            p = trees.probability(features)
            return [*base.T, failed, p, ~failed & (p >= 0.5)]

        return with_arrow_columns(docs, make, [T.StructField(prefix + f.name, f.dataType) for f in FIELDS], text, carry)


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, BASE, base_failed, probability, kept)``, one row for each row of ``docs``.

    Null and empty texts have no words and fail the base rules. Repeated rows and null or tied ids are judged each on their own; an id without a
    label, or labelled null, is not learned from. Texts of any length are read whole. Other columns are not looked at. An empty table gives an empty result.
    """
    return QualityModel.learn(docs, labels).add_verdict(narrowed(docs, "doc_id", "text"), carry=["doc_id"])
