"""Quality scores: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import held_out, labelled_sample, utf8

# Labelled rows the trees are fitted on, at most.
FIT_ROWS = 20_000

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_length", "longest_word",
    "upper", "lower", "digits", "spaces", "ascii_marks", "beyond_ascii", "feeds",
    "distinct_words", "top_word", "single_words", "distinct_pairs",
    "repeated_lines", "line_length", "lines_ended", "marked_words",
)

_CLASS = np.zeros(256, np.int64)  # 0: other controls
for _number, _codes in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), (9, 11, 12, 13, 32), (10,), range(128, 256)), 1
):
    _CLASS[list(_codes)] = _number
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = 7
_IS_MARK = frozenset(_MARKS)


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of STATISTICS; all 0 where there is nothing to count."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    size, n_words, n_lines = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    shares = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=8) / size
    counts = Counter(words)
    lengths = list(map(len, words))
    pairs = max(len(words) - 1, 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)),
        sum(lengths) / n_words, np.log1p(max(lengths, default=0)),
        shares[1], shares[2], shares[3], shares[4], shares[7], shares[6], shares[5],
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        sum(n == 1 for n in counts.values()) / n_words,
        len(set(zip(words, words[1:], strict=False))) / pairs,
        1 - len(set(lines)) / n_lines,
        np.log1p(len(text) / n_lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / n_lines,
        sum(w[-1] in _IS_MARK and w[-1:] not in (b".", b",") for w in words) / n_words,
    ]


def statistics_table(texts: pa.Array) -> np.ndarray:
    rows = [statistics(t) for t in utf8(texts)]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


@dataclass
class Forest:
    """All trees' nodes in flat arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: every row walks down every tree, one level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[row, self.feature[at]] > self.threshold[at]
            at = np.where(right, self.right[at], self.left[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least_rows: int = 10,
) -> Forest:
    """Boosted trees on logistic loss, split at histogram bin edges.

    Without rows, or with one label only, there are no splits: the score is the
    smoothed share of label 1 everywhere.
    """
    ones = float(y.sum())
    base = float(np.log((ones + 1) / (len(y) - ones + 1)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        n = len(feature)
        for column, item in ((feature, 0), (threshold, np.inf), (left, n), (right, n), (value, v)):
            column.append(item)
        return n

    if len(y) == 0 or ones in (0, len(y)):
        trees = 0
    else:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
        cells = binned + np.arange(x.shape[1]) * bins
        margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)

        def grow(rows: np.ndarray, level: int, slope=slope, bend=bend) -> int:
            g, h = slope[rows].sum(), bend[rows].sum()
            own = leaf(-rate * g / (h + ridge))
            if level == depth or len(rows) < 2 * least_rows:
                margin[rows] += value[own]
                return own
            flat = cells[rows].ravel()
            width, n = x.shape[1], x.shape[1] * bins
            shape = (width, bins)
            sums = [
                np.bincount(flat, np.repeat(v[rows], width), n).reshape(shape).cumsum(axis=1)
                for v in (slope, bend)
            ]
            seen = np.bincount(flat, minlength=n).reshape(shape).cumsum(axis=1)
            gl, hl = sums
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(seen < least_rows) | (len(rows) - seen < least_rows)] = 0
            f, b = np.unravel_index(int(np.argmax(gain)), shape)
            if gain[f, b] <= 1e-9:
                margin[rows] += value[own]
                return own
            goes_left = binned[rows, f] <= b
            feature[own], threshold[own] = int(f), float(edges[f][b])
            left[own] = grow(rows[goes_left], level + 1)
            right[own] = grow(rows[~goes_left], level + 1)
            return own

        roots.append(grow(np.arange(len(y)), 0))
    return Forest(
        np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64),
        np.array(right, np.int64), np.array(value), np.array(roots, np.int64), depth, base,
    )


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Forest:
    """Fit on at most `rows` labelled rows; only their statistics come to the driver."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = statistics_table(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(table), pa.list_(pa.float64())), batch.column("label")],
                names=["x", "label"],
            )

    sample = labelled_sample(docs, labels, "quality", rows)
    found = sample.mapInArrow(measure, "x array<double>, label int").toPandas()
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), len(STATISTICS))
    order = np.lexsort((*x.T, found["label"]))
    return fit(x[order], found["label"].to_numpy(np.float64)[order])


def score_quality(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted.

    A null text counts as empty, and an empty one is scored like any other. Rows are scored one by
    one, each whole: a text of many megabytes is one task's memory (many times its size). Repeated rows get
    equal scores; other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = forest.score(statistics_table(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
        .mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
