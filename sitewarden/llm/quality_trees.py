"""Quality rules: gradient-boosted trees over document statistics.

Trees are grown here, by histograms over at most MAX_SAMPLE labelled documents (the documented bound; the sample is the first so many by a
hash of the id), and flattened into numpy arrays: node i of a tree sends a row to `left` or `right` by `feature` and `cut`. All trees walk at
once over a batch. The score never rises with symbols, repeated lines or repeated words (MONOTONE): splits that would break this are refused
and children inherit the bound between them.

Base rules come first: fewer than 10 words, or over 20 % of the words in repeated 5-word windows, fails.

Cases: null and empty texts have no words and fail the base rules; without usable labels every document that passes the base rules is kept; rows
that share a doc_id are judged by their own text; null or other labels than 0 and 1 are not used; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.llm.common import steps, utf8

MAX_SAMPLE = 20_000
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
LEAST_ROWS = 20
RIDGE = 1.0
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share", "distinct_share", "closed_lines")
MONOTONE = np.array([0, 0, -1, -1, -1, 0, 0, 0, 0])
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of `size` words that occurs twice or more."""
    m = len(words) - size + 1
    if m < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    base, code = len(numbers), ids[:m].copy()
    if base == len(words):
        return 0
    span = base
    for i in range(1, size):
        if span * base >= 1 << 62:
            kinds, code = np.unique(code, return_inverse=True)
            span = len(kinds)
        code = code * base + ids[i : i + m]
        span *= base
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for i in range(size):
        covered[i : i + m] |= twice
    return int(covered.sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of a text."""
    words = text.split()
    size = sum(map(len, words))
    points = len(text.decode("utf-8", "replace")) - (len(text) - size)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    n = max(1, len(words))
    closed = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    features = [
        np.log1p(len(words)),
        points / n,
        symbols / n,
        dup_lines / max(1, len(lines)),
        repeats / n,
        (len(text) - len(text.translate(None, _UPPER))) / max(1, size),
        (len(text) - len(text.translate(None, _DIGITS))) / max(1, size),
        len(set(words)) / n,
        closed / max(1, len(lines)),
    ]
    return [len(words), points, symbols, dup_lines, repeats], features


@dataclass
class Forest:
    """Flattened trees: arrays of shape (trees, nodes)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality of each row."""
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            inside = x[rows, self.feature[trees, node]] <= self.cut[trees, node]
            node = np.where(inside, self.left[trees, node], self.right[trees, node])
        return self.start + self.value[trees, node].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, monotone: np.ndarray = MONOTONE) -> Forest:
    """Boosted trees for the log loss of 0/1 labels."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    size = (1 << (depth + 1)) - 1
    out = Forest(*(np.zeros((trees, size), dtype=t) for t in (np.int64, float, np.int64, np.int64, float)), start, depth)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)

        def split(node: int, rows: np.ndarray, level: int, low: float, high: float, t=t, grad=grad, hess=hess) -> None:
            g, h = grad[rows].sum(), hess[rows].sum()
            value = float(np.clip(g / (h + RIDGE), low, high))
            out.value[t, node] = rate * value
            out.left[t, node] = out.right[t, node] = node
            best = (1e-6, None)
            for f in range(x.shape[1]) if level < depth else ():
                n = len(cuts[f]) + 1
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], n))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], n))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=n))[:-1]
                vl, vr = np.clip(gl / (hl + RIDGE), low, high), np.clip((g - gl) / (h - hl + RIDGE), low, high)
                gain = gl * vl - (hl + RIDGE) * vl**2 / 2 + (g - gl) * vr - (h - hl + RIDGE) * vr**2 / 2 - (g * value - (h + RIDGE) * value**2 / 2)
                ok = (nl >= LEAST_ROWS) & (len(rows) - nl >= LEAST_ROWS) & ((vr - vl) * monotone[f] >= 0)
                gain = np.where(ok, gain, -np.inf)
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (gain[i], (f, i, (vl[i] + vr[i]) / 2))
            if best[1]:
                f, i, middle = best[1]
                out.feature[t, node], out.cut[t, node] = f, cuts[f][i]
                out.left[t, node], out.right[t, node] = 2 * node + 1, 2 * node + 2
                bounds = [(low, high), (low, high)]
                if monotone[f] < 0:
                    bounds = [(max(low, middle), high), (low, min(high, middle))]
                elif monotone[f] > 0:
                    bounds = [(low, min(high, middle)), (max(low, middle), high)]
                inside = binned[rows, f] <= i
                split(2 * node + 1, rows[inside], level + 1, *bounds[0])
                split(2 * node + 2, rows[~inside], level + 1, *bounds[1])

        split(0, np.arange(len(y)), 0, -10.0, 10.0)
        one = Forest(*(a[t : t + 1] for a in (out.feature, out.cut, out.left, out.right, out.value)), 0.0, depth)
        total += one.margin(x)
    return out


def _schema(keep: list[str], rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with the array `features` of the text; for fitting."""
    rows = docs.select(*keep, "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                features = [statistics(t)[1] for t in utf8(part.column("text"))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(features, pa.list_(pa.float64()))], [*keep, "features"])

    return rows.mapInArrow(task, f"{_schema(list(keep), rows)}, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Forest | None:
    """Trees from at most `max_sample` labelled documents; None without both kinds of label."""
    usable = labels.select(F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label")).where("label in (0, 1) and labelled_id is not null")
    # at most max_sample rows of two numbers are broadcast
    sample = usable.groupBy("labelled_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id"))
    found = measured(rows, "doc_id", "label").dropDuplicates(["doc_id"]).select("doc_id", "label", "features").toPandas().sort_values("doc_id")
    if found.label.nunique() < 2:
        return None
    return grow(np.array(found.features.tolist()), found.label.to_numpy(dtype=float))


def judge(docs: DataFrame, forest: Forest | None, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, COUNTS, base_failed, kept, quality (the trees' probability, null without trees)."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    names = ["doc_id", *COUNTS, "base_failed", "kept", "quality"]
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for part in steps(batch):
                both = [statistics(t) for t in utf8(part.column("text"))]
                counts = np.array([c for c, _ in both], dtype=np.int64).reshape(-1, len(COUNTS))
                failed = (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])
                if trees is None:
                    quality, good = [None] * len(both), np.ones(len(both), dtype=bool)
                else:
                    quality = 1 / (1 + np.exp(-trees.margin(np.array([f for _, f in both]))))
                    good = quality >= threshold
                columns = [part.column("doc_id"), *counts.T, failed, good & ~failed, quality]
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, quality double"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(task, schema)
