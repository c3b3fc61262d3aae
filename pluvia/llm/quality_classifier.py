"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a document are plain counts and ratios of its whole text. Trees of one fixed depth
are grown level by level on binned statistics (logistic loss, one histogram a level), on a bounded
sample of labelled rows, and are flattened into arrays: the node ``i`` of a tree has the children
``2i + 1`` and ``2i + 2``, so scoring a batch is a few numpy gathers for each level. Every document
is scored where it lies; the only thing sent to the tasks is the model, whose size is fixed by the
number of trees and their depth.

Defined results: a null text is an empty one, and has a score like any other; without labelled rows of
both classes every score is the smoothed share of label 1; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import map_batches, raw_texts
from pluvia.llm.labelled import training_sample

TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
L2 = 5.0
MIN_ROWS = 20
THRESHOLD = 0.3

STATISTICS = (
    "log_chars log_words word_mean word_std upper lower digit space stop_marks shout symbol bar other_mark non_ascii entropy "
    "unique_words top_word capital_words no_letter_words marked_words log_lines line_mean repeated_lines ended_lines "
    "repeated_triples packed"
).split()

_CLASS = np.zeros(256, np.intp)
for _i, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\v\f", b".,;:", b"!?", b"#*$%&<>@^~=+\\{}[]", b"|", b"\"'()-_/`"), 1
):
    _CLASS[list(_bytes)] = _i
_CLASS[0x80:0xC0] = 10
_CLASS[0xC0:] = 11


def document_statistics(text: bytes) -> list[float]:
    """The values of STATISTICS for one whole text; ratios are 0 where there is nothing to divide by."""
    words, lines = text.split(), text.split(b"\n")
    n, w, rows = len(text), len(words), len(lines)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=by_byte, minlength=12)
    chars = max(1.0, n - kinds[10])
    share = by_byte[by_byte > 0] / max(1, n)
    lengths = np.fromiter(map(len, words), np.int32, w) if w else np.zeros(1, np.int32)
    low = text.lower().split()
    top = Counter(low).most_common(1)[0][1] if w else 0
    filled = [x for x in lines if x]
    per_word = 1 / max(1, w)
    return [
        np.log1p(chars if n else 0),
        np.log1p(w),
        lengths.mean(),
        lengths.std(),
        *(kinds[1:10] / chars),
        kinds[11] / chars,
        float(-(share * np.log2(share)).sum()),
        len(set(low)) * per_word,
        top * per_word,
        sum(map(bytes.isupper, words)) * per_word,
        (w - sum(map(bytes.isalpha, (x.strip(b".,;:!?#*$%&|<>") for x in words)))) * per_word,
        sum(x[-1] in b"#*$%&|<>!" for x in words) * per_word,
        np.log1p(rows),
        n / rows,
        (len(filled) - len(set(filled))) / max(1, len(filled)),
        sum(x.endswith((b".", b"!", b"?", b":")) for x in filled) / max(1, len(filled)),
        (w - 2 - len(set(zip(low, low[1:], low[2:], strict=False)))) / (w - 2) if w > 2 else 0.0,
        len(zlib.compress(text, 1)) / max(1, n),
    ]


def statistics_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([document_statistics(t) for t in texts], np.float32).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature and threshold of [tree, inner node], value of [tree, leaf]."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of ``x``."""
        trees, inner = self.feature.shape
        node, rows, tree = np.zeros((len(x), trees), np.intp), np.arange(len(x))[:, None], np.arange(trees)
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        return 1 / (1 + np.exp(-(self.base + self.value[tree, node - inner].sum(axis=1, dtype=np.float64))))


def fit_forest(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Second-order boosting of the logistic loss on histograms of binned columns."""
    inner, leaves, columns = 2**depth - 1, 2**depth, x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        trees = 0
    feature, threshold, value = np.zeros((trees, inner), np.intp), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves))
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(columns)] if trees else []
    # Bin b holds the values up to edge b, so "bin > b" is "value > edge b".
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1) if trees else None
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.intp)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            total = [np.bincount(at, v, width) for v in (g, h, np.ones(len(y)))]
            best = np.full(width, 1e-6)
            for j in range(columns):
                key = at * bins + binned[:, j]
                left = [np.bincount(key, v, width * bins).reshape(width, bins).cumsum(axis=1)[:, : len(edges[j])] for v in (g, h, np.ones(len(y)))]
                right = [a[:, None] - b for a, b in zip(total, left, strict=True)]
                gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - (total[0] ** 2 / (total[1] + L2))[:, None]
                gain[(left[2] < MIN_ROWS) | (right[2] < MIN_ROWS)] = 0
                pick = gain.argmax(axis=1)
                better = gain[np.arange(width), pick] > best
                best = np.where(better, gain[np.arange(width), pick], best)
                feature[t, first : first + width][better] = j
                threshold[t, first : first + width][better] = edges[j][pick[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        raw += value[t][leaf]
    return Forest(base, feature, threshold, value)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", **limits) -> Forest:
    """Fit on the statistics of a bounded sample of labelled documents, none of them in fold 0.

    The sample's ids are broadcast (their number is bounded) and met by the documents where they lie;
    only its statistics, a few numbers for each sampled row, come to the driver. A text that is there many times
    counts once.
    """
    sample = training_sample(labels, column, **limits)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = statistics_matrix(raw_texts(batch))
            yield {"doc_id": batch["doc_id"], "y": batch["y"], "x": list(x)}

    got = map_batches(rows, measure, "doc_id long, y int, x array<float>").groupBy("x", "y").agg(F.min("doc_id").alias("doc_id")).toArrow().sort_by("doc_id")
    x = np.array(got["x"].combine_chunks().flatten(), np.float32).reshape(-1, len(STATISTICS))
    return fit_forest(x, np.array(got["y"], np.float64))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "score": sent.value.score(statistics_matrix(raw_texts(batch)))}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double")


def keep_good(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.score(statistics_matrix(raw_texts(batch))) >= threshold))

    return map_batches(docs, run, docs.schema)
