"""Toxicity: class-conditional Kneser-Ney models, compared by length-normalised log-likelihood.

There is one model of words for toxic and one for ordinary documents. A word is read from its start: each next
byte, or the end, is predicted from all bytes before it. Counts are continuation counts: an opening of a word counts the distinct texts of
a class that have it, so that neither a word repeated in a text nor a copied text counts twice. An absolute discount below
1, estimated from counts of counts, is taken off each count, and the discounted mass goes to backoff counts shared by both classes:

    P_y(c | o) = max(n_y(oc) - D_y, 0) / n_y(o) + b_y(o) (n_0(oc) + n_1(oc)) / (n_0(o) + n_1(o))

n_y(o) is the sum of n_y(oc) over all c, b_y(o) what makes the probabilities sum to 1, and D_y = n1 / (n1 + 2 n2) with the number of openings that
one and two texts of the class have. A form that was hardly seen shares the counts of its opening with all other forms of that stem; what
both classes share cancels. Openings end after OPENING bytes. An opening that only one text has says nothing, in either class.

The log-likelihood ratio of a word is the sum over its openings. A document's evidence is that of its distinct words, less the
median over the document (the preference of a language or a topic) and MARGIN, where more than zero: in all, and normalised by the number of distinct
words. A logistic curve, fitted on a fold of its own with MISSED as the weight of a toxic document, turns both into a score.

Learned from a bounded sample of labelled rows: the openings of its texts are counted by Spark; those with two texts
or more come to the driver and to the tasks as two arrays.

Defined results: a null or empty text, and every text where no label can be learned from, has the score of a document without evidence.
Texts are read whole, however long. Rows with the same doc_id are scored each by its own text, and repeated texts of a class are learned from once. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import SEED, map_batches, raw_texts, text_hash
from pluvia.llm.labelled import training_sample
from pluvia.session import materialise

#: Longest opening, in bytes; a longer word is known by its first so many.
OPENING = 12
#: An opening needs so many texts of both classes together to be evidence.
LEAST_TEXTS = 2
MARGIN = 1.5
#: A toxic document that is missed weighs as much as so many ordinary ones that are marked.
MISSED = 2.0
CALIBRATION_FOLD = 4
THRESHOLD = 0.5

#: Openings that a task counts before it sends them on, and words whose ratios it remembers.
COUNTED = 1 << 20
REMEMBERED = 1 << 19

_AROUND = b".,;:!?\"'()[]{}<>*#$%&|-_"
_END = b"\0"

OPENINGS = "opening long, before long, size int, n0 long, n1 long"


def words_of(text: bytes) -> set[bytes]:
    """Distinct words, A-Z in lower case and without punctuation around them."""
    return {w.strip(_AROUND) for w in set(text.lower().split())} - {b""}


def openings(word: bytes) -> list[int]:
    """Marks of all openings of a word from the empty one on; the last is the whole word, or its first OPENING bytes."""
    whole = word + _END
    return [xxhash.xxh64_intdigest(whole[:k], SEED) - (1 << 63) for k in range(min(len(whole), OPENING) + 1)]


def count_openings(rows: DataFrame) -> DataFrame:
    """(opening, before, size, n0, n1): the texts of each class of ``rows`` (y, text) that have an opening, and the opening one byte shorter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[tuple[int, int, int], list[int]] = {}

        def send() -> dict:
            keys, values = list(counts), list(counts.values())
            counts.clear()
            columns = [[k[i] for k in keys] for i in range(3)] + [[v[y] for v in values] for y in (0, 1)]
            return dict(zip(("opening", "before", "size", "n0", "n1"), columns, strict=True))

        for batch in batches:
            for y, text in zip(batch["y"].to_pylist(), raw_texts(batch), strict=True):
                found = set()
                for word in words_of(text):
                    marks = openings(word)
                    found.update(zip(marks[1:], marks, range(1, len(marks)), strict=False))
                for key in found:
                    counts.setdefault(key, [0, 0])[y] += 1
                if len(counts) >= COUNTED:
                    yield send()
        yield send()

    apart = rows.withColumn("_h", text_hash()).dropDuplicates(["y", "_h"]).select("y", "text")
    return map_batches(apart, count, OPENINGS).groupBy("opening", "before", "size").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def discounts(counts: DataFrame) -> tuple[float, float]:
    """D_y = n1 / (n1 + 2 n2) from counts of counts; a half where there are none."""
    seen = counts.agg(*[F.count_if(F.col(f"n{y}") == k).alias(f"c{y}{k}") for y in (0, 1) for k in (1, 2)]).first()
    return tuple(seen[f"c{y}1"] / (seen[f"c{y}1"] + 2 * seen[f"c{y}2"]) if seen[f"c{y}1"] else 0.5 for y in (0, 1))


def probabilities(counts: DataFrame, discount: tuple[float, float]) -> DataFrame:
    """``counts`` with p0 and p1: the probability of the last byte of an opening after the bytes before, in each class."""
    after = {y: F.greatest(F.col(f"n{y}") - F.lit(discount[y]), F.lit(0.0)) for y in (0, 1)}
    sums = [F.sum(f"n{y}").alias(f"s{y}") for y in (0, 1)] + [F.sum(after[y]).alias(f"k{y}") for y in (0, 1)]
    joined = counts.join(counts.groupBy("before").agg(*sums), "before")
    shared = (F.col("n0") + F.col("n1")) / (F.col("s0") + F.col("s1"))

    def p(y: int):
        s = F.col(f"s{y}")
        return F.when(s == 0, shared).otherwise(after[y] / s + (1 - F.col(f"k{y}") / s) * shared)

    return joined.select("opening", "before", "size", "n0", "n1", p(0).alias("p0"), p(1).alias("p1"))


@dataclass(frozen=True)
class Models:
    """Sorted marks of openings, the log-likelihood ratio of each with all before it, and the curve."""

    marks: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray  # of 1 and the two measures of evidence

    def word_ratios(self, words: Iterable[bytes]) -> list[float]:
        """log P_1 - log P_0 of each word: that of its longest opening that is known."""
        marks = [openings(w)[1:] for w in words]
        if not len(self.marks) or not marks:
            return [0.0] * len(marks)
        flat = np.array([m for own in marks for m in own], np.int64)
        at = np.minimum(np.searchsorted(self.marks, flat), len(self.marks) - 1)
        found = np.where(self.marks[at] == flat, at, -1)
        ends = np.cumsum([len(own) for own in marks])
        place = np.maximum.accumulate(np.where(found >= 0, np.arange(len(flat)), -1))[ends - 1]
        known = place >= np.r_[0, ends[:-1]]
        return np.where(known, self.ratios[np.where(known, found[place], 0)], 0.0).tolist()

    def evidence(self, words: set[bytes], known: dict[bytes, float]) -> tuple[float, float]:
        """Evidence in all, and for each word, both on a log scale. ``known`` remembers words."""
        if not words:
            return 0.0, 0.0
        if new := [w for w in words if w not in known]:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(words)
            known.update(zip(new, self.word_ratios(new), strict=True))
        ratio = np.array([known[w] for w in words])
        over = float(np.maximum(ratio - np.median(ratio) - MARGIN, 0).sum())
        return float(np.log1p(over)), float(np.log1p(1000 * over / len(ratio)))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[0] + evidence @ self.weights[1:])))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton's method on weighted rows; only the slopes are penalised."""
    a = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-3] + [l2] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + ridge, a.T @ (weight * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", **limits) -> Models:
    """Models of a bounded sample of labelled documents; a logistic curve from the fold left out of them."""
    sample = training_sample(labels, column, **limits)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "fold", "text")
    counts = materialise(count_openings(rows.where(F.col("fold") != CALIBRATION_FOLD).select("y", "text")), "openings")
    found = counts.agg(*[F.coalesce(F.sum(f"n{y}"), F.lit(0)).alias(f"n{y}") for y in (0, 1)]).first()
    if not (found["n0"] and found["n1"]):
        return Models(np.zeros(0, np.int64), np.zeros(0), np.array([np.log((found["n1"] > 0) + 0.5), 0.0, 0.0]))
    known = probabilities(counts, discounts(counts)).where(F.col("n0") + F.col("n1") >= LEAST_TEXTS)
    table = known.select("opening", "before", "size", (F.log("p1") - F.log("p0")).alias("ratio")).toArrow().sort_by("opening")
    marks, before = np.array(table["opening"], np.int64), np.array(table["before"], np.int64)
    size, ratios = np.array(table["size"]), table["ratio"].to_numpy().copy()
    for k in range(2, OPENING + 1):  # an opening that is known has all shorter ones known
        here = np.flatnonzero(size == k)
        ratios[here] += ratios[np.searchsorted(marks, before[here])]
    models = Models(marks, ratios.astype(np.float32), np.zeros(3))

    held = evidence(rows.where(F.col("fold") == CALIBRATION_FOLD), models, "y").groupBy("total", "mean", "y").count().toArrow()
    x, y, n = np.c_[np.array(held["total"], float), np.array(held["mean"], float)], np.array(held["y"], float), np.array(held["count"], float)
    weights = fit_logistic(x, y, n * np.where(y > 0, MISSED, 1.0)) if len(x) else np.array([-1.0, 1.0, 1.0])
    return Models(models.marks, models.ratios, weights)


def evidence(docs: DataFrame, models: Models, *more: str) -> DataFrame:
    """(doc_id, total, mean) of every document, and the columns named in ``more``."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[bytes, float] = {}
        for batch in batches:
            got = np.array([sent.value.evidence(words_of(t), known) for t in raw_texts(batch)], float).reshape(-1, 2)
            yield {"doc_id": batch["doc_id"], "total": got[:, 0], "mean": got[:, 1]} | {c: batch[c] for c in more}

    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long, total double, mean double", *(f"{c} {kinds[c]}" for c in more)])
    return map_batches(docs.select("doc_id", "text", *more), run, schema)


def score(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, score) of every document."""
    a, b, c = map(float, models.weights)
    return evidence(docs, models).select("doc_id", (1 / (1 + F.exp(-(a + b * F.col("total") + c * F.col("mean"))))).alias("score"))
