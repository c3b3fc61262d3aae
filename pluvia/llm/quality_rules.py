"""Quality rules: plain text rules, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed unigrams and bigrams are counted over whole texts: one of the raw corpus
(every document), one of the trusted target (documents whose label says so). The score of a document is
the mean over its n-grams of log p_target - log p_raw, so it does not grow with length. A trusted document is scored
without its own counts in the target, like a document that has no label. Target counts are smoothed towards the raw corpus
in proportion to their number.

The threshold follows from these held-out scores of labelled documents that pass the base rules: half-way
between the score that all but LOST of the trusted reach and the highest score of a rejected document below it. Where no
rejected document is below, the score tells nothing apart and only the base rules decide.

The tables have 2**BUCKET_BITS numbers each, whatever the corpus. Their counts are added up in the tasks before
the shuffle, so no n-gram is ever a row of its own.

Defined results: a null or empty text has no words, fails the base rule and has score 0; with no trusted
document every score is 0; a row without doc_id is scored but never trusted; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import WordHashes, attach, map_batches, raw_texts
from pluvia.llm.labelled import labelled
from pluvia.session import materialise

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS

#: Weight of the raw corpus in the target's counts, as a share of their number.
PRIOR = 0.1
#: The share of trusted documents whose scores may lie below what the threshold is derived from.
LOST = 0.01

MIN_WORDS = 50
MAX_REPEATED = 50

_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd, to spread pairs of hashes
_SPACE, _SYMBOL, _CONTINUED = list(b" \t\n\v\f\r"), list(b"#*$%&|<>"), slice(0x80, 0xC0)


def ngram_buckets(hashes: np.ndarray) -> np.ndarray:
    """The bucket of each word and of each pair of neighbours, from 64-bit word hashes."""
    pairs = (hashes[:-1] * _SPREAD) ^ hashes[1:]
    both = np.concatenate([hashes, pairs * _SPREAD]) if len(hashes) else hashes
    return (both >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def ngram_counts(docs: DataFrame, labels: DataFrame, column: str = "quality") -> np.ndarray:
    """[2, BUCKETS] counts over all documents: of the raw corpus and of the trusted target."""
    trusted = labelled(labels, column).where("y = 1").select("doc_id", F.lit(True).alias("trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes, counts = WordHashes(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            found = {False: [], True: []}
            for good, text in zip(batch["trusted"].to_pylist(), raw_texts(batch), strict=True):
                found[bool(good)].append(ngram_buckets(hashes.of(text.lower().split())))
            for good, parts in found.items():
                if parts:
                    n = np.bincount(np.concatenate(parts), minlength=BUCKETS)
                    counts[0] += n
                    counts[1] += n * good
        seen = np.flatnonzero(counts[0])
        yield {"bucket": seen, "raw": counts[0, seen], "target": counts[1, seen]}

    rows = attach(docs.select("doc_id", "text"), trusted, ["doc_id"]).select("text", "trusted")
    parts = map_batches(rows, count, "bucket long, raw long, target long")
    got = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, BUCKETS), np.int64)
    for i, name in enumerate(("raw", "target")):
        counts[i, np.array(got["bucket"], np.int64)] = np.array(got[name], np.int64)
    return counts


def log_ratios(counts: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log p_target - log p_raw of each bucket."""
    raw, weight = (counts[0] + 1) / (counts[0].sum() + BUCKETS), max(prior * counts[1].sum(), 1.0)
    return np.log((counts[1] + weight * raw) / (counts[1].sum() + weight)) - np.log(raw)


def mean_ratio(found: np.ndarray, counts: np.ndarray, trusted: bool, prior: float = PRIOR) -> float:
    """The mean log-ratio over the buckets of a text; a trusted text's own counts are taken out of the target."""
    seen, n = np.unique(found, return_counts=True)
    raw, total = (counts[0, seen] + 1) / (counts[0].sum() + BUCKETS), int(counts[1].sum())
    own, own_total = (n, len(found)) if trusted else (0, 0)
    weight = max(prior * total, 1.0)
    ratios = np.log((np.maximum(counts[1, seen] - own, 0) + weight * raw) / (max(total - own_total, 0) + weight)) - np.log(raw)
    return float((ratios * n).sum() / len(found))


def repeated_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    if len(hashes) < width + 1:
        return 0
    ids = np.unique(hashes, return_inverse=True)[1]
    key, size = ids, int(ids.max()) + 1
    for i in range(1, width):
        key = key[:-1] * size + ids[i:]
        if i < width - 1:  # keeps the next product below 2**63 for any text
            key = np.unique(key, return_inverse=True)[1]
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    covered, start = np.zeros(len(hashes), bool), n[at] > 1
    for i in range(width):
        covered[i : i + len(start)] |= start
    return int(covered.sum())


def rule_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - int(by_byte[_CONTINUED].sum()) - int(by_byte[_SPACE].sum()),
        int(by_byte[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


def held_out_threshold(scored: DataFrame, lost: float = LOST) -> float:
    """The least score of a document that stays, from ``scored`` (y, base_failed, score); see above."""
    rows = scored.where("y is not null and not base_failed")
    reached = rows.where("y = 1").agg(F.percentile_approx("score", lost, 1_000_000).alias("q")).first()["q"]
    if reached is None:
        return float("-inf")
    below = rows.where((F.col("y") == 0) & (F.col("score") < reached)).agg(F.max("score").alias("below")).first()["below"]
    return float("-inf") if below is None else (below + reached) / 2


def judge(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """The rule counts, score and verdicts of every document."""
    counts = ngram_counts(docs, labels, column)
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        for batch in batches:
            rules, scores = [], []
            for y, text in zip(batch["y"].to_pylist(), raw_texts(batch), strict=True):
                words, low = text.split(), text.lower().split()
                rules.append(rule_counts(text, words, hashes.of(words)))
                scores.append(mean_ratio(ngram_buckets(hashes.of(low)), sent.value, y == 1) if low and sent.value[1].any() else 0.0)
            n = np.array(rules, np.int64).reshape(-1, 5)
            failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEATED * n[:, 0])
            yield dict(zip(("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), (batch["doc_id"], *n.T), strict=True)) | {
                "base_failed": failed,
                "score": scores,
                "y": batch["y"],
            }

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    schema = ", ".join(f"{c} long" for c in names[:-1]) + ", base_failed boolean, score double, y int"
    rows = attach(docs.select("doc_id", "text"), labelled(labels, column), ["doc_id"]).select("doc_id", "text", "y")
    scored = materialise(map_batches(rows, run, schema), "scored")
    kept = ~F.col("base_failed") & (F.col("score") >= held_out_threshold(scored))
    return scored.select(*names, kept.alias("kept"), "score")
