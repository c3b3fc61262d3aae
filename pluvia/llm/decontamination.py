"""Benchmark decontamination: BM25 over an inverted index of test items, with the bound of block-max WAND.

The test items are the indexed side and every passage of every training document is a query. Passages are
windows of twice the longest item, half overlapping, so each item that a text holds lies whole inside one.
An item's threshold is a share of the score it gives itself, and impacts are stored divided by it, so that
"above threshold" is one number for all items. Items lie in blocks, and every word has its largest impact in
each block. A passage is bounded by the block maxima of its words, for all passages of a document at once, which
skips every block of items that cannot reach the threshold; items of the remaining blocks are scored in full. (Of block-max WAND this is the
pruning by block maxima, computed for all blocks at once; there are no cursors and pivots, which numpy would have to
step one by one.) Every item above its threshold is retrieved, none is cut off by rank, and then verified: the word shingles of
its question (all but the last sentence) and the words of its answer (the last sentence) must be in the passage.

Document frequencies, the mean length and the width of a passage are those of all items, counted by Spark, so a score does not depend
on how items are indexed. The index is broadcast. Items that measure more than SHARD_BYTES are indexed in shards, one
pass over the documents each; a shard is built, sent and released before the next one. An index with many terms
has fewer blocks, so that its tables stay within INDEX_BYTES; that changes what is skipped and never what is found.

Defined results: null and empty texts are never retrieved; an item without words is passed over, and an item that is there twice, with
the same text, counts once; a repeated row is judged as often as it is there, and one without a doc_id like any other; a text of any
length is read whole. Of passages with the same overlap with the question the first is reported. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import attach, fresh, map_batches, raw_texts, text_hash
from pluvia.session import materialise

K1, B = 1.2, 0.75
#: Share of its own score that an item must reach to be retrieved.
RETRIEVE = 0.5
SHINGLE = 5
QUESTION_OVERLAP = 0.8
ANSWER_OVERLAP = 0.5
#: An index has at most this many blocks; a larger one has more items in each.
BLOCKS = 256
SHARD_BYTES = 8 << 20
#: Bytes of the tables of an index by term and block.
INDEX_BYTES = 64 << 20

_AROUND = b".,;:!?\"'()[]{}<>*#$%&|-_"


def terms(text: bytes) -> list[bytes]:
    """Words in lower case, without punctuation around them."""
    return [w for w in (x.strip(_AROUND) for x in text.lower().split()) if w]


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The words before the last sentence, and those of it; a single sentence is its own question and answer."""
    sentences = [s for s in (terms(x) for x in re.split(rb"(?<=[.!?])\s+", text)) if s]
    if len(sentences) < 2:
        return (sentences or [[]])[0], (sentences or [[]])[0]
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def shingles(words: list[bytes], width: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Runs of ``width`` words."""
    return set(zip(*(words[i:] for i in range(width)), strict=False))


class TermNumbers(dict):
    """Raw word -> its number in the index, 0 for a word that no item has. Remembers a bounded number of words."""

    LIMIT = 400_000

    def __init__(self, numbers: dict[bytes, int]) -> None:
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        n = self[word] = self.numbers.get(word.strip(_AROUND), 0)
        return n


@dataclass(frozen=True)
class Index:
    """Postings of each term by item block, with impacts as shares of the items' thresholds."""

    items: list  # item ids
    texts: list[bytes]
    own: np.ndarray  # score an item gives itself
    numbers: dict[bytes, int]
    block: int  # items in a block
    block_most: np.ndarray  # [terms, blocks] largest impact in a block of items
    first: np.ndarray  # [terms, blocks + 1] where the postings of a block begin
    posting: np.ndarray  # item numbers
    impact: np.ndarray
    half: int  # words of half a passage

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(start, blocks) of the passages of a document that block maxima cannot rule out.

        A passage is two neighbouring halves; its bound is the sum of theirs, each over distinct words.
        """
        chunks, step, before = -(-len(words) // self.half), 64, None
        for a in range(0, chunks, step):  # a very long text is bounded in parts
            part = words[a * self.half : (a + step) * self.half]
            keys = np.unique((np.arange(len(part)) // self.half) * len(self.block_most) + part)
            chunk, term = keys // len(self.block_most), keys % len(self.block_most)
            bound = np.add.reduceat(self.block_most[term], np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), axis=0)
            if before is not None:
                bound = np.concatenate([before, bound])
            alone = chunks == 1
            pairs = bound if alone else bound[:-1] + bound[1:]
            offset = a - (before is not None)
            for i in np.flatnonzero((pairs >= 1 - 1e-4).any(axis=1)):
                yield int(offset + i) * self.half, np.flatnonzero(pairs[i] >= 1 - 1e-4)
            before = bound[-1:]

    def retrieve(self, words: np.ndarray, blocks: np.ndarray) -> dict[int, float]:
        """Items of the blocks whose score for the passage reaches their threshold, with the score as a share of it."""
        distinct = np.unique(words)[:, None]
        a, b = self.first[distinct, blocks].ravel(), self.first[distinct, blocks + 1].ravel()
        n = b - a
        at = np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        scores = np.bincount(self.posting[at], self.impact[at], len(self.items))
        return {int(i): float(scores[i]) for i in np.flatnonzero(scores >= 1 - 1e-9)}


@dataclass(frozen=True)
class Statistics:
    """Of all items: their number, their mean and largest length, and in how many each of the terms asked for is."""

    items: int
    mean: float
    longest: int
    frequency: dict[bytes, int]


def statistics_of(items: list[tuple[object, bytes]]) -> Statistics:
    """Statistics of items that are all of them."""
    counted = [c for _, t in items if (c := Counter(terms(t)))]
    lengths = [sum(c.values()) for c in counted]
    return Statistics(len(counted), sum(lengths) / max(1, len(lengths)), max(lengths, default=1), Counter(w for c in counted for w in c))


def build_index(items: list[tuple[object, bytes]], whole: Statistics | None = None) -> Index:
    """An index of (item id, text); items without words are left out. ``whole``: of all items, where these are a part."""
    whole = whole or statistics_of(items)
    counted = [(i, t, c) for i, t in items if (c := Counter(terms(t)))]
    numbers: dict[bytes, int] = {}
    for _, _, c in counted:
        for w in c:
            numbers.setdefault(w, len(numbers) + 1)
    n, lengths = len(counted), np.array([sum(c.values()) for _, _, c in counted], float)
    term = np.array([numbers[w] for _, _, c in counted for w in c], np.int64)
    item = np.repeat(np.arange(n), [len(c) for _, _, c in counted]).astype(np.int64)
    tf = np.array([k for _, _, c in counted for k in c.values()], float)
    df = np.array([0, *(whole.frequency[w] for w in numbers)], float)
    idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * lengths / max(1.0, whole.mean))
    score = idf[term] * tf * (K1 + 1) / (tf + norm[item]) if n else np.zeros(0)
    own = np.bincount(item, score, n)
    impact = score / (RETRIEVE * own[item]) if n else score
    most = max(1, min(BLOCKS, INDEX_BYTES // (8 * (len(numbers) + 1))))
    size = max(1, -(-n // most))
    blocks = max(1, -(-n // size))
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    block_most = np.zeros((len(numbers) + 1, blocks), np.float32)
    np.maximum.at(block_most, (term, item // size), impact.astype(np.float32))
    first = np.zeros((len(numbers) + 1, blocks + 1), np.int32)
    counts = np.bincount(term * blocks + item // size, minlength=(len(numbers) + 1) * blocks).reshape(-1, blocks)
    np.cumsum(counts, axis=1, out=first[:, 1:], dtype=np.int32)
    first += np.r_[0, np.cumsum(counts.sum(axis=1))[:-1]].astype(np.int32)[:, None]
    return Index([i for i, _, _ in counted], [t for _, t, _ in counted], own, numbers, size, block_most, first, item, impact, max(32, whole.longest))


@dataclass(frozen=True)
class Leak:
    item: object
    start: int
    score: float
    question: float
    answer: float


def leaks(text: bytes, index: Index, cache: TermNumbers) -> list[Leak]:
    """The verified items of one whole text, each with its best passage."""
    raw = [w for w in text.lower().split() if w.strip(_AROUND)] if index.items else []
    if not raw:
        return []
    words = np.fromiter(map(cache.__getitem__, raw), np.int64, len(raw))
    best: dict[int, Leak] = {}
    for a, blocks in index.candidates(words):
        b = a + 2 * index.half
        for i, share in index.retrieve(words[a:b], blocks).items():
            question, answer = question_and_answer(index.texts[i])
            passage = [w.strip(_AROUND) for w in raw[a:b]]
            width = min(SHINGLE, len(question))
            have, want = shingles(passage, width), shingles(question, width)
            q, known = len(want & have) / len(want), set(passage)
            r = sum(w in known for w in answer) / len(answer)
            if q >= QUESTION_OVERLAP and r >= ANSWER_OVERLAP and (i not in best or q > best[i].question):
                best[i] = Leak(index.items[i], a, share * RETRIEVE * float(index.own[i]), q, r)
    return list(best.values())


def _item_terms(items: DataFrame) -> DataFrame:
    """(part, term, length): a row for each item and distinct term of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            counted = [(p, Counter(terms(t))) for p, t in zip(batch["part"].to_pylist(), raw_texts(batch), strict=True)]
            yield {
                "part": np.array([p for p, c in counted for _ in c], np.int64),
                "term": pa.array([w for _, c in counted for w in c], pa.binary()),
                "length": np.array([sum(c.values()) if i == 0 else 0 for _, c in counted for i in range(len(c))], np.int64),
            }

    return map_batches(items.select("part", "text"), run, "part long, term binary, length long")


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[int, Iterator[Index]]:
    """The number of indexes that together hold all items, and one after the other, none of more than about ``shard_bytes`` of text."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // shard_bytes))
    items = materialise(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))), "items")

    def build() -> Iterator[Index]:
        found = materialise(_item_terms(items), "terms") if shards > 1 else None
        if found is not None:
            # The row of an item's first term has its length.
            seen = found.agg(F.count_if(F.col("length") > 0).alias("n"), F.sum("length").alias("total"), F.max("length").alias("longest")).first()
            frequency = materialise(found.groupBy("term").agg(F.count("*").alias("df")), "frequency")
        for k in range(shards):
            part = items.where(F.col("part") == k).toArrow()
            rows = sorted(zip(part["item_id"].to_pylist(), (t.encode() for t in part["text"].to_pylist()), strict=True), key=lambda r: (str(r[0]), r[1]))
            whole = None
            if found is not None and seen["n"]:
                own = attach(found.where(F.col("part") == k).select("term").distinct(), frequency, ["term"]).toArrow()
                whole = Statistics(seen["n"], seen["total"] / seen["n"], seen["longest"], dict(zip(own["term"].to_pylist(), own["df"].to_pylist(), strict=True)))
            yield build_index(rows, whole)

    return shards, build()


def _found(docs: DataFrame, index: Broadcast, kind: str, *more: str) -> DataFrame:
    """``contaminated`` for one index, and the long columns named in ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cache = TermNumbers(index.value.numbers)
        for batch in batches:
            got = [(i, x) for i, t in enumerate(raw_texts(batch)) for x in leaks(t, index.value, cache)]
            at = pa.array([i for i, _ in got], pa.int64())
            yield {
                "doc_id": batch["doc_id"].take(at),
                "item_id": [x.item for _, x in got],
                "start": [x.start for _, x in got],
                "bm25": [x.score for _, x in got],
                "question_overlap": [x.question for _, x in got],
                "answer_overlap": [x.answer for _, x in got],
            } | {c: batch[c].take(at) for c in more}

    schema = f"doc_id long, item_id {kind}, start long, bm25 double, question_overlap double, answer_overlap double"
    return map_batches(docs.select("doc_id", "text", *more), run, ", ".join([schema, *(f"`{c}` long" for c in more)]))


def contaminated(docs: DataFrame, benchmark: DataFrame, *more: str, **limits) -> DataFrame:
    """(doc_id, item_id, start, bm25, question_overlap, answer_overlap): every verified pair of a document and an item."""
    context, kind, parts = docs.sparkSession.sparkContext, dict(benchmark.dtypes)["item_id"], []
    for index in indexes(benchmark, **limits)[1]:
        sent = context.broadcast(index)
        parts.append(materialise(_found(docs, sent, kind, *more), "leaks"))
        sent.destroy()
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def keep_clean(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no verified item."""
    shards, built = indexes(benchmark, **limits)
    if shards > 1:  # the documents are read once a shard and written by none of them
        name = fresh(docs, "row")
        named = docs.withColumn(name, text_hash())
        gone = contaminated(named, benchmark, name, **limits).select("doc_id", name).distinct()
        known = named.where(F.col("doc_id").isNotNull())
        rest = attach(known, gone, ["doc_id", name], "left_anti").select(*docs.columns)
        loose = gone.where(F.col("doc_id").isNull()).select(name)
        return rest.unionByName(attach(named.where(F.col("doc_id").isNull()), loose, [name], "left_anti").select(*docs.columns))
    sent = docs.sparkSession.sparkContext.broadcast(next(built))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TermNumbers(sent.value.numbers)
        for batch in batches:
            yield batch.filter(pa.array([not leaks(t, sent.value, cache) for t in raw_texts(batch)], pa.bool_()))

    return map_batches(docs, run, docs.schema)
