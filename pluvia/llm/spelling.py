"""Spelling variants: words at one edit from each other, found by searches in FM-indexes of the vocabulary.

The vocabulary is text: every word with a delimiter at both ends. A search scheme reads one half of a word
exactly, from its delimiter on, and goes on through the other half allowing one inserted, deleted or replaced code point, up to the
other delimiter. With one edit, one half is exact, so two schemes find everything:

    left first    reads the left half, then extends to the right
    right first   reads the right half, then extends to the left

An index extends in one direction. The bidirectional index of a vocabulary is the pair of FM-indexes of its words
and of its reversed words; as either half begins at a delimiter, a search never turns around, so each scheme
needs one of the pair. A state of a search is an interval of suffix ranks; a step takes the intervals of all words of a shard at
once. Suffixes that begin with a delimiter are in the order of the words, so the interval after
the last delimiter is the number of the word found. A word that the right-first scheme finds although its left half is exact as well is left to
the other scheme, so that each pair is counted once.

At scale. Each direction is range-partitioned by the words as that direction reads them, into shards of about SHARD_SYMBOLS symbols, so a
frequent beginning or ending is spread over as many shards as its words fill. The words that begin with a half are consecutive, and a
query goes to the shards which hold them: its own, and rarely a neighbour. A task builds the index of a shard (a few
MB) and streams the queries through it; it returns one row a query with the number of words found and the best of them,
never pairs. The driver holds the first word of each shard.

Defined results: a null text has no words; a null doc_id counts as an empty text before the colon; rows that are there twice count twice. Words
of any length are indexed and searched whole. Empty tables give no rows.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import map_batches
from pluvia.operators.joins import lookup_join
from pluvia.operators.keys import dense_index
from pluvia.session import materialise

# Fixed values of the counting rule: words are runs of these letters, here in UTF-8.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
MODULUS = 97

MIN_POINTS = 5
MIN_COUNT = 3
#: A near word is a form if it is this many times as frequent.
RATIO = 2

SHARD_SYMBOLS = 1 << 18
#: Words searched for at once, and distinct words that a task counts before it sends them on.
QUERIES = 1 << 14
COUNTED = 1 << 19

#: An interval up to this width is extended by the symbols in it, a wider one by the whole alphabet.
NARROW = 16

LEFT, RIGHT = 0, 1


# --- vocabulary --------------------------------------------------------------------------------


def _spoilt(run: bytes, crc: int) -> bytes:
    """``run`` without the code point that its hash chooses."""
    points = run.decode()
    at = crc % len(points)
    return (points[:at] + points[at + 1 :]).encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all runs of letters, A-Z in lower case, one code point taken out where the rule says so."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter[bytes] = Counter()

        def send() -> dict:
            out = {"word": pa.array(list(counts), pa.binary()).cast(pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for run, n in Counter(RUN.findall((text or b"").lower())).items():
                    crc = zlib.crc32(run, start)
                    counts[run if crc % MODULUS else _spoilt(run, crc)] += n
                if len(counts) >= COUNTED:
                    yield send()
        yield send()

    return map_batches(docs.select("doc_id", "text"), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT) -> DataFrame:
    return word_counts(docs).where((F.char_length("word") >= min_points) & (F.col("n") >= min_count))


# --- the index of one shard --------------------------------------------------------------------


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an array of symbols in their order, by doubling the length compared."""
    n = len(symbols)
    rank, step = np.unique(symbols, return_inverse=True)[1].astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class Index:
    """FM-index of words in ascending order, each between delimiters. It extends a match to the left.

    Every delimiter is a symbol of its own when suffixes are sorted, in the order of the words, so suffixes of
    equal spelling are in that order and the sort ends after the longest repeat within words. In the index all delimiters are 0.
    """

    def __init__(self, words: list[str]) -> None:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        points = np.array([ord(c) for w in words for c in f"{w}\0"], np.int64)
        self.alphabet = np.unique(points[points > 0])
        self.size, self.words = len(points), len(words)
        code = np.searchsorted(self.alphabet, points) + 1
        sorting = code + len(words)
        sorting[ends] = np.arange(len(words))
        code[ends] = 0
        order = suffix_order(sorting)
        self.before = code[order - 1]  # the symbol left of each suffix; a word's first suffix has a delimiter there
        # Occurrences of all symbols in one sorted array: a rank is one binary search, and it includes the smaller symbols.
        self.places = np.sort(self.before * (self.size + 1) + np.arange(self.size))

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words as a matrix read from the right, and their lengths; a code point that no word has is -1."""
        size = np.array([len(w) for w in words])
        points = np.array([ord(c) for w in words for c in reversed(w)], np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, points), max(0, len(self.alphabet) - 1))
        known = self.alphabet[at] == points if len(self.alphabet) else np.zeros(len(points), bool)
        return np.where(known, at + 1, -1), size

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals after one more symbol at the left; empty for symbol -1."""
        base = symbol * (self.size + 1)
        low, high = np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)
        return low, np.where(symbol < 0, low, high)


def near_words(index: Index, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, number of the word found) at one edit, whose last ``exact`` code points are those of the query."""
    symbols, size = index.codes(words)
    start = np.cumsum(size) - size
    query = np.arange(len(words))
    low, high = np.zeros(len(words), np.int64), np.full(len(words), index.words, np.int64)  # all suffixes that are a delimiter

    def at(q: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Symbol ``t`` of a query from the right; after its last one, the delimiter."""
        inside = t < size[q]
        return np.where(inside, symbols[np.where(inside, start[q] + t, 0)], 0)

    def advance(state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """One more symbol of the query itself."""
        q, t, lo, hi = state
        lo, hi = index.step(lo, hi, at(q, t))
        alive = lo < hi
        return q[alive], t[alive] + 1, lo[alive], hi[alive]

    def edits(state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """All states after one edit here: another symbol for the query's, one more symbol, or one less."""
        q, t, lo, hi = state
        wide = np.flatnonzero(hi - lo > NARROW)
        thin = np.flatnonzero(hi - lo <= NARROW)
        letters = np.arange(1, len(index.alphabet) + 1)
        width = (hi - lo)[thin]
        row = np.repeat(thin, width)
        place = np.repeat(lo[thin], width) + np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
        pair = np.unique(row * (len(letters) + 1) + index.before[place])
        who = np.r_[np.repeat(wide, len(letters)), pair // (len(letters) + 1)].astype(np.int64)
        what = np.r_[np.tile(letters, len(wide)), pair % (len(letters) + 1)].astype(np.int64)
        who, what = who[what > 0], what[what > 0]
        new_lo, new_hi = index.step(lo[who], hi[who], what)
        alive = new_lo < new_hi
        who, what, new_lo, new_hi = who[alive], what[alive], new_lo[alive], new_hi[alive]
        left = t[who] < size[q[who]]
        replaced = left & (what != at(q[who], t[who]))
        less = t < size[q]
        return (
            np.r_[q[who], q[who][replaced], q[less]],
            np.r_[t[who], t[who][replaced] + 1, t[less] + 1],
            np.r_[new_lo, new_lo[replaced], lo[less]],
            np.r_[new_hi, new_hi[replaced], hi[less]],
        )

    exactly, edited = (query, np.zeros(len(words), np.int64), low, high), tuple(np.zeros(0, np.int64) for _ in range(4))
    found = [np.zeros((2, 0), np.int64)]
    for step in range(int(size.max(initial=0)) + 2):
        # A state with an edit is at most one symbol behind or ahead of ``step``; each takes one symbol of its query a round.
        done = edited[1] > size[edited[0]]
        found.append(np.stack([edited[0][done], edited[2][done]]))
        moved = advance(tuple(c[~done] for c in edited))
        open_ = exact[exactly[0]] <= step
        here = edits(tuple(c[open_] for c in exactly))
        edited = tuple(np.concatenate(c) for c in zip(moved, here, strict=True))
        inside = exactly[1] < size[exactly[0]]
        exactly = advance(tuple(c[inside] for c in exactly))
    while len(edited[0]):
        done = edited[1] > size[edited[0]]
        found.append(np.stack([edited[0][done], edited[2][done]]))
        edited = advance(tuple(c[~done] for c in edited))
    q, number = np.concatenate(found, axis=1)
    pair = np.unique(q * max(1, index.words) + number)
    return pair // max(1, index.words), pair % max(1, index.words)


# --- shards ------------------------------------------------------------------------------------


def halves(word: str) -> tuple[str, str]:
    return word[: len(word) // 2], word[len(word) // 2 :]


def _reads(word: str, way: int) -> str:
    """The word as the scheme reads it: from the end of its exact half."""
    return word if way == LEFT else word[::-1]


def _placed(words: DataFrame, way: int, shard_symbols: int) -> tuple[DataFrame, list[str]]:
    """(key, word, n, shard) and the first key of each shard: words in the order of ``way``, cut by their symbols."""
    key = F.col("word") if way == LEFT else F.reverse("word")
    rows = dense_index(words.withColumn("key", key), ["key"], "place")
    symbols = rows.agg(F.sum(F.char_length("word") + 1).alias("s"), F.count("*").alias("n")).first()
    per_shard = max(1, int(shard_symbols * (symbols["n"] or 0) / max(1, symbols["s"] or 0)))
    rows = materialise(rows.withColumn("shard", F.expr(f"cast(place div {per_shard} as int)")).select("key", "word", "n", "shard"), "shards")
    first = rows.groupBy("shard").agg(F.min("key").alias("key")).orderBy("shard").collect()
    return rows, [r["key"] for r in first]


def _order(text: str) -> bytes:
    """Spark's order of strings is that of their UTF-8 bytes, which is that of code points."""
    return text.encode()


SHARED = "way int, shard int, query boolean, key string, word string, n long"
FOUND = "word string, n long, n_near long, best_n long, best string"


def _routed(rows: DataFrame, way: int, first: list[str]) -> DataFrame:
    """Each word once for the index of its shard, and as a query to every shard that can hold words with its half."""
    bounds = [_order(k) for k in first]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out = []
            for key, word, n, shard in zip(*(batch[c].to_pylist() for c in ("key", "word", "n", "shard")), strict=True):
                out.append((way, shard, False, key, word, n))
                half = _order(_reads(halves(word)[way], way))
                low = max(0, bisect.bisect_right(bounds, half) - 1)
                high = bisect.bisect_right(bounds, half + b"\xff")
                out.extend((way, s, True, key, word, n) for s in range(low, high))
            yield dict(zip(("way", "shard", "query", "key", "word", "n"), map(list, zip(*out, strict=True)), strict=True)) if out else _nothing()

    def _nothing() -> dict:
        return dict.fromkeys(("way", "shard", "query", "key", "word", "n"), [])

    return map_batches(rows, route, SHARED)


def _search_shards(routed: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best): what each query finds in one shard."""

    def search(index: Index, shown: list[str], counts: np.ndarray, way: int, queries: list[tuple[str, str, int]]) -> dict:
        # The index extends to the left, so words are turned to have their exact half at the right.
        half = np.array([len(halves(word)[way]) for _, word, _ in queries])
        q, number = near_words(index, [key[::-1] for key, _, _ in queries], half)
        if way == RIGHT:
            lefts = [halves(word)[LEFT] for _, word, _ in queries]
            own = np.array([not shown[w].startswith(lefts[i]) for i, w in zip(q.tolist(), number.tolist(), strict=True)], bool)
            q, number = q[own], number[own]
        n = counts[number]
        rank = np.array(sorted(range(len(shown)), key=shown.__getitem__), np.int64)
        place = np.empty(len(shown), np.int64)
        place[rank] = np.arange(len(shown))
        order = np.lexsort((place[number], -n, q))
        q, number, n = q[order], number[order], n[order]
        one, start, size = np.unique(q, return_index=True, return_counts=True)
        return {
            "word": [queries[i][1] for i in one],
            "n": [queries[i][2] for i in one],
            "n_near": size.astype(np.int64),
            "best_n": n[start],
            "best": [shown[w] for w in number[start]],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        here, index, words, queries = None, None, [], []

        def flush() -> Iterator[dict]:
            nonlocal index, queries
            if queries and words:
                if index is None:
                    index = (Index([key[::-1] for key, _, _ in words]), [w for _, w, _ in words], np.array([n for _, _, n in words], np.int64))
                yield search(*index, here[0], queries)
            queries = []

        for batch in batches:
            for way, shard, query, key, word, n in zip(*(batch[c].to_pylist() for c in ("way", "shard", "query", "key", "word", "n")), strict=True):
                if (way, shard) != here:
                    yield from flush()
                    here, index, words, queries = (way, shard), None, [], []
                (queries if query else words).append((key, word, n))
                if len(queries) >= QUERIES:
                    yield from flush()
        yield from flush()

    sorted_ = routed.repartition("way", "shard").sortWithinPartitions("way", "shard", "query", F.reverse("key"))
    return map_batches(sorted_, run, FOUND)


def near(words: DataFrame, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, n, n_near, best_n, best) for each word with a near one: how many there are, and the most frequent (ties: the
    smallest in code-point order)."""
    sides = [_routed(*((placed := _placed(words, way, shard_symbols))[0], way, placed[1])) for way in (LEFT, RIGHT)]
    found = _search_shards(sides[0].unionByName(sides[1]))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("first")
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best")
    )


def variants(docs: DataFrame, *, min_points: int = MIN_POINTS, min_count: int = MIN_COUNT, ratio: int = RATIO, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = materialise(vocabulary(docs, min_points, min_count), "words")
    found = near(words, shard_symbols)
    formed = F.col("best_n") >= ratio * F.col("n")
    found = materialise(
        found.select("word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "near"
    )
    rooted = lookup_join(found, roots(found), ["word"], "left")
    alone = words.join(found.select("word"), "word", "left_anti").select("word", "n", F.lit(0).cast("long").alias("n_near"))
    return rooted.unionByName(alone, allowMissingColumns=True).select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of every word with a form. Each round doubles the links followed; a form is at least twice as frequent as its
    word, so a chain has fewer links than a count has bits and the rounds are few."""
    links = materialise(found.where("form is not null").select("word", F.col("form").alias("root")), "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = lookup_join(links, onward, ["root"], "left")
        links = materialise(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")
