"""Language-model scoring of whole documents with a gated recurrent network.

1. Words are counted over all training documents, by Spark.
2. The network's vocabulary is a shortlist of the most frequent words, one token for the end of a document and one
   for each tail class; a tail class is the shape of a word (length, last letter a mark, any letter that is not
   ASCII). So the vocabulary of the network is bounded, and that of the counts is not.
3. Texts are tokenised once more, into the network's tokens, which are stored. Training goes over all training documents in
   ROUNDS, each with its share of them, dealt by hash into shards of about SHARD_TOKENS. On each shard a
   copy of the last model is trained by truncated backpropagation; the copies are averaged, weighted by
   their tokens, and start the next round. Shards and the order within them go by hashes of the documents, so
   a score does not depend on how the input is split into files or partitions.
4. Every document is scored from its first word to its end, with the state carried across windows. A tail word
   adds log P(word | tail class), from the counts: (c + 1) / (class tokens + class words + 1).

Words that are a HOT_SHARE of all tokens or more are looked up in a broadcast table, whose size that share
bounds. The rest, each once a document, are joined with their counts by a shuffle. A shard, like the network, is of one size at every
size of input; there are more of them with more documents. Rows that are equal in everything are in one shard.

Defined results: a null or empty text is its end token alone; rows without doc_id are scored, and their
remainder is that of an empty text; a repeated row counts as often as it is there; without training documents all counts are 0 and the
network is untrained; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import attach, bucket, lower_words, map_batches, raw_texts
from pluvia.llm.gru import CLASS_WORDS, Adam, Gru, Params, flatten, initial, unflatten
from pluvia.session import materialise

FOLDS, HELD_OUT = 7, 2
SHORTLIST = 1024
HOT_SHARE = 1 / 524_288
TAILS = 12
#: Sixteenths of the training documents that each round of training goes over.
ROUNDS = (range(0, 1), range(1, 4), range(4, 16))
SHARD_TOKENS = 1 << 22
POOL_TOKENS = 1 << 20
#: Trained copies that one task or the driver adds up.
FAN_IN = 32
COUNTED_WORDS = 300_000


def held_out() -> Column:
    return bucket("doc_id", FOLDS) == HELD_OUT


def tail_class(word: bytes) -> int:
    """The shape of a word, from 0 to TAILS - 1."""
    length = 0 if len(word) < 5 else 1 if len(word) < 10 else 2
    return 4 * length + 2 * (not word.isascii()) + (not word[-1:].isalnum() and word[-1] < 128)


def tail_class_column(word: str) -> Column:
    """``tail_class`` of a column of words."""
    w = F.col(word)
    length = F.when(F.octet_length(w) < 5, 0).when(F.octet_length(w) < 10, 1).otherwise(2)
    return 4 * length + 2 * (F.octet_length(w) != F.char_length(w)).cast("int") + w.rlike(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]\z").cast("int")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the texts of ``docs``; each task adds up its words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in raw_texts(batch):
                seen.update(lower_words(text))
            if len(seen) > COUNTED_WORDS:
                yield {"word": [w.decode() for w in seen], "n": list(seen.values())}
                seen.clear()
        yield {"word": [w.decode() for w in seen], "n": list(seen.values())}

    return map_batches(docs.select("text"), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Codes(dict):
    """Word -> its place in the hot table, or minus one more than its tail class. Remembers a bounded number of tail words."""

    def __init__(self, hot: dict[bytes, int]) -> None:
        super().__init__(hot)
        self.hot, self.limit = hot, len(hot) + 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
            self.update(self.hot)
            if word in self.hot:
                return self.hot[word]
        code = self[word] = -1 - tail_class(word)
        return code


class Vocabulary:
    """What tasks need to know of words: the hot ones with log10(count + 1) and token, and the number of shortlist words."""

    def __init__(self, hot: list[tuple[str, int]]) -> None:
        self.words = min(SHORTLIST, len(hot)) // CLASS_WORDS * CLASS_WORDS
        self.codes = {w.encode(): i for i, (w, _) in enumerate(hot)}
        counts = np.array([n for _, n in hot], float)
        self.logs = np.log10(counts + 1)
        tails = np.array([self.words + 1 + tail_class(w.encode()) for w, _ in hot], np.int64)
        self.token = np.where(np.arange(len(hot)) < self.words, np.arange(len(hot)), tails)
        self.in_tail = self.token > self.words

    def tokens(self, codes: np.ndarray) -> np.ndarray:
        """Network tokens of words given by their codes."""
        if not len(self.token):
            return self.words - codes
        return np.where(codes >= 0, self.token[np.maximum(codes, 0)], self.words - codes)


CODED = (
    "uid long, doc_id long, learnt boolean, mark long, n_tokens long, n_hot long, base double, inside double, "
    "ids binary, tails array<struct<word string, n long>>"
)


def tokenise(rows: DataFrame, vocabulary: Vocabulary, class_log: np.ndarray, end_log: float) -> DataFrame:
    """What training and scoring need of every row (uid, doc_id, learnt, mark, text), stored once: the network's tokens, the sums over
    the words that are hot, and the words that are not with their number."""
    context = rows.sparkSession.sparkContext
    known, logs = context.broadcast(vocabulary), context.broadcast(class_log)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        voc, lookup = known.value, _Codes(known.value.codes)
        for batch in batches:
            n_tokens, n_hot, base, inside, ids, tails = [], [], [], [], [], []
            for text in raw_texts(batch):
                words = lower_words(text)
                codes = np.fromiter(map(lookup.__getitem__, words), np.int64, len(words))
                hot = codes[codes >= 0]
                tokens = voc.tokens(codes)
                value = voc.logs[hot]
                n_tokens.append(len(words) + 1)
                n_hot.append(len(hot) + 1)
                base.append(float(value.sum()) + end_log)
                inside.append(float((value * voc.in_tail[hot]).sum() - logs.value[tokens].sum()))
                ids.append(np.append(tokens, voc.words).astype("<u2").tobytes())
                tails.append(Counter(map(words.__getitem__, np.flatnonzero(codes < 0).tolist())))
            words_of = pa.array([w for t in tails for w in t], pa.binary()).cast(pa.string())
            times_of = pa.array([c for t in tails for c in t.values()], pa.int64())
            pairs = pa.StructArray.from_arrays([words_of, times_of], ["word", "n"])
            ends_of = pa.array(np.cumsum([0, *map(len, tails)]), pa.int32())
            same = {c: batch[c] for c in ("uid", "doc_id", "learnt", "mark")}
            yield same | {
                "n_tokens": n_tokens, "n_hot": n_hot, "base": base, "inside": inside, "ids": pa.array(ids, pa.binary()),
                "tails": pa.ListArray.from_arrays(ends_of, pairs),
            }

    return map_batches(rows, run, CODED)


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all documents, where each begins)."""
    flat = np.frombuffer(b"".join(ids), "<u2").astype(np.int64)
    return flat, np.cumsum([0, *[len(i) // 2 for i in ids]])[:-1]


def _added(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray | None]:
    """Tokens, and the sum of weights times tokens."""
    tokens, total = 0, None
    for batch in batches:
        for n, w in zip(batch["tokens"].to_pylist(), batch["weights"].to_pylist(), strict=True):
            tokens += n
            total = np.frombuffer(w) if total is None else total + np.frombuffer(w)
    return tokens, total


def train(coded: DataFrame, vocabulary: Vocabulary, counts: np.ndarray, tokens: int) -> Params:
    """Average the models that are trained on the shards, round by round. ``tokens`` is the size of all training documents."""
    words, spark = vocabulary.words, coded.sparkSession
    params = initial(counts, words, TAILS)
    for i, part in enumerate(ROUNDS):
        sent = spark.sparkContext.broadcast(flatten(params))
        shards = max(1, round(tokens * len(part) / 16 / SHARD_TOKENS))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, rate=0.01 / (i + 1)) -> Iterator[dict]:
            shard, model, optimiser, pool, size, seen = None, None, None, [], 0, 0

            def flush() -> None:
                nonlocal pool, size
                if pool:
                    model.train(*_joined(pool), optimiser)
                pool, size = [], 0

            def done() -> Iterator[dict]:
                flush()
                if seen:
                    yield {"tokens": [seen], "weights": [(flatten(model.p).astype(float) * seen).tobytes()]}

            for batch in batches:
                for own, ids in zip(batch["shard"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                    if own != shard:
                        yield from done()
                        shard, model, optimiser, seen = own, Gru(unflatten(sent.value, words, TAILS)), Adam(rate), 0
                    pool.append(ids)
                    size += len(ids) // 2
                    seen += len(ids) // 2
                    if size >= POOL_TOKENS:
                        flush()
            yield from done()

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            n, total = _added(batches)
            if n:
                yield {"tokens": [n], "weights": [total.tobytes()]}

        turn = F.pmod("mark", F.lit(16)).between(part.start, part.stop - 1)
        own = coded.where(F.col("learnt") & turn).select(F.pmod(F.shiftrightunsigned("mark", 8), F.lit(shards)).alias("shard"), "mark", "ids")
        dealt = own.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "mark").select("shard", "ids")
        copies = map_batches(dealt, learn, "tokens long, weights binary")
        left = shards
        while left > FAN_IN:
            left = math.ceil(math.sqrt(left))
            copies = map_batches(copies.repartition(left), merge, "tokens long, weights binary")
        seen, total = _added(copies.toArrow().to_batches())
        if seen:
            params = unflatten(total / seen, words, TAILS)
    return params


def net_scores(coded: DataFrame, params: Params) -> DataFrame:
    """``coded`` without tokens and tails, with ``net``: the log10 probability of the network's tokens."""
    sent = coded.sparkSession.sparkContext.broadcast(params)
    names = ["uid", "doc_id", "n_tokens", "n_hot", "base", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model, held, size = Gru(sent.value), [], 0

        def flush() -> Iterator[dict]:
            nonlocal held, size
            if held:
                table = pa.Table.from_batches(held)
                net = model.score(*_joined(table["ids"].to_pylist())) / np.log(10)
                yield {c: table[c].combine_chunks() for c in names} | {"net": net}
            held, size = [], 0

        for batch in batches:
            held.append(batch)
            size += pc.sum(batch["n_tokens"]).as_py() or 0
            if size >= POOL_TOKENS:
                yield from flush()
        yield from flush()

    schema = "uid long, doc_id long, n_tokens long, n_hot long, base double, inside double, net double"
    return map_batches(coded.select(*names, "ids"), run, schema)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    mark = F.xxhash64("doc_id", F.xxhash64("text"))
    rows = docs.select("doc_id", "text").withColumns({"uid": F.monotonically_increasing_id(), "learnt": ~held_out(), "mark": mark})
    training = rows.where("learnt")
    counts = materialise(word_counts(training), "counts")
    by_class = {r["k"]: r for r in counts.groupBy(tail_class_column("word").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    ends = training.count()
    n = sum(r["n"] for r in by_class.values()) + ends
    v = sum(r["words"] for r in by_class.values()) + (ends > 0)
    least = max(1, int(n * HOT_SHARE))
    hot = counts.where(F.col("n") >= least).toArrow()  # at most 1 / HOT_SHARE words
    hot = sorted(zip(hot["word"].to_pylist(), hot["n"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    vocabulary = Vocabulary(hot)
    words = vocabulary.words

    tail_tokens = np.array([by_class[k]["n"] if k in by_class else 0 for k in range(TAILS)], float)
    tail_words = np.array([by_class[k]["words"] if k in by_class else 0 for k in range(TAILS)], float)
    for w, c in hot[:words]:
        k = tail_class(w.encode())
        tail_tokens[k] -= c
        tail_words[k] -= 1
    start = np.r_[[c for _, c in hot[:words]], ends, tail_tokens]
    end_log, per_token = float(np.log10(ends + 1)), float(np.log10(n + v + 1))
    class_log = np.r_[np.zeros(words + 1), np.log10(tail_tokens + tail_words + 1)]
    coded = materialise(tokenise(rows, vocabulary, class_log, end_log), "tokens")
    params = train(coded, vocabulary, start, n)
    parts = materialise(net_scores(coded, params), "scored")

    cold = counts.where(F.col("n") < least)
    rare = coded.select("uid", F.explode("tails").alias("t")).select("uid", "t.word", F.col("t.n").alias("times"))
    found = rare.join(cold, "word").groupBy("uid").agg(F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    whole = attach(parts, found, ["uid"])
    logs_of_rare, times = F.coalesce("logs", F.lit(0.0)), F.coalesce("times", F.lit(0))
    return whole.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_hot") + times - (0 if ends else 1)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + logs_of_rare - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("net") + F.col("inside") + logs_of_rare).alias("score"),
    )
