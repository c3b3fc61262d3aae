"""Best-fit packing by linear grouping: tokenised documents into as few sequences as it can.

1. Documents are tokenised where they lie; one longer than a sequence is cut, its first piece taking the
   rest. Only lengths and checksums are kept.
2. A plan is made from the histogram of lengths alone, which has one number for each length whatever the
   corpus. Large lengths, in descending order, are cut into groups of equal cardinality and rounded up to
   the largest of their group. For these few sizes the best mixtures of one sequence
   (configurations) come from a linear program, by column generation. Whole numbers of each
   configuration are laid out and actual documents take the slots of their group, all but the last
   slot of each: as the documents are smaller than the size they were rounded to, the room for it has
   grown. These rooms are filled by best fit in descending order, with the documents left over and the small ones.
   Where lengths are so varied that rounding costs more than configurations gain, best fit in
   descending order over the exact lengths needs fewer sequences; the smaller of both plans is taken.
   Documents of one length are interchangeable, so all of this works on runs of (length, rank) and of
   sequences; the number of runs depends on the sequence length and the number of groups only.
3. Each piece gets its rank among the pieces of its length and looks up its run.

Defined results: a null or empty text is the end token alone; a repeated row is packed as often as it
is there; a row without doc_id is packed like any other; empty tables give no rows.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import attach, map_batches, raw_texts
from pluvia.session import materialise

CAPACITY = 1024
END = 2
#: Lengths above this share of a sequence are large.
LARGE_SHARE = 1 / 8
GROUPS = 64
#: Rows of one length that are ranked together in one task.
RANK_ROWS = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_encoders: dict[str, object] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_added() -> dict[str, int]:
    """The added tokens of the contract's tokenizer and their ids."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def encoder(ranks_path: str):
    """The byte-level BPE of a ranks file; its ids are those of the same vocabulary in ``tokenizers``."""
    if ranks_path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encoders[ranks_path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[ranks_path]


def encode(text: str, bpe, added: dict[str, int]) -> list[int]:
    """The ids of a text. Added tokens are one id each and the parts between them are encoded by themselves, as ``tokenizers`` does."""
    if not any(token in text for token in added):
        return bpe.encode_ordinary(text)
    ids = []
    for part in re.split("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")", text):
        ids += [added[part]] if part in added else bpe.encode_ordinary(part)
    return ids


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``capacity``."""
    first = tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, tokens, capacity)]


def tokenised(docs: DataFrame, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document."""
    path = ranks_path or default_ranks()
    added = {} if ranks_path else default_added()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), raw_texts(batch), strict=True):
                ids = np.array([*encode(text.decode(), bpe, added), END], "<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, i, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), map(list, zip(*rows, strict=True)), strict=True))

    return map_batches(docs.select("doc_id", "text"), run, PIECES)


@dataclass
class Plan:
    """Runs of pieces: those of ``length`` with ranks from ``rank`` go to the sequences from ``sequence``, at ``offset``."""

    capacity: int
    sequences: int = 0
    runs: list[tuple[int, int, int, int]] = field(default_factory=list)  # length, rank, sequence, offset
    free: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # room left -> runs of sequences (first, count)

    def put(self, length: int, rank: int, sequence: int, offset: int) -> None:
        self.runs.append((length, rank, sequence, offset))

    def leave(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            self.free.setdefault(room, []).append((sequence, count))

    def best_fit(self, length: int, rank: int, count: int) -> None:
        """``count`` pieces of one length, each into the least room that takes it, or new sequences."""
        while count:
            room = min((r for r in self.free if r >= length), default=None)
            if room is None:
                new = -(-count // (self.capacity // length))
                self.leave(self.capacity, self.sequences, new)
                self.sequences += new
                continue
            sequence, there = self.free[room].pop()
            if not self.free[room]:
                del self.free[room]
            n = min(count, there)
            self.put(length, rank, sequence, self.capacity - room)
            self.leave(room - length, sequence, n)
            self.leave(room, sequence + n, there - n)
            rank, count = rank + n, count - n


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """(pieces of each size in one sequence, whole number of such sequences) that cover almost all counts.

    The linear program "fewest sequences over all configurations" by column generation: the dual
    prices of the current basis, and an unbounded knapsack for the configuration worth most.
    """
    k = len(sizes)
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    amount = counts / np.diag(basis)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(k))
        worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(sizes.min()), capacity + 1):
            fit = np.flatnonzero(sizes <= c)
            got = worth[c - sizes[fit]] + price[fit]
            j = got.argmax()
            if got[j] > worth[c - 1] + 1e-12:
                worth[c], last[c] = got[j], fit[j]
            else:
                worth[c] = worth[c - 1]
        if worth[capacity] <= 1 + 1e-9:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= sizes[last[c]]
        move = np.linalg.solve(basis, column)
        ratio = np.where(move > 1e-9, amount / np.where(move > 1e-9, move, 1), np.inf)
        out = ratio.argmin()
        step = ratio[out]
        amount = amount - step * move
        amount[out], basis[:, out] = step, column
    return [(basis[:, i].astype(int), int(np.floor(amount[i] + 1e-9))) for i in range(k) if amount[i] >= 1 - 1e-9]


def make_plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan with the fewest sequences for ``histogram[n]`` pieces of length n, n up to ``capacity``."""
    exact = Plan(capacity, int(histogram[capacity]), [(capacity, 0, 0, 0)])
    for length in range(capacity - 1, 0, -1):
        exact.best_fit(length, 0, int(histogram[length]))
    return min(grouped_plan(histogram, capacity, groups), exact, key=lambda plan: plan.sequences)


def grouped_plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Linear grouping of the large lengths, then best fit."""
    plan = Plan(capacity, int(histogram[capacity]), [(capacity, 0, 0, 0)])
    lengths = np.arange(capacity - 1, int(capacity * LARGE_SHARE), -1)
    lengths = lengths[histogram[lengths] > 0]
    ends = np.cumsum(histogram[lengths])  # place of a large piece: all longer ones come first
    starts, total = ends - histogram[lengths], int(ends[-1]) if len(ends) else 0

    def length_at(place: int) -> int:
        return int(lengths[np.searchsorted(ends, place, "right")])

    bounds = np.unique(np.arange(groups + 1) * total // groups)
    at = bounds[:-1].copy() if total else np.zeros(0, int)
    if total:
        sizes = np.array([length_at(b) for b in bounds[:-1]])
        for pattern, count in configurations(sizes, np.diff(bounds), capacity):
            slots, cuts = [], {0, count}
            last = np.flatnonzero(pattern)[-1] if pattern.sum() > 1 else -1
            for g in np.flatnonzero(pattern):
                for _ in range(pattern[g] - (g == last)):
                    n = min(count, int(bounds[g + 1] - at[g]))
                    slots.append((int(at[g]), n))
                    inside = ends[(ends > at[g]) & (ends < at[g] + n)] - at[g]
                    cuts |= {n, *map(int, inside)}
                    at[g] += n
            cuts = sorted(cuts)
            for a, b in zip(cuts, cuts[1:], strict=False):
                offset = 0
                for place, n in slots:
                    if a < n:
                        length = length_at(place + a)
                        plan.put(length, place + a - int(starts[np.searchsorted(ends, place + a, "right")]), plan.sequences + a, offset)
                        offset += length
                plan.leave(capacity - offset, plan.sequences + a, b - a)
            plan.sequences += count
    left = []
    for g in range(len(at)):
        place = int(at[g])
        while place < bounds[g + 1]:
            i = np.searchsorted(ends, place, "right")
            n = int(min(ends[i], bounds[g + 1])) - place
            left.append((int(lengths[i]), place - int(starts[i]), n))
            place += n
    for length, rank, count in sorted(left, reverse=True):
        plan.best_fit(length, rank, count)
    for length in range(int(capacity * LARGE_SHARE), 0, -1):
        plan.best_fit(length, 0, int(histogram[length]))
    return plan


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with a rank from 0 among those of the same length. Rows of one length are ranked in lots, so a
    length that most pieces have is no single task."""
    lots = max(1, -(-pieces.count() // RANK_ROWS))
    dealt = pieces.withColumn("lot", F.col("uid") % lots)
    sizes = dealt.groupBy("length", "lot").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "lot", F.coalesce(before, F.lit(0)).alias("before"))
    within = dealt.withColumn("within", F.row_number().over(Window.partitionBy("length", "lot").orderBy("uid")))
    return attach(within, sizes, ["length", "lot"]).withColumn("rank", F.col("before") + F.col("within") - 1)


def pack(docs: DataFrame, *, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = materialise(tokenised(docs, ranks_path, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row a length
        histogram[row["length"]] = row["count"]
    runs = np.array(sorted(make_plan(histogram, capacity).runs), np.int64).reshape(-1, 4)
    sent = docs.sparkSession.sparkContext.broadcast((runs[:, 0] << 44 | runs[:, 1], runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        keys, runs = sent.value
        for batch in batches:
            length, rank = np.array(batch["length"]), np.array(batch["rank"])
            run = runs[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            yield {c: batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")} | {"sequence_id": run[:, 2] + rank - run[:, 1], "offset": run[:, 3]}

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return map_batches(ranked(pieces).select(*columns), place, f"{PIECES}, sequence_id long, offset long")
