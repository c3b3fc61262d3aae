"""Substring deduplication with fixed-block anchors.

A window of WINDOW words always holds one whole block of BLOCK = WINDOW / 2 words that begins at a multiple of BLOCK. So:

1. index the non-overlapping blocks of every document (a Bloom filter of their hashes);
2. probe it with every rolling block of every document; what it lets through, with the indexed blocks themselves, is
   grouped by hash, and a hash in two or more documents is a repeated anchor (a second filter, of these only);
3. extend: the windows around each occurrence of a repeated anchor are grouped by two hashes (128 bits), and
   the smallest document of each is kept. Neighbouring windows that an earlier document also has make up
   the maximal repeats. A filter can only let too much through, never too little, and the last grouping is
   on the whole hash, so filters change the cost and not the result.

A passage in a third of all documents is combined before every shuffle to one row a task; only its own
occurrences are then met with that one row, in a join that leaves the rows of hot keys where they are. Texts that are there several
times are settled by their smallest doc_id first. Filters have FILTER_BITS bits for each hash up to
FILTER_BYTES, which bounds what is broadcast; with more hashes than that they let more through.

Defined results: a null or empty text has no words; a document shorter than a window loses none; rows
without a doc_id lose none and take none away; rows with the same doc_id never take from each other;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import BROADCAST_BYTES, attach, map_batches, raw_texts, text_hash
from pluvia.llm.rolling import finish, window_hashes, word_hashes
from pluvia.operators.joins import lookup_join
from pluvia.session import materialise

WINDOW = 50
FILTER_BITS = 16
FILTER_BYTES = 128 << 20
PROBES = 3
SEGMENTS = 256

ROW = ["doc_id", "row"]


@dataclass(frozen=True)
class Filter:
    """A Bloom filter cut into segments by the top byte of the hash."""

    bits: np.ndarray  # [SEGMENTS, bytes]

    @staticmethod
    def places(hashes: np.ndarray, size: int, probe: int) -> np.ndarray:
        """The bit of each hash in its segment of ``size`` bytes."""
        return (finish(hashes + np.uint64(probe)) & np.uint64(8 * size - 1)).astype(np.int64)

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may have been put in."""
        at, size = np.arange(len(hashes)), self.bits.shape[1]
        for probe in range(PROBES):
            h = hashes[at]
            bit = self.places(h, size, probe)
            at = at[(self.bits[(h >> np.uint64(56)).astype(np.int64), bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
        return at


def build_filter(hashes: DataFrame) -> Filter:
    """A filter of the column ``h``. Each segment is filled by one task; only the bits, of bounded size, come to the driver."""
    spark, n = hashes.sparkSession, hashes.count()
    size = 64
    while SEGMENTS * size < FILTER_BYTES and SEGMENTS * size * 8 < n * FILTER_BITS:
        size *= 2

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            h = batch["h"].to_numpy().view(np.uint64)
            which = (h >> np.uint64(56)).astype(np.int64)
            for s in np.unique(which):
                own, bits = h[which == s], segments.setdefault(int(s), np.zeros(size, np.uint8))
                for probe in range(PROBES):
                    bit = Filter.places(own, size, probe)
                    np.bitwise_or.at(bits, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        yield {"segment": list(segments), "bits": [b.tobytes() for b in segments.values()]}

    dealt = hashes.select("h", F.shiftrightunsigned("h", 56).alias("segment"))
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "segment").select("h")
    bits = np.zeros((SEGMENTS, size), np.uint8)
    for row in map_batches(dealt, fill, "segment int, bits binary").toLocalIterator():
        bits[row["segment"]] |= np.frombuffer(row["bits"], np.uint8)
    return Filter(bits)


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text, first): ``first`` is the smallest doc_id with this very text, null if it is this one."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_hash().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["row", "check"]
    marked = rows.withColumn("check", F.crc32("text"))
    same = marked.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select(*keys, "least")
    return attach(marked, same, keys).select("doc_id", "row", "text", F.when(F.col("least") < F.col("doc_id"), F.col("least")).alias("first"))


def _indexed(width: int):
    """Hashes of the non-overlapping blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            parts = [window_hashes(word_hashes(t), width // 2)[:: width // 2] for t in raw_texts(batch) if len(t) >= 2 * width - 1]
            yield {"h": np.unique(np.concatenate([np.zeros(0, np.uint64), *parts])).view(np.int64)}

    return run


def _probes(width: int, sent):
    """(h, least, most): the doc_ids of indexed blocks, and of rolling blocks that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            hashes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), raw_texts(batch), strict=True):
                rolling = window_hashes(word_hashes(text), width // 2)
                hit = rolling[sent.value.may_have(rolling)]
                hashes.append(hit)
                ids.append(np.full(len(hit), doc_id, np.int64))
            h, d = np.concatenate(hashes), np.concatenate(ids)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][: len(h)])
            ends = np.r_[starts[1:], len(h)][: len(starts)] - 1
            yield {"h": h[starts].view(np.int64), "least": d[starts], "most": d[ends]}

    return run


def _windows(width: int, sent):
    """(h1, h2, doc_id, row, start) of the windows around repeated anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            parts = []
            for doc_id, row, text in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), raw_texts(batch), strict=True):
                words = word_hashes(text)
                if len(words) < width:
                    continue
                anchors = sent.value.may_have(window_hashes(words, width // 2))
                if not len(anchors):
                    continue
                change = np.zeros(len(words) + 1, np.int64)  # windows from anchor - width / 2 to anchor hold it
                np.add.at(change, np.maximum(anchors - width // 2, 0), 1)
                np.add.at(change, anchors + 1, -1)
                near = np.flatnonzero(np.cumsum(change)[: len(words) - width + 1] > 0)
                parts.append((window_hashes(words, width)[near], window_hashes(words, width, 1)[near], near, doc_id, row))
            if parts:
                n = [len(p[2]) for p in parts]
                yield {
                    "h1": np.concatenate([p[0] for p in parts]).view(np.int64),
                    "h2": np.concatenate([p[1] for p in parts]).view(np.int64),
                    "doc_id": np.repeat(np.array([p[3] for p in parts], np.int64), n),
                    "row": np.repeat(np.array([p[4] for p in parts], np.int64), n),
                    "start": np.concatenate([p[2] for p in parts]).astype(np.int32),
                }

    return run


def joined_spans(starts: np.ndarray, width: int) -> np.ndarray:
    """[n, 2] word ranges covered by windows that begin at ``starts``."""
    starts = np.sort(starts)
    new = np.r_[True, starts[1:] > starts[:-1] + width]
    last = np.r_[np.flatnonzero(new)[1:], len(starts)] - 1
    return np.stack([starts[new], starts[last] + width], axis=1)


def repeats(rows: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(doc_id, row, spans): the maximal repeats to remove, as little-endian 32-bit word ranges, for documents that have any.

    ``rows`` comes from ``_rows``; whole copies are not looked at here.
    """
    own = rows.where("first is null")
    context = rows.sparkSession.sparkContext
    blocks = materialise(map_batches(own.select("text"), _indexed(window), "h long").distinct(), "blocks")
    index = context.broadcast(build_filter(blocks))
    seen = map_batches(own.select("doc_id", "text"), _probes(window, index), "h long, least long, most long")
    anchors = seen.groupBy("h").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least < most").select("h")
    repeated = context.broadcast(build_filter(materialise(anchors, "anchors")))
    windows = map_batches(own.select(*ROW, "text"), _windows(window, repeated), "h1 long, h2 long, doc_id long, row long, start int")
    windows = materialise(windows, "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    first = materialise(first.select("h1", "h2", "least"), "first")
    # A passage that very many documents share is one row of ``first``: its windows stay where they are.
    later = lookup_join(windows, first, ["h1", "h2"], broadcast_bytes=BROADCAST_BYTES).where("least < doc_id")
    grouped = later.groupBy(*ROW).agg(F.collect_list("start").alias("starts"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            spans = [joined_spans(s.values.to_numpy(), window).astype("<i4").tobytes() for s in batch["starts"]]
            yield {"doc_id": batch["doc_id"], "row": batch["row"], "spans": spans}

    return map_batches(grouped, pack, "doc_id long, row long, spans binary")


def with_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, first, spans) of every row of ``docs``; see ``kept_words`` for what they say."""
    rows = _rows(docs)
    found = attach(rows, repeats(rows, window=window), ROW).select("doc_id", "text", "first", "spans")
    return found.unionByName(docs.where(F.col("doc_id").isNull()).select("doc_id", "text"), allowMissingColumns=True)


def kept_words(text: bytes, first: int | None, spans: bytes | None, window: int = WINDOW) -> tuple[list[bytes], int]:
    """The words that stay, and the number of words there were."""
    words = text.split()
    if first is not None:
        return ([] if len(words) >= window else words), len(words)
    if spans is None:
        return words, len(words)
    kept, at = [], 0
    for a, b in np.frombuffer(spans, "<i4").reshape(-1, 2).tolist():
        kept += words[at:a]
        at = b
    return kept + words[at:], len(words)
