"""Line deduplication over range-partitioned line hashes.

Every line that is long enough becomes a row (128-bit hash of its key, doc_id, row, position). The rows
are range-partitioned and sorted by (hash, doc_id descending, position), and each partition is
streamed once: the first document of a hash is the one that keeps the line. The range bounds hold the
doc_id too, so a line found in a third of all documents is spread over many partitions; what the edge
of a partition cannot know by itself (how many documents came before, and which was the largest) is
settled by one summary row for each edge. The result is a compressed bitmap of the lines to keep, for
each document that loses lines; no text is shuffled to find it.

Defined results: a null or empty text is one empty line; rows without a doc_id keep all their lines
and are not counted; rows with the same doc_id count as one document; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import attach, fresh, map_batches, raw_texts, text_hash
from pluvia.session import materialise

MIN_CHARS = 40
MIN_DOCS = 5

LINE = "h1 long, h2 long, doc_id long, row long, line long"
FOUND = "h1 long, h2 long, doc_id long, row long, line long, kind int, docs long"
DROPPED, EDGE, SUMMARY = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z in lower case."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each line with a key of at least ``min_chars`` code points."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            digests, ids, rows, at = [], [], [], []
            for doc_id, row, text in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), raw_texts(batch), strict=True):
                for i, line in enumerate(text.split(b"\n")):
                    if _long_enough(key := line_key(line), min_chars):
                        digests.append(xxhash.xxh128_digest(key))
                        ids.append(doc_id)
                        rows.append(row)
                        at.append(i)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield {"h1": halves[:, 0].copy(), "h2": halves[:, 1].copy(), "doc_id": ids, "row": rows, "line": at}

    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_hash().alias("row"), "text")
    return map_batches(rows, emit, LINE)


Rows = tuple[np.ndarray, ...]


def _columns(rows: Rows, kind: int, docs: int = 0) -> dict:
    n = len(rows[0])
    return dict(zip(("h1", "h2", "doc_id", "row", "line"), rows, strict=True)) | {"kind": np.full(n, kind, np.int32), "docs": np.full(n, docs, np.int64)}


class _Run:
    """The hash whose rows are being read: its documents so far, and the rows that wait for more of them."""

    def __init__(self, key: tuple[int, int], edge: bool, min_docs: int) -> None:
        self.key, self.edge, self.min_docs = key, edge, min_docs
        self.top = self.doc = None
        self.docs, self.waiting = 0, []

    def extend(self, rows: Rows) -> Iterator[dict]:
        doc = rows[2]
        rank = self.docs + np.cumsum(np.r_[self.doc is None or doc[0] != self.doc, doc[1:] != doc[:-1]])
        self.top = doc[0] if self.top is None else self.top
        self.doc, self.docs = doc[-1], int(rank[-1])
        if self.edge:  # the partition before may hold larger documents
            yield _columns(rows, EDGE)
            return
        self.waiting.append(tuple(c[rank >= 2] for c in rows))
        if self.docs >= self.min_docs:
            yield from self._flush(DROPPED)

    def close(self, end: bool) -> Iterator[dict]:
        """``end``: the partition ends here, so the run may go on in the next one."""
        if self.edge or end:
            one = [np.array([x], np.int64) for x in (*self.key, self.top, 0, -1)]
            yield _columns(tuple(one), SUMMARY, self.docs)
        if end:
            yield from self._flush(EDGE)

    def _flush(self, kind: int) -> Iterator[dict]:
        if self.waiting:
            yield _columns(tuple(np.concatenate(c) for c in zip(*self.waiting, strict=True)), kind)
        self.waiting = []


def stream_first_occurrences(min_docs: int = MIN_DOCS):
    """A map over one sorted partition that yields the rows to drop, and what its two edges leave open."""

    def whole_runs(rows: Rows, starts: np.ndarray) -> Iterator[dict]:
        """Runs that begin and end in this batch."""
        doc, n = rows[2], len(rows[0])
        new_doc = np.r_[True, doc[1:] != doc[:-1]]
        new_doc[starts] = True
        seen, run = np.cumsum(new_doc), np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
        rank = seen - seen[starts][run] + 1  # 1 for the largest doc_id
        drop = (rank >= 2) & (rank[np.r_[starts[1:], n] - 1][run] >= min_docs)
        if drop.any():
            yield _columns(tuple(c[drop] for c in rows), DROPPED)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        run = None
        for batch in batches:
            rows = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            n = batch.num_rows
            if n == 0:
                continue
            cut = np.r_[0, np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1, n]
            part = lambda i, j, rows=rows, cut=cut: tuple(c[cut[i] : cut[j]] for c in rows)
            at, last = 0, len(cut) - 2  # runs of this batch are numbered from 0 to last
            first = (int(rows[0][0]), int(rows[1][0]))
            if run is None or run.key == first:
                run = run or _Run(first, True, min_docs)
                yield from run.extend(part(0, 1))
                at = 1
            if at > last:
                continue
            yield from run.close(end=False)
            if at < last:
                yield from whole_runs(part(at, last), cut[at:last] - cut[at])
            run = _Run((int(rows[0][-1]), int(rows[1][-1])), False, min_docs)
            yield from run.extend(part(last, last + 1))
        if run is not None:
            yield from run.close(end=True)

    return read


def repeated_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, line) of every line to drop."""
    lines = materialise(line_hashes(docs, min_chars), "lines")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartitionByRange(partitions, *order).sortWithinPartitions(*order, "line")
    found = materialise(map_batches(dealt, stream_first_occurrences(min_docs), FOUND), "found")

    edges = (
        found.where(F.col("kind") == SUMMARY)
        .groupBy("h1", "h2")
        .agg(F.sum("docs").alias("n"), F.max("doc_id").alias("top"))
        .where(F.col("n") >= min_docs)
    )
    # At most two edges a partition, so this side is bounded by the number of partitions.
    settled = (
        found.where(F.col("kind") == EDGE)
        .join(F.broadcast(edges), ["h1", "h2"])
        .where(F.col("doc_id") < F.col("top"))
    )
    keys = ["doc_id", "row", "line"]
    return found.where(F.col("kind") == DROPPED).select(*keys).unionByName(settled.select(*keys))


def pack_bitmap(kept: np.ndarray) -> bytes:
    """zlib of one bit a line, set where the line stays; lines after the last dropped one are left out and stay."""
    return zlib.compress(np.packbits(kept).tobytes(), 1)


def unpack_bitmap(packed: bytes | None, lines: int) -> np.ndarray:
    kept = np.ones(lines, bool)
    if packed is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).astype(bool)[:lines]
        kept[: len(bits)] = bits
    return kept


def keep_bitmaps(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, row, n_dropped, bitmap) of the documents that lose lines."""
    grouped = repeated_lines(docs, **limits).groupBy("doc_id", "row").agg(F.collect_set("line").alias("lines"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            maps, counts = [], []
            for lines in batch["lines"]:
                dropped = lines.values.to_numpy(zero_copy_only=False)
                kept = np.ones(-(-(int(dropped.max()) + 1) // 8) * 8, bool)
                kept[dropped] = False
                maps.append(pack_bitmap(kept))
                counts.append(len(dropped))
            yield {"doc_id": batch["doc_id"], "row": batch["row"], "n_dropped": counts, "bitmap": maps}

    return map_batches(grouped, pack, "doc_id long, row long, n_dropped long, bitmap binary")


def with_bitmaps(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, text, bitmap): every row of ``docs`` beside its bitmap, null where nothing is dropped."""
    rows = docs.select("doc_id", "text", text_hash().alias("row"))
    return attach(rows, keep_bitmaps(docs, **limits), ["doc_id", "row"]).select("doc_id", "text", "bitmap")


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The text without its dropped lines, the lines it had, and the lines dropped."""
    lines = text.split(b"\n")
    if bitmap is None:
        return text, len(lines), 0
    kept = unpack_bitmap(bitmap, len(lines))
    return b"\n".join(line for line, stays in zip(lines, kept, strict=True) if stays), len(lines), int((~kept).sum())


def without_repeated_lines(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs``, all columns, with their dropped lines gone from ``text``; ``n_chars``, if there, follows."""
    columns, row, bitmap = docs.columns, fresh(docs, "row"), fresh(docs, "bitmap")
    maps = keep_bitmaps(docs, **limits).select("doc_id", F.col("row").alias(row), F.col("bitmap").alias(bitmap))
    rows = attach(docs.withColumn(row, text_hash()), maps, ["doc_id", row]).select(*columns, bitmap)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [kept_text(t, b)[0].decode() if b is not None else None for t, b in zip(raw_texts(batch), batch[bitmap].to_pylist(), strict=True)]
            changed = pa.array([t is not None for t in texts], pa.bool_())
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) if t is not None else None for t in texts], pa.int64())}
            yield {c: pc.if_else(changed, new[c].cast(batch[c].type), batch[c]) if c in new else batch[c] for c in columns}

    return map_batches(rows, apply, docs.schema)
