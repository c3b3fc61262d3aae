"""SimHash near-duplicates by a binary trie self-join.

Every document has a 64-bit fingerprint. Equal fingerprints are one trie leaf, so copies never meet in
pairs. The self-join walks pairs of trie nodes of the same depth: a pair splits into the pairs of its
children, those with different bits cost one from the error budget, and a pair is dropped once the
budget is exceeded. A trie node is a range of sorted fingerprints, so a whole front of node pairs is
split at once with numpy.

The walk is spread over Spark tasks by its own first levels. With ERRORS = 3 differing bits and four blocks of
bits, two linked fingerprints agree on one block at least; so each fingerprint goes into four tries, each with
another block first, and a node below that block is a task by itself. (Five blocks of which two agree,
or six of which three, take over when there are so many fingerprints that these nodes would grow; the links
found are the same.) A task that still has more than TASK_ROWS fingerprints is split by Spark in the same way,
bit by bit, into pairs of child nodes, however many share a prefix. Tasks return not their pairs but a spanning
forest of them, which has fewer rows than fingerprints; components are then joined across tasks.

Defined results: a text without words (also null or empty) has fingerprint zero and is linked like any other; a
row without doc_id has a fingerprint but never names a component; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import SEED, attach, fresh, lower_words, map_batches, raw_texts, text_hash
from pluvia.llm.components import components
from pluvia.session import materialise

ERRORS = 3
WIDTH = 3
TASK_ROWS = 2_000
#: Fingerprints walked at once in a Python worker.
CHUNK_ROWS = 20_000

TASK = ["band", "key", "path"]


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """SimHash of the word shingles of a text, as an unsigned number."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = min(width, len(words)) - 1
    hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):  # a very long text is counted in parts
        part = np.array(hashes[i : i + 65_536], "<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes)).view("<u8")[0])


def fingerprints(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, fp) of every row, and the long columns named in ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in raw_texts(batch)], np.uint64)
            yield {"doc_id": batch["doc_id"], "fp": fps.view(np.int64)} | {c: batch[c] for c in more}

    return map_batches(docs.select("doc_id", "text", *more), run, ", ".join(["doc_id long, fp long", *(f"`{c}` long" for c in more)]))


def blocks(rows: int) -> tuple[int, int]:
    """(blocks, blocks that agree) that keep nodes below the agreeing bits small on average."""
    return (4, 1) if rows <= 1 << 22 else (5, 2) if rows <= 1 << 32 else (6, 3)


def _block_bits(n: int) -> list[tuple[int, int]]:
    """(shift, width) of n blocks that make up 64 bits."""
    at = [64 * i // n for i in range(n + 1)]
    return [(64 - b, b - a) for a, b in zip(at, at[1:], strict=False)]


def _reordered(order: list[tuple[int, int]]) -> Column:
    """The fingerprint with its blocks in another order, the first one in the highest bits."""
    parts, left = [], 64
    for shift, width in order:
        left -= width
        parts.append(F.shiftleft(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long")), left))
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def routed(fps: DataFrame, rows: int) -> DataFrame:
    """Each fingerprint once for each trie: (band, key, path, depth, errors, side, p, fp)."""
    n, equal = blocks(rows)
    every = _block_bits(n)
    tries = []
    for band, chosen in enumerate(combinations(range(n), equal)):
        order = [every[i] for i in chosen] + [every[i] for i in range(n) if i not in chosen]
        depth = sum(every[i][1] for i in chosen)
        tries.append(F.struct(F.lit(band).alias("band"), F.lit(depth).alias("depth"), _reordered(order).alias("p")))
    flat = fps.select("fp", F.explode(F.array(*tries)).alias("t")).select("fp", "t.band", "t.depth", "t.p")
    key = F.expr("shiftrightunsigned(p, 64 - depth)")
    return flat.select("band", key.alias("key"), F.lit("").alias("path"), "depth", F.lit(0).alias("errors"), F.lit(-1).alias("side"), "p", "fp")


def split_once(rows: DataFrame) -> DataFrame:
    """Members of node pairs as members of the pairs of their children. Side -1 is a node paired with itself."""
    bit = F.expr("cast(shiftrightunsigned(p, 63 - depth) & 1 as int)")
    child = lambda step, errors, side: F.struct(F.concat("path", step).alias("path"), errors.alias("errors"), side.alias("side"))
    digit, other = bit.cast("string"), (1 - bit).cast("string")
    same = child(F.when(F.col("side") < 0, F.concat(F.lit("s"), digit)).otherwise(F.concat(digit, digit)), F.col("errors"), F.col("side"))
    crossed = child(
        F.when(F.col("side") < 0, F.lit("x")).when(F.col("side") == 0, F.concat(digit, other)).otherwise(F.concat(other, digit)),
        F.col("errors") + 1,
        F.when(F.col("side") < 0, bit).otherwise(F.col("side")),
    )
    next_ = F.explode(F.when(F.col("errors") < ERRORS, F.array(same, crossed)).otherwise(F.array(same)))
    return rows.select("band", "key", (F.col("depth") + 1).alias("depth"), "p", "fp", next_.alias("c")).select(
        "band", "key", "c.path", "depth", "c.errors", "c.side", "p", "fp"
    )


def _front_to_pairs(p: np.ndarray, front: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walk node pairs down to linked leaves. Columns of ``front``: the range of the one node, of the other, errors, depth;
    equal ranges are a node paired with itself. ``p`` is sorted within every node."""
    bits = ((p[None, :] >> np.arange(63, -1, -1, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.int32)
    ones = np.zeros((64, len(p) + 1), np.int32)
    np.cumsum(bits, axis=1, out=ones[:, 1:])
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(front):
        a0, a1, b0, b1, errors, depth = front.T
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():  # two leaves: the bits that are left are counted at once
            i, j = a0[single], b0[single]
            near = (i != j) & (np.bitwise_count(p[i] ^ p[j]) <= ERRORS)
            left.append(i[near])
            right.append(j[near])
            front = front[~single]
            if not len(front):
                break
            a0, a1, b0, b1, errors, depth = front.T
        at = a1 - (ones[depth, a1] - ones[depth, a0])
        bt = b1 - (ones[depth, b1] - ones[depth, b0])
        own = (a0 == b0) & (a1 == b1)
        pair = ~own
        make = lambda keep, lo, hi, lo2, hi2, more: np.stack([lo, hi, lo2, hi2, errors + more, depth + 1], axis=1)[keep]
        front = np.concatenate(
            [make(own, a0, at, a0, at, 0), make(own, at, a1, at, a1, 0), make(own, a0, at, at, a1, 1)]
            + [make(pair, a0, at, b0, bt, 0), make(pair, at, a1, bt, b1, 0), make(pair, a0, at, bt, b1, 1), make(pair, at, a1, b0, bt, 1)]
        )
        alone = (front[:, 0] == front[:, 2]) & (front[:, 1] - front[:, 0] < 2)
        front = front[(front[:, 0] < front[:, 1]) & (front[:, 2] < front[:, 3]) & ~alone & (front[:, 4] <= ERRORS)]
    return np.concatenate(left), np.concatenate(right)


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows sorted by task, a task never larger than TASK_ROWS unless it is one leaf: links as (a, b)."""

    def numbered(rows: pa.Table) -> np.ndarray:
        """The number of each row's task; rows of a task lie together."""
        columns = [rows[c].to_numpy() for c in TASK]
        return np.cumsum(np.r_[False, np.any([c[1:] != c[:-1] for c in columns], axis=0)])

    def links(rows: pa.Table) -> dict:
        task, p, side = numbered(rows), rows["p"].to_numpy().view(np.uint64), rows["side"].to_numpy()
        order = np.lexsort((p, side, task))
        task, p, side = task[order], p[order], side[order]
        fp, errors, depth = (rows[c].to_numpy()[order].astype(np.int64) for c in ("fp", "errors", "depth"))
        cut = np.flatnonzero(np.r_[True, (task[1:] != task[:-1]) | (side[1:] != side[:-1]), True])
        lo, hi = cut[:-1], cut[1:]
        own = side[lo] < 0
        first = np.flatnonzero(np.r_[(task[lo][1:] == task[lo][:-1]) & ~own[1:], False]) if len(lo) > 1 else np.zeros(0, int)
        front = np.concatenate(
            [
                np.stack([lo[own], hi[own], lo[own], hi[own], errors[lo[own]], depth[lo[own]]], axis=1),
                np.stack([lo[first], hi[first], lo[first + 1], hi[first + 1], errors[lo[first]], depth[lo[first]]], axis=1),
            ]
        )
        root = spanning_forest(len(p), *_front_to_pairs(p, front[front[:, 1] - front[:, 0] + front[:, 3] - front[:, 2] > 1]))
        linked = root != np.arange(len(p))
        return {"a": fp[linked], "b": fp[root[linked]]}

    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < CHUNK_ROWS:
            continue
        rows = pa.concat_tables(held).combine_chunks()
        task = numbered(rows)
        whole = int(np.searchsorted(task, task[-1]))
        if whole:  # all but the last task, which may go on
            yield links(rows.slice(0, whole))
            held = [rows.slice(whole)]
    if held:
        yield links(pa.concat_tables(held).combine_chunks())


def linked_fingerprints(fps: DataFrame, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints within ERRORS bits to connect all that are linked."""
    waiting, done = routed(fps, fps.count()), []
    while True:
        both = (F.max("side") < 0) | ((F.min("side") == 0) & (F.max("side") == 1))
        sizes = waiting.groupBy(*TASK).agg(F.count("*").alias("n"), both.alias("both")).where("n > 1 and both")
        sizes = materialise(sizes, "tasks")
        large = sizes.where(F.col("n") > task_rows).select(*TASK)
        if large.isEmpty():
            done.append(attach(waiting, sizes.select(*TASK), TASK, "left_semi"))
            break
        done.append(attach(waiting, sizes.where(F.col("n") <= task_rows).select(*TASK), TASK, "left_semi"))
        waiting = attach(waiting, large, TASK, "left_semi")
        for _ in range(4):  # bits at a time
            waiting = split_once(waiting.where("depth < 64"))
        waiting = materialise(waiting, "split")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    columns = ["band", "key", F.xxhash64("path").alias("path"), "side", "errors", "depth", "p", "fp"]
    partitions = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*columns).repartition(partitions, *TASK).sortWithinPartitions(*TASK)
    return map_batches(dealt, _walk, "a long, b long").distinct()


def classes(rows: DataFrame) -> DataFrame:
    """(fp, component_id) of the fingerprints of ``rows``: the smallest doc_id of the component of each."""
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = materialise(components(linked_fingerprints(fps.select("fp"))), "roots")
    named = attach(fps, roots.withColumnRenamed("node", "fp"), ["fp"]).select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return attach(named, least, ["root"]).select("fp", "component_id")


def fingerprint_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row: components of fingerprints within ERRORS bits."""
    rows = materialise(fingerprints(docs), "fingerprints")
    return attach(rows, classes(rows), ["fp"]).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which no linked document has a smaller doc_id: of each component one document stays,
    as its rows are. Rows without a doc_id stay, and so do all rows that repeat a document that stays."""
    name = fresh(docs, "row")
    named = docs.withColumn(name, text_hash())
    rows = materialise(fingerprints(named, name), "fingerprints")
    later = attach(rows, classes(rows), ["fp"]).where("doc_id > component_id").select("doc_id", name).distinct()
    return attach(named, later, ["doc_id", name], "left_anti").select(*docs.columns)
