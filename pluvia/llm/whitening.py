"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The recurrence alternates two products with the rows X, both made in one pass over blocks of rows inside
Spark tasks: u = Xq for each row, and Xᵀu added up over all rows.

    U_k A_k       = X V_k - U_{k-1} B_{k-1}          A_k, B_k: the two bands of the small matrix
    V_{k+1} B_kᵀ  = Xᵀ U_k - V_k A_kᵀ

It runs in its block form: a step takes ``width`` directions at once, so that all steps together read the rows a
``width``-th as often, and equal eigenvalues are found up to that multiplicity without a restart. Width 1 is the
plain recurrence with a bidiagonal matrix; tests hold both against a dense solver. Each new block of
directions is orthogonalised against all earlier ones, twice, on both sides (full reorthogonalisation). The singular values
of the small matrix are the deviations along the components, times the square root of the number of rows.

A left vector is never stored by row: it is X times a vector of as many entries as there are dimensions, kept on the driver, and each pass
makes it anew. A pass therefore has no state, and a lost executor costs the blocks it was reading. What reaches the
driver is dimensions times ``width`` numbers, added in a tree of tasks.

Entries are whole numbers (floor(SCALE * c) + OFFSET), so sums, means and distances from the mean are exact:
centred entries are (n * x - S) / n with the numerator in integer arithmetic, whatever the offset.

Defined results: a vector that is null or holds a null or a value that is not finite, or one so large that its
whole number reaches 2^50, is left out, and so is an empty one. Vectors of another length than the most frequent (of equally frequent ones,
the longest) are left out. Repeated rows and rows without an id count like any other, and are returned. Directions in which the
rows do not differ have no component: their ``whitened`` is null and their share 0, so that every row keeps min(components,
dimensions) rows. ``deviation`` is null where it passes the range of a long; ``deviation_exact`` holds it to 38 digits. No rows in: no rows out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import SEED, map_batches
from pluvia.session import materialise

SCALE = 1024.0
OFFSET = 100_000
LIMIT = 1 << 50

#: Entries in one block of rows.
BLOCK_VALUES = 1 << 18

#: Components looked for, and directions in one step.
COMPONENTS = 8
WIDTH = 8

#: Partial results that one task or the driver adds up.
FAN_IN = 64

#: A triplet is settled when its residual is below this share of the largest singular value.
TOLERANCE = 1e-15
#: Directions below this share of the largest (as singular values) are rounding, not data.
NOTHING = 1e-7

BLOCK = "dim int, n long, ids array<bigint>, sums array<bigint>, wide boolean, x binary"


def to_blocks(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Valid vectors as blocks of whole numbers, written once: each later pass reads bytes and no single values."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        waiting: dict[int, list[tuple[list, np.ndarray]]] = {}

        def block(dim: int) -> dict:
            parts = waiting.pop(dim)
            x, ids = np.concatenate([p for _, p in parts]), [i for part, _ in parts for i in part]
            wide = bool(np.abs(x).max() >= 1 << 31)
            data = x.astype("<i8" if wide else "<i4").tobytes()
            return {"dim": [dim], "n": [len(x)], "ids": [ids], "sums": [x.sum(axis=0).tolist()], "wide": [wide], "x": [data]}

        for batch in batches:
            ids, lists = batch["id"].to_pylist(), batch["v"]
            size = np.array(lists.value_lengths().fill_null(0))
            values = lists.flatten()
            entry = np.floor(SCALE * np.array(values.cast(pa.float64()).fill_null(math.nan))) + OFFSET
            bad = np.bincount(np.repeat(np.arange(len(size)), size), ~(np.abs(entry) < LIMIT), minlength=len(size)) > 0
            start = np.cumsum(size) - size
            for dim in np.unique(size[(size > 0) & ~bad]).tolist():
                rows = np.flatnonzero((size == dim) & ~bad)
                x = entry[start[rows][:, None] + np.arange(dim)].astype(np.int64)
                waiting.setdefault(dim, []).append(([ids[r] for r in rows], x))
                if sum(len(p) for _, p in waiting[dim]) * dim >= BLOCK_VALUES:
                    yield block(dim)
        for dim in list(waiting):
            yield block(dim)

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v")).where("v is not null")
    return materialise(map_batches(rows, pack, BLOCK), "vectors")


def _whole(wide: bool, data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i8" if wide else "<i4").reshape(-1, dim).astype(np.int64)


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs where they hold it, in Python's integers otherwise."""
    if n * int(np.abs(x).max()) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(float)


@dataclass(frozen=True)
class Rows:
    """Blocks of one length of vector, with their number of rows and their sum in each dimension."""

    blocks: DataFrame
    dim: int
    n: int
    sums: list[int]

    @classmethod
    def of(cls, blocks: DataFrame) -> Rows | None:
        most = blocks.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
        if most is None:
            return None
        own = blocks.where(F.col("dim") == most["dim"])
        total = own.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        return cls(own, most["dim"], int(most["n"]), [int(r["s"]) for r in total.orderBy("i").collect()])

    def total(self, of_block, shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all blocks of an array ``of_block(centred rows)``: one partial sum a task, then a tree of them."""
        n, sums, dim = self.n, self.sums, self.dim

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            total = np.zeros(shape)
            for batch in batches:
                for wide, data in zip(batch["wide"].to_pylist(), batch["x"].to_pylist(), strict=True):
                    total += of_block(_centred(_whole(wide, data, dim), n, sums))
            yield {"part": [total.tobytes()]}

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            yield {"part": [_added(batches, shape).tobytes()]}

        parts = map_batches(self.blocks.select("wide", "x"), partial, "part binary")
        tasks = self.blocks.rdd.getNumPartitions()
        while tasks > FAN_IN:
            tasks = math.ceil(math.sqrt(tasks))
            parts = map_batches(parts.repartition(tasks), merge, "part binary")
        return _added(parts.toArrow().to_batches(), shape)


def _added(batches, shape: tuple[int, ...]) -> np.ndarray:
    total = np.zeros(shape)
    for batch in batches:
        for data in batch["part"].to_pylist():
            total += np.frombuffer(data).reshape(shape)
    return total


def _inverse_root(gram: np.ndarray, floor: float) -> np.ndarray:
    """T with Tᵀ G T = 1 on the directions of ``gram`` above ``floor``."""
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    kept = value > max(floor, 0.0)
    return vector[:, kept] / np.sqrt(value[kept])


def _beside(w: np.ndarray, v: np.ndarray, floor: float) -> np.ndarray:
    """An orthonormal base of the columns of ``w`` outside the span of ``v``."""
    for _ in range(2):
        w = w - v @ (v.T @ w)
    u, s, _ = np.linalg.svd(w, full_matrices=False)
    u = u[:, s > floor]
    return np.linalg.qr(u - v @ (v.T @ u))[0] if u.shape[1] else u


@dataclass(frozen=True)
class Whitening:
    components: np.ndarray  # [dimensions, k], unit columns, by falling eigenvalue
    values: np.ndarray  # eigenvalues of the covariance, divisor n
    trace: float
    passes: int


def fit(rows: Rows, components: int = COMPONENTS, width: int = WIDTH, seed: int = SEED) -> Whitening:
    """The leading ``components`` of the covariance of all rows."""
    dim, n, passes = rows.dim, rows.n, 0
    rng = np.random.default_rng(seed)
    width = min(width, dim)

    def product(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(Xq)ᵀXq and Xᵀ(Xq), from one pass."""

        def of_block(x: np.ndarray) -> np.ndarray:
            u = x @ q
            return np.vstack([u.T @ u, x.T @ u])

        both = rows.total(of_block, (q.shape[1] + dim, q.shape[1]))
        return both[: q.shape[1]], both[q.shape[1] :]

    trace = float(rows.total(lambda x: np.array([(x * x).sum()]), (1,))[0]) / n
    if not trace:
        return Whitening(np.zeros((dim, 0)), np.zeros(0), 0.0, 1)
    v = np.zeros((dim, 0))  # right vectors
    p = np.zeros((dim, 0))  # left vectors U = X p
    z = np.zeros((dim, 0))  # Xᵀ U
    bands, last = np.zeros((0, 0)), 0
    new, restarted = _beside(rng.standard_normal((dim, width)), v, 0.0), True
    while True:
        q = new
        for _ in range(2):
            gram, y = product(q)
            passes += 1
            c = p.T @ y  # Uᵀ X q
            scale = np.trace(gram) if len(bands) == 0 else np.linalg.norm(bands, 2) ** 2
            root = _inverse_root(gram - c.T @ c, NOTHING**2 * scale if q is new else 0.0)
            q, y = (q - p @ c) @ root, (y - z @ c) @ root
            if not q.shape[1]:
                break
        v = np.hstack([v, new])
        if not q.shape[1] and restarted:
            bands = np.hstack([bands, np.zeros((len(bands), new.shape[1]))])
            break  # on all that is left the rows do not differ
        p, z = np.hstack([p, q]), np.hstack([z, y])
        grown = np.zeros((p.shape[1], v.shape[1]))
        grown[: bands.shape[0], : bands.shape[1]] = bands
        before, here = slice(bands.shape[0] - last, bands.shape[0]), slice(bands.shape[0], None)
        grown[before, bands.shape[1] :] = z[:, before].T @ new
        grown[here, bands.shape[1] :] = y.T @ new
        bands, last = grown, q.shape[1]

        left, sigma, _ = np.linalg.svd(bands)
        rest = y - v @ (v.T @ y)
        residual = np.linalg.norm(rest @ left[here, :components], axis=0)
        settled = len(sigma) >= components and bool(np.all(residual <= TOLERANCE * sigma[0]))
        if settled or v.shape[1] == dim:
            break
        room = dim - v.shape[1]
        new, restarted = _beside(y, v, NOTHING * sigma[0])[:, :room], False
        if not new.shape[1]:
            new, restarted = _beside(rng.standard_normal((dim, min(width, room))), v, 0.0), True

    _, sigma, right = np.linalg.svd(bands)
    k = int(min(components, (sigma > NOTHING * sigma[0]).sum()))
    found = v @ right[:k].T
    found = found / np.linalg.norm(found, axis=0)
    found *= np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)])
    return Whitening(found, sigma[:k] ** 2 / n, trace, passes + 1)


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    return x @ (model.components / np.sqrt(model.values))


def identity_error(rows: Rows, model: Whitening) -> float:
    """The largest entry of the covariance of all whitened rows, less the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    mean = rows.total(lambda x: _project(x, model).sum(axis=0), (k,)) / rows.n

    def of_block(x: np.ndarray) -> np.ndarray:
        w = _project(x, model) - mean
        return w.T @ w

    return float(np.abs(rows.total(of_block, (k, k)) / rows.n - np.eye(k)).max())


def whitened(rows: Rows, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact) of every row and component."""
    n, sums, dim, k = rows.n, rows.sums, rows.dim, len(model.values)
    shown = min(components, dim)
    error = identity_error(rows, model)
    share = np.zeros(shown)
    share[:k] = model.values / model.trace if k else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for ids, wide, data in zip(batch["ids"].to_pylist(), batch["wide"].to_pylist(), batch["x"].to_pylist(), strict=True):
                x = _whole(wide, data, dim)
                apart = _differences(x, n, sums)
                if apart.dtype == object or np.abs(apart).max() ** 2 * dim >= 1 << 62 or np.square(apart.astype(float)).sum(axis=1).max() >= 1 << 62:
                    squares = [sum(a * a for a in row) for row in apart.tolist()]
                else:
                    squares = np.square(apart).sum(axis=1).tolist()
                w = np.full((len(x), shown), np.nan)
                w[:, :k] = _project((apart / n).astype(float), model)
                row = np.repeat(np.arange(len(x)), shown)
                yield {
                    "vec_id": pa.array(ids, pa.int64()).take(row),
                    "component": np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x)),
                    "n": np.full(len(row), n, np.int64),
                    "deviation": pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()).take(row),
                    "whitened": pa.array(w.ravel(), mask=np.tile(np.arange(shown) >= k, len(x))),
                    "explained": np.tile(share, len(x)),
                    "identity_error": np.full(len(row), error),
                    "deviation_exact": pa.array([s if s < 10**38 else None for s in squares], pa.decimal128(38, 0)).take(row),
                }

    return map_batches(rows.blocks.select("ids", "wide", "x"), run, WHITENED)


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def whiten(vectors: DataFrame, components: int = COMPONENTS, width: int = WIDTH) -> DataFrame:
    """Fit on all valid vectors and whiten each of them."""
    rows = Rows.of(to_blocks(vectors))
    if rows is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    return whitened(rows, fit(rows, components, width), components)
