"""Least squares that hold where inputs depend on each other: one model by distributed QR, or one a series by grouped sums.

**One model.** Each task reduces its rows of (1, inputs, target) to a triangle by QR, block after block; triangles are stacked and reduced
again in a tree. With the column of ones first, the rest of the last triangle is that of the centred columns, so nothing is
squared and the error is that of the data's condition, not of its square. Column pivoting on that small triangle
gives the rank; where inputs depend on each other, the answer of least norm is taken, which is unique, and the rank is reported.

**One a series.** Centred sums of products are combined before one shuffle on the series, and a Cholesky factorisation and two
triangular solves are column expressions on one row a series. A series whose inputs depend on each other, or that has too few rows, has no unique
answer: it is flagged and has no coefficients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.functions.columns import is_complete
from pluvia.schemas import PREDICTED

#: An input is one of its own if what earlier ones leave of it is more than this share of it.
TOLERANCE = 1e-10

#: Sums of products tell apart less: of the variance of an input, more than this share must be its own.
TOLERANCE_OF_VARIANCE = 1e-11

#: Triangles that one task or the driver reduces.
FAN_IN = 64
#: Rows reduced at once in a task.
BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class LeastSquares:
    """``rank`` below the number of features means that they depend on each other; ``dependent`` names those which the
    others, taken in the order of pivoting, explain."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rank: int
    dependent: tuple[str, ...]
    rows: int
    residual: float  # sum of squares
    total: float  # of the centred target

    def predict(self) -> Column:
        """The prediction as a column expression, null where an input is null."""
        return sum((F.col(f) * F.lit(c) for f, c in zip(self.features, self.coefficients, strict=True)), F.lit(self.intercept))


def _reduced(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def triangle(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """The triangular factor of (1, columns) over all rows without a null or NaN, and the number of rows."""
    width = len(columns) + 1

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, n = np.zeros((0, width)), [], 0
        for batch in batches:
            waiting.append(np.column_stack([np.ones(batch.num_rows), *[np.asarray(c) for c in batch.columns]]))
            n += batch.num_rows
            if sum(map(len, waiting)) >= BLOCK_ROWS:
                r, waiting = _reduced(np.vstack([r, *waiting])), []
        yield _packed(_reduced(np.vstack([r, *waiting])), n)

    def reduce_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _packed(*_stacked(batches, width))

    rows = df.where(is_complete(df, columns)).select(*[F.col(f"`{c}`").cast("double") for c in columns])
    parts = rows.mapInArrow(reduce_rows, "r binary, n long")
    tasks = rows.rdd.getNumPartitions()
    while tasks > FAN_IN:
        tasks = math.ceil(math.sqrt(tasks))
        parts = parts.repartition(tasks).mapInArrow(reduce_triangles, "r binary, n long")
    return _stacked(parts.toArrow().to_batches(), width)


def _packed(r: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.record_batch({"r": pa.array([r.tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})


def _stacked(batches, width: int) -> tuple[np.ndarray, int]:
    parts, n = [np.zeros((0, width))], 0
    for batch in batches:
        parts += [np.frombuffer(b).reshape(-1, width) for b in batch["r"].to_pylist() if b]
        n += sum(batch["n"].to_pylist())
    return _reduced(np.vstack(parts)), n


def pivots(a: np.ndarray, scale: np.ndarray, tolerance: float = TOLERANCE) -> list[int]:
    """Columns in the order of pivoting, as long as one is left that the chosen ones do not explain. ``scale`` is the size that a
    column has in the data; what is left of it is measured against that."""
    left, chosen = a / np.where(scale > 0, scale, 1.0), []
    base = np.zeros((len(a), 0))
    for _ in range(min(a.shape)):
        size = np.linalg.norm(left, axis=0)
        size[chosen] = 0
        j = int(size.argmax())
        if size[j] <= tolerance:
            break
        q = left[:, j] / size[j]
        q = q - base @ (base.T @ q)
        q /= np.linalg.norm(q)
        base = np.column_stack([base, q])
        left = left - np.outer(q, q @ left)
        chosen.append(j)
    return chosen


def solve(r: np.ndarray, n: int, features: Sequence[str]) -> LeastSquares:
    """The answer of least norm from the triangle of (1, features, target)."""
    p = len(features)
    if not n:
        raise ValueError("least squares needs a row without nulls")
    r = np.vstack([r, np.zeros((max(0, p + 2 - len(r)), p + 2))])
    mean = r[0, 1:] / r[0, 0]
    a, b = r[1:, 1:-1], r[1:, -1]
    own = pivots(a, np.linalg.norm(r[:, 1:-1], axis=0))
    # On the chosen columns the rows of the triangle are independent; the least norm is within their span.
    beta = np.zeros(p)
    if own:
        q, _ = np.linalg.qr(a[:, own])
        rows = q.T @ a
        z, s = np.linalg.qr(rows.T)
        beta = z @ np.linalg.solve(s.T, q.T @ b)
    rest = b - a @ beta
    return LeastSquares(
        tuple(features), tuple(map(float, beta)), float(mean[-1] - mean[:-1] @ beta), len(own),
        tuple(f for i, f in enumerate(features) if i not in own), n, float(rest @ rest), float(b @ b),
    )


def fit(df: DataFrame, features: Sequence[str], label: str = "label") -> LeastSquares:
    """Least squares with intercept over all rows without a null or NaN."""
    return solve(*triangle(df, [*features, label]), features)


def score(df: DataFrame, model: LeastSquares, output: str = PREDICTED) -> DataFrame:
    return df.withColumn(output, model.predict())


# --- one model a series ------------------------------------------------------------------------


def fit_each(df: DataFrame, series: Sequence[str], features: Sequence[str], label: str, tolerance: float = TOLERANCE_OF_VARIANCE) -> DataFrame:
    """(series, n, deficient, intercept, a coefficient for each feature), one row a series, from one shuffle.

    The diagonal of the factorisation is what the inputs before leave of an input; where its square is at most ``tolerance`` of the
    variance of the input, the series is deficient.
    """
    p = len(features)
    names = [*features, label]
    rows = df.where(is_complete(df, names)).select(*series, *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    means = [F.avg(c).alias(f"_m{i}") for i, c in enumerate(names)]
    products = [F.covar_pop(names[i], names[j]).alias(f"_c{i}_{j}") for i in range(p + 1) for j in range(i + 1) if i < p or j < p]
    wide = rows.groupBy(*series).agg(F.count("*").alias("n"), *means, *products)
    # One column after the other: each is used by many later ones, so they are not put into each other.
    for j in range(p):
        pivot = F.col(f"_c{j}_{j}") - sum((F.col(f"_l{j}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0))
        own = pivot > F.col(f"_c{j}_{j}") * F.lit(tolerance)
        wide = wide.withColumn(f"_l{j}_{j}", F.when(own, F.sqrt(pivot)))
        below = {
            f"_l{i}_{j}": (F.col(f"_c{i}_{j}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"_l{j}_{j}")
            for i in range(j + 1, p + 1)
        }
        wide = wide.withColumns(below)
    # The row of the target in the factor is the solution of the first triangle; the second is solved from the last feature on.
    for i in reversed(range(p)):
        later = sum((F.col(f"_l{k}_{i}") * F.col(f"_b{k}") for k in range(i + 1, p)), F.lit(0.0))
        wide = wide.withColumn(f"_b{i}", (F.col(f"_l{p}_{i}") - later) / F.col(f"_l{i}_{i}"))
    deficient = F.col("_b0").isNull()
    intercept = F.col(f"_m{p}") - sum((F.col(f"_b{i}") * F.col(f"_m{i}") for i in range(p)), F.lit(0.0))
    return wide.select(*series, "n", deficient.alias("deficient"), intercept.alias("intercept"), *[F.when(~deficient, F.col(f"_b{i}")).alias(c) for i, c in enumerate(features)])
