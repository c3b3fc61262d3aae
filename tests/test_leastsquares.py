"""Distributed QR against lstsq, and one model a series against lstsq on each."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import leastsquares
from pluvia.plans import jobs
from pluvia.sources import sinks
from tests.test_jobs import DAYS, zones  # noqa: F401

NAMES = ["a", "b", "c", "d"]


def frame(spark, x, y, parts=5):
    rows = [(*map(float, xs), float(v)) for xs, v in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*NAMES[: x.shape[1]], "label"])).repartition(parts)


def expected(x, y, rcond=1e-10):
    """Least norm over the centred columns."""
    mean = x.mean(axis=0)
    beta, *_ = np.linalg.lstsq(x - mean, y - y.mean(), rcond=rcond)
    return beta, y.mean() - mean @ beta


@pytest.mark.parametrize("case", ["full", "copy", "sum", "constant", "scales", "few rows", "one row", "large mean"])
def test_equal_to_lstsq(spark, case):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 4))
    rank = 4
    if case == "copy":
        x[:, 2], rank = x[:, 0], 3
    if case == "sum":
        x[:, 3], rank = 2 * x[:, 0] - x[:, 1] + 5, 3
    if case == "constant":
        x[:, 1], rank = 0.1, 3
    if case == "scales":
        x = x * [1e-6, 1, 1e6, 1e3]
    if case == "few rows":
        x, rank = x[:3], 2
    if case == "one row":
        x, rank = x[:1], 0
    if case == "large mean":
        x = x + [1e6, 0, -1e5, 3]
    y = x @ [1.5, -2.0, 0.3, 0.1] + 4 + 0.1 * rng.standard_normal(len(x))
    got = leastsquares.fit(frame(spark, x, y), NAMES)
    # Columns of very different sizes are independent, although the smallest singular value is tiny.
    beta, intercept = expected(x, y, None if case == "scales" else 1e-10)
    assert (got.rank, got.rows, len(got.dependent)) == (rank, len(x), 4 - rank)
    share = np.abs(x).max(axis=0) * (np.array(got.coefficients) - beta)  # what a difference makes of a prediction
    assert np.abs(share).max() <= 1e-9 * np.abs(y).max() and got.intercept == pytest.approx(intercept, rel=1e-7)
    if case != "scales":
        assert got.coefficients == pytest.approx(beta, rel=1e-7, abs=1e-9)
    rest = y - x @ beta - intercept
    assert got.residual == pytest.approx(rest @ rest, rel=1e-6, abs=1e-9) and got.total == pytest.approx(((y - y.mean()) ** 2).sum())


def test_badly_conditioned_inputs_keep_their_digits(spark):
    """Where sums of products would have lost all digits."""
    t = np.linspace(0, 1, 400)
    x = np.column_stack([t, t + 1e-6 * np.sin(40 * t)])
    y = 3 * x[:, 0] - 2 * x[:, 1]
    got = leastsquares.fit(frame(spark, x, y), NAMES[:2])
    assert got.rank == 2 and got.coefficients == pytest.approx([3, -2], rel=1e-7)


def test_triangles_in_a_tree(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 3))
    y = x @ [1, 2, 3] + rng.standard_normal(500)
    whole = leastsquares.fit(frame(spark, x, y, 1), NAMES[:3])
    monkeypatch.setattr(leastsquares, "FAN_IN", 2)
    monkeypatch.setattr(leastsquares, "BLOCK_ROWS", 7)
    tree = leastsquares.fit(frame(spark, x, y, 40), NAMES[:3])
    assert tree.coefficients == pytest.approx(whole.coefficients, rel=1e-12) and tree.rank == 3


def test_nulls_and_nothing(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (None, 1.0), (float("nan"), 1.0), (3.0, None), (4.0, 8.0)]
    df = spark.createDataFrame(rows, "a double, label double")
    got = leastsquares.fit(df, ["a"])
    assert got.rows == 3 and got.coefficients == pytest.approx([2.0]) and got.intercept == pytest.approx(0, abs=1e-12)
    scored = {r.a: r.p for r in leastsquares.score(df, got, "p").collect()}
    assert scored[None] is None and scored[4.0] == pytest.approx(8.0)
    with pytest.raises(ValueError):
        leastsquares.fit(df.where("false"), ["a"])


def test_one_model_a_series(spark):
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for k, n in enumerate([60, 4, 3, 2, 1, 500]):
        x = rng.standard_normal((n, 2)) * [1, 100] + [50, 0]
        y = x @ [k - 1.5, 0.2] + rng.standard_normal(n)
        rows += [(k, *map(float, xs), float(v)) for xs, v in zip(x, y, strict=True)]
        want[k] = None if n < 3 else np.linalg.lstsq(np.c_[np.ones(n), x], y, rcond=None)[0]
    rows += [(7, float(i), 2.0 * i + 1, 1.0) for i in range(9)] + [(8, 1.0, float(i), float(i)) for i in range(9)] + [(None, float(i), float(i * i), 1.0 * i) for i in range(5)]
    rows += [(9, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y double").repartition(4)
    got = {r.k: r for r in leastsquares.fit_each(df, ["k"], ["a", "b"], "y").collect()}
    assert set(got) == {*range(6), 7, 8, None}
    for k, beta in want.items():
        if beta is None:
            assert got[k].deficient and (got[k].intercept, got[k].a, got[k].b) == (None, None, None)
        else:
            assert not got[k].deficient and [got[k].intercept, got[k].a, got[k].b] == pytest.approx(list(beta), rel=1e-6, abs=1e-8)
    assert got[7].deficient and got[8].deficient and not got[None].deficient
    plan = leastsquares.fit_each(df, ["k"], ["a", "b"], "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and "partial_covar_pop" in plan


def test_analysis_with_dependent_inputs(spark, zones):  # noqa: F811
    """The temperature is a function of the precipitation: coefficients of least norm, the same each time."""
    rng = np.random.default_rng(2)
    values = [round(float(v), 2) for v in rng.uniform(0, 30, DAYS)]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, precipitation_sum double")
    daily = rows.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("time"), (F.col("precipitation_sum") * 2 + 1).alias("temperature_2m_max"), "precipitation_sum")
    sinks.write_parquet(daily, zones[2])
    found = {}
    jobs.analyse(spark, zones[2], zones[3], [], report=lambda title, df: found.update({title: df.collect()}))
    p = np.array(values)
    x = np.array([[2 * p[d] + 1, *[p[d - k] for k in (1, 2, 3)], *[2 * p[d - k] + 1 for k in (1, 2, 3)]] for d in range(3, DAYS - 1)])
    beta, intercept = expected(x, p[4:])
    assert [r.coefficient for r in found["coefficients"]] == pytest.approx([*beta, intercept], rel=1e-6, abs=1e-8)
    assert spark.read.json(zones[3]).count() == DAYS - 4
