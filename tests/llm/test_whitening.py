"""Whitening against a dense eigensolver in numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pluvia.llm import whitening
from pluvia.llm.op_queries import op13_embedding_whitening


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


def plain(rows, width):
    """Whole numbers of the vectors that count, in Python's integers."""
    good = [(i, v) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) and abs(1024 * x) < 1 << 49 for x in v)]
    return [i for i, _ in good], [[math.floor(1024 * x) + 100_000 for x in v] for _, v in good]


def check(got, ids, x, shown=8):
    n, dim = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x, strict=True)]
    apart = [[n * a - s for a, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array([[a / n for a in row] for row in apart])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    want = sorted((-1 if i is None else i, sum(a * a for a in row)) for i, row in zip(ids, apart, strict=True))
    assert sorted((-1 if r.vec_id is None else r.vec_id, int(r.deviation_exact)) for r in got if r.component == 1) == want
    assert len(got) == n * min(shown, dim) and {r.n for r in got} == {n}
    assert all(r.deviation == (int(r.deviation_exact) if r.deviation_exact < 1 << 63 else None) for r in got)
    for j in range(min(shown, dim)):
        own = [r for r in got if r.component == j + 1]
        if value[j] < 1e-12 * max(value[0], 1e-300):
            assert all(r.whitened is None and r.explained == 0 for r in own)
            continue
        assert own[0].explained == pytest.approx(value[j] / value.sum(), rel=1e-9)
        gaps = np.abs(np.delete(value, j) - value[j])
        if gaps.min() > 1e-3 * value[0]:  # else the component is any of a plane
            w = {}
            for i, row in zip(ids, centred, strict=True):
                w.setdefault(i, []).append(row @ vector[:, j] / math.sqrt(value[j]))
            got_w = {}
            for r in own:
                got_w.setdefault(r.vec_id, []).append(r.whitened)
            sign = np.sign(sum(w[i][0] * got_w[i][0] for i in w))
            assert all(sorted(sign * np.array(got_w[i])) == pytest.approx(sorted(w[i]), abs=1e-8) for i in w)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = op13_embedding_whitening(spark, sf_dir).collect()
    check(got, *plain(rows, 64))


@pytest.mark.parametrize("width", [1, 3, 8])
def test_widths_and_a_steep_spectrum(spark, width):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((400, 20)) * np.logspace(1, -2, 20) @ np.linalg.qr(rng.standard_normal((20, 20)))[0]
    rows = [*enumerate(data.tolist())]
    got = whitening.whiten(frame(spark, rows), width=width).collect()
    check(got, *plain(rows, 20))


@pytest.mark.parametrize("width", [1, 2, 8])
def test_equal_eigenvalues_and_missing_rank(spark, width):
    """Four equal directions, two smaller ones, and nothing in the other four."""
    base = [[0.0] * 10 for _ in range(12)]
    for i in range(6):
        for s in (0, 1):
            base[2 * i + s][i] = (1 - 2 * s) * (3.0 if i < 4 else 2.0 - i / 8)
    rows = [*enumerate(base)]
    got = whitening.whiten(frame(spark, rows), width=width).collect()
    check(got, *plain(rows, 10))
    assert sum(r.whitened is not None for r in got if r.vec_id == 0) == 6


def test_rows_that_do_not_differ(spark):
    got = whitening.whiten(frame(spark, [(1, [0.1, 0.2]), (2, [0.1, 0.2])])).collect()
    assert [(r.vec_id, r.component, r.deviation, r.whitened, r.explained) for r in sorted(got)] == [(i, c, 0, None, 0.0) for i in (1, 2) for c in (1, 2)]


def test_one_row_and_none(spark):
    assert {r.deviation for r in whitening.whiten(frame(spark, [(1, [0.1, 0.2])])).collect()} == {0}
    assert whitening.whiten(frame(spark, [(1, None), (2, [float("nan")]), (3, [])])).collect() == []


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(1)
    data = rng.integers(-(2**38), 2**38, (60, 5)) + 0.0
    rows = [*enumerate(data.tolist())]
    check(whitening.whiten(frame(spark, rows)).collect(), *plain(rows, 5))


def test_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 30)
    rng = np.random.default_rng(2)
    rows = [*enumerate(rng.standard_normal((300, 6)).tolist())]
    check(whitening.whiten(frame(spark, rows)).collect(), *plain(rows, 6))
