"""Bit-sliced scatter, components, whitened values: brute force in Python
integers and numpy."""

import math

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import catalog, whitening

ROWS = "vec_id bigint, embedding array<double>"


def brute(vectors, components=4):
    """n, S, covariance from exact integers, eigenvalues (falling), trace."""
    xs = {tuple(math.floor(256 * c) for c in v) for v in vectors}
    d, n = max(map(len, xs)), len({x + (0,) * (max(map(len, xs)) - len(x)) for x in xs})
    xs = sorted({x + (0,) * (d - len(x)) for x in xs})
    sums = [sum(x[i] for x in xs) for i in range(d)]
    centred = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in xs) / n ** 3 for j in range(d)] for i in range(d)]
    return n, sums, np.array(centred)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5).flatmap(lambda d: st.lists(
    st.lists(st.one_of(st.integers(-300, 300), st.integers(-2 ** 63, 2 ** 63 - 1)), min_size=d, max_size=d),
    min_size=1, max_size=70)))
def test_block_scatter_is_exact(rows):
    cross, sums = whitening.block_scatter(np.array(rows, np.int64))
    d = len(rows[0])
    assert [int(s) for s in sums] == [sum(r[i] for r in rows) for i in range(d)]
    assert [[int(v) for v in r] for r in cross] == [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]


@given(st.integers(-2 ** 140, 2 ** 140))
def test_limbs_add_up(value):
    assert sum(part << (whitening.LIMB * k) for k, part in whitening._limbs(value)) == value
    assert all(-(1 << 40) < part < (1 << 40) for _, part in whitening._limbs(value))


def test_query_equals_brute_force(spark):
    got = catalog.QUERIES["op11_whitening"](spark, SF001).collect()
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    n, sums, covariance = brute([r.embedding for r in rows])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    mine = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(mine) == 4 * len(rows)
    x = np.array([[math.floor(256 * c) for c in r.embedding] for r in rows], object)
    away = n * x - np.array(sums, object)
    whitened = (away / n).astype(float) @ vectors[:, :4] / np.sqrt(values[:4])
    for k in range(4):
        found = np.array([mine[r.vec_id, k + 1].whitened for r in rows])
        sign = np.sign(found @ whitened[:, k])
        assert np.abs(found - sign * whitened[:, k]).max() < 1e-6
    for r, a in zip(rows, away, strict=True):
        one = mine[r.vec_id, 1]
        assert one.n == n and one.deviation == sum(int(v) ** 2 for v in a) == int(one.deviation_digits)
        assert one.explained == pytest.approx(values[0] / np.trace(covariance), rel=1e-9)
        assert one.identity_error <= 1e-9


def test_odd_rows_ties_repeats_and_other_columns(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, None), (3, [0.5, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
            (None, [-0.25, 2.0]), (6, [3.0]), (7, []), (8, [0.501, 1.001])]
    df = spark.createDataFrame([(*r, 9, 0.5) for r in rows], ROWS + ", component int, whitened double")
    got = whitening.whiten(df, "vec_id", "embedding").collect()
    # 8 has 1's integers; 6 and 7 end in zeros.
    kept = [[0.5, 1.0], [-0.25, 2.0], [3.0, 0.0], [0.0, 0.0]]
    n, _, covariance = brute(kept)
    assert {r.n for r in got} == {n} == {4}
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted(
        (i is None, i or 0, c) for i in [1, 1, None, 6, 7, 8] for c in (1, 2))
    values = np.linalg.eigvalsh(covariance)[::-1]
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum())
        assert r.identity_error < 1e-9


def test_no_variance_and_empty_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], ROWS), "vec_id", "embedding").count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], ROWS), "vec_id", "embedding").count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], ROWS), "vec_id", "embedding").collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)] * 2
    line = whitening.whiten(spark.createDataFrame([(k, [k * 1.0, k * 2.0]) for k in range(9)], ROWS), "vec_id", "embedding").collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in line)


def test_values_beyond_longs(spark):
    rows = [(k, [1e30 if k == 3 else float(k), -1e25 * k, 1.0]) for k in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, ROWS), "vec_id", "embedding").collect()
    hold = lambda c: max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * c)))
    x = [[hold(c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in got:
        exact = sum((5 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums, strict=True))
        assert int(r.deviation_digits) == exact and r.deviation is None


def test_same_fit_for_any_partitioning(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet").select(whitening.integers("embedding").alias("x"))
    one, many = (whitening.scatter(df.repartition(k), 64) for k in (1, 7))
    assert one[0] == many[0] and (one[1] == many[1]).all() and (one[2] == many[2]).all()
