"""Whitening against exact fractions and numpy; the polynomial against the recursion by traces."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adtally.llm import whitening
from adtally.llm.queries import op11_whitening

SF = "/root/testdata/sf0.01"


def by_traces(matrix):
    """Coefficients of det(x - matrix), constant first, by the Faddeev-LeVerrier recursion in whole numbers."""
    d = len(matrix)
    found, power = [1], np.zeros((d, d), object)
    for k in range(1, d + 1):
        power = matrix @ (power + found[-1] * np.eye(d, dtype=int).astype(object))
        found.append(-int(np.trace(power)) // k)
    return found[::-1]


def polynomial(matrix):
    primes = whitening.primes_for(matrix)
    return whitening.combined([whitening.polynomial_modulo(matrix, p) for p in primes], primes)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(1, 8), st.integers(0, 10 ** 6))
def test_polynomial(d, n, seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-3, 4, (n, d)).astype(object) * int(rng.choice([1, 10 ** 12]))
    matrix = n * (rows.T @ rows) - np.outer(rows.sum(0), rows.sum(0))
    assert polynomial(matrix) == by_traces(matrix)


def test_products_of_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-(1 << 62), 1 << 62, (50, 3))
    whole = np.concatenate([np.ones((50, 1), np.int64), rows], 1).astype(object)
    assert (whitening.exact_products(rows) == whole.T @ whole).all()
    assert (whitening.exact_products(rows[:0]) == 0).all()


@pytest.mark.parametrize("value", [0, 1, -1, 2 ** 31, -2 ** 31, -2 ** 31 - 1, 3 ** 70, -3 ** 70])
def test_words(value):
    assert sum(word << (32 * place) for place, word in whitening._words(value)) == value


def test_primes():
    plain = [n for n in range(2 ** 20 - 200_000, 2 ** 20) if all(n % d for d in range(2, 1025))]
    assert whitening.primes_below(1 << 20, 9000) == plain[::-1][:9000]
    assert whitening.primes_below(1 << 31, 3) == [2147483647, 2147483629, 2147483587]


def test_roots_that_nearly_meet_and_multiple_ones():
    # 7, 7 - 2^-90 (scaled to whole numbers), a triple 2, and zeros
    unit = 1 << 90
    roots = [7 * unit, 7 * unit - 1, 2 * unit, 2 * unit, 2 * unit, 0]
    coefficients = [1]
    for root in roots:
        coefficients = [a - root * b for a, b in zip([0, *coefficients], [*coefficients, 0], strict=True)]
    found = whitening.Roots(coefficients).largest(8, sum(roots))
    assert [many for *_, many in found] == [1, 1, 3]
    for (at, bits, _), root in zip(found, (roots[0], roots[1], roots[2]), strict=True):
        assert abs(at - (root << bits)) << 100 <= root << bits


def check(rows, got, k=whitening.COMPONENTS):
    """``got`` against exact sums and numpy's eigenvalues; ``rows`` are (vec_id, entries)."""
    x = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    n, d = len(x), len(x[0][1])
    sums = [sum(v[j] for _, v in x) for j in range(d)]
    deviation = sorted((i, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in x)
    scatter = [[n * sum(v[a] * v[b] for _, v in x) - sums[a] * sums[b] for b in range(d)] for a in range(d)]
    covariance = np.array([[float(Fraction(c, n * n)) for c in row] for row in scatter])
    values = np.linalg.eigvalsh(covariance)[::-1]
    rank = min(k, int((values > 1e-9 * values[0]).sum()))
    assert sorted({r.component for r in got}) == list(range(1, rank + 1)) and len(got) == n * rank
    assert all(r.n == n for r in got)
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    shares = {r.component: r.explained for r in got}
    assert np.allclose([shares[c] for c in range(1, rank + 1)], values[:rank] / values.sum(), rtol=1e-6)
    return values


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op11_whitening(spark, SF).collect()
    values = check(rows, got)
    x = np.array([[math.floor(1024 * float(c)) for c in v] for _, v in rows], float)
    _, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    centred = x - x.mean(0)
    by_id = {(r.vec_id, r.component): r.whitened for r in got}
    for c in range(1, 9):
        mine = np.array([by_id[i, c] for i, _ in rows])
        theirs = centred @ vectors[:, -c] / math.sqrt(values[c - 1])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-6


def test_equal_eigenvalues(spark):
    """All directions alike: one root of multiplicity 5 needs an orthonormal set."""
    rows = [(2 * j + (s > 0), [s * (i == j) for i in range(5)]) for j in range(5) for s in (-1.0, 1.0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(rows, whitening.whitening_report(table).collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (None, [3.0, -1.0, 0.0]), (4, [0.25, 0.0, 0.0]), (9, [-0.0001, 0.0, 7.5])]
    odd = [(2, None), (3, []), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, [None, 1.0, 1.0]), (8, [1.0, 2.0])]
    table = spark.createDataFrame(sound + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as component", "'x' as n", "2 as vector")
    got = whitening.whitening_report(table).collect()
    assert sum(r.vec_id is None for r in got) == 3
    check([(i or 0, v) for i, v in sound], [type(r)(**(r.asDict() | {"vec_id": r.vec_id or 0})) for r in got])


def test_huge_entries(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whitening_report(table).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id != 3)
    assert all(r.identity_error < 1e-6 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_without_spread_there_are_no_components(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    result = whitening.whitening_report(table)
    assert result.collect() == []
    assert result.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
