from __future__ import annotations

from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pytest

from sensorstream.llm import queries, whitening

KIND = "vec_id long, embedding array<double>, n string, key string, d string, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "x", "x", "x") for i, v in rows], KIND)


def exact_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in fractions."""
    d = len(matrix)
    a = [[Fraction(int(v)) for v in r] for r in matrix]
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in reversed(c)]


def rows_of(seed, n, d, scale=1.0):
    rnd = np.random.default_rng(seed)
    mix = rnd.normal(size=(d, d))
    return [(i, (rnd.normal(size=d) @ mix * scale).tolist()) for i in range(n)]


def brute(rows):
    y = np.array([[np.floor(1024 * np.float64(c)) for c in v] for _, v in rows])
    mean = y.mean(0)
    values, vectors = np.linalg.eigh((y - mean).T @ (y - mean) / len(y))
    return y - mean, values[::-1], vectors[:, ::-1]


def test_whitened_rows_are_those_of_a_plain_eigensolver(spark):
    rows = rows_of(3, 300, 11)
    found = {r.vec_id: r for r in whitening.whiten(table(spark, rows).repartition(3)).collect()}
    centred, values, vectors = brute(rows)
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(rows), x.sum(0)
    for (i, _), c, own in zip(rows, centred, x, strict=True):
        r = found[i]
        assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(own, s, strict=True)) == int(r.deviation_exact)
        wanted = c @ vectors[:, :8] / np.sqrt(values[:8])
        assert np.allclose(np.abs(r.whitened), np.abs(wanted), atol=1e-9)
        assert np.allclose(r.explained, values[:8] / values.sum(), rtol=1e-12)
        assert r.identity_error < 1e-9
    sign = np.sign(np.array([found[i].whitened for i, _ in rows]) * (centred @ vectors[:, :8]))
    assert (np.abs(sign.sum(0)) == n).all()


def test_polynomial_is_exact(spark):
    rnd = np.random.default_rng(5)
    b = rnd.integers(-1000, 1000, size=(6, 9)).astype(object)
    matrix = (b.T @ b).tolist()
    poly = whitening.characteristic_polynomial(spark, matrix)
    assert poly == exact_polynomial(matrix) and poly[:3] == [0, 0, 0]
    assert whitening.characteristic_polynomial(spark, [[0, 0], [0, 0]]) == [0, 0, 1]
    p = whitening.primes(10)[0]
    assert whitening.polynomial_mod(np.array([[0, 0, 1], [0, 5, 2], [1, 2, 7]]), p).tolist() == [c % p for c in exact_polynomial([[0, 0, 1], [0, 5, 2], [1, 2, 7]])]


def test_exact_products_of_great_values():
    rnd = np.random.default_rng(8)
    values = rnd.integers(-(2**62), 2**62, size=(70, 3))
    assert (whitening.exact_products(values) == values.astype(object).T @ values.astype(object)).all()


@pytest.mark.parametrize("roots", [[9, 5, 2], [7, 7, 3, 3, 3, 1], [10**30 + 1, 10**30, 4, 0, 0], [1, 1, 1]])
def test_roots_with_multiplicities(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = whitening.greatest_roots(poly, len(roots), sum(roots))
    flat = [Fraction(a, 2**k) for a, k, times in found for _ in range(times)]
    wanted = sorted((r for r in roots if r), reverse=True)
    assert len(flat) == len(wanted) and all(abs(f - w) * 2**100 <= w for f, w in zip(flat, wanted, strict=True))


def test_equal_eigenvalues_share_a_space(spark):
    rows = [(k, [float(4 * s * (j == i)) for j in range(3)]) for k, (i, s) in enumerate((i, s) for i in range(3) for s in (1, -1))]
    got = whitening.whiten(table(spark, rows)).collect()
    w = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id)])
    assert w.shape == (6, 3) and np.allclose(w.T @ w / 6, np.eye(3)) and got[0].identity_error < 1e-12
    assert np.allclose(got[0].explained, [1 / 3] * 3)
    with localcontext(Context(prec=60)):
        assert len(whitening.null_vectors([[2, 0, 0], [0, 2, 0], [0, 0, 1]], Decimal(2), 2)) == 2


def test_rows_that_go_and_rows_that_stay(spark):
    inf = float("inf")
    rows = [(1, [1, 2]), (2, [2, 1]), (2, [2, 1]), (None, [0.5, -3]), (4, None), (5, [None, 1]), (6, [inf, 1]), (7, [float("nan"), 0]), (8, [1e300, 1]),
            (9, []), (10, [1, 2, 3]), (11, [1, 2, 4]), (12, [5])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert sorted((repr(r.vec_id), len(r.whitened), r.n) for r in got) == sorted(
        [("1", 2, 4), ("2", 2, 4), ("2", 2, 4), ("None", 2, 4), ("9", 0, 1), ("10", 1, 2), ("11", 1, 2), ("12", 0, 1)])
    assert all(r.deviation == 0 and r.identity_error == 0 for r in got if r.vec_id in (9, 12))
    flat = whitening.by_component(whitening.whiten(table(spark, rows)))
    assert flat.count() == 10 and {r.component for r in flat.collect()} == {1, 2}


def test_great_values_do_not_overflow(spark):
    rows = [(i, [2.0**51 * (1 if i % 2 else -1), float(i)]) for i in range(6)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert all(r.deviation is None for r in got) and np.allclose([abs(r.whitened[0]) for r in got], 1)


def test_table_without_rows(spark):
    for t in (table(spark, []), table(spark, [(1, None)])):
        assert whitening.whiten(t).count() == 0 and whitening.by_component(whitening.whiten(t)).count() == 0


def test_query_has_the_columns_of_its_contract(spark):
    got = queries.op13_whitening(spark, "/root/testdata/sf0.001")
    kinds = [(f.name, f.dataType.simpleString()) for f in got.schema][:7]
    assert kinds == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = got.collect()
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    assert {r.component for r in rows} == set(range(1, 9))
