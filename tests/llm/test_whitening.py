import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException

from millrace.llm import whitening as w

VECTORS = "vec_id bigint, embedding array<float>, label int, x string, dim string, i int, value string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", 2, "c", "d") for i, v in rows], VECTORS)


def random_rows(n, dim, seed):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + k) / 8 + rng.gauss(0, .1) * i / n for k in range(dim)]) for i in range(n)]


def integers(rows):
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows])


def brute(x, wanted=8):
    """Whitened rows (up to sign), explained shares and deviations, from plain formulas."""
    n, s = len(x), x.sum(0)
    values, v = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    values, v = values[::-1][:wanted], v[:, ::-1][:, :wanted]
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s)) for row in x]
    return (x - s / n) @ v / np.sqrt(values), values / np.trace(np.cov(x.T, bias=True).reshape(x.shape[1], -1)), deviation


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-10 ** 6, 10 ** 6, (7, 9)).astype(object)
    scatter = a @ a.T
    got = w.polynomials(spark, {7: scatter})[7]
    # Faddeev and LeVerrier, in whole numbers.
    m, want = np.zeros((7, 7), object), [1]
    for k in range(1, 8):
        m = scatter @ m + want[0] * np.eye(7, dtype=int).astype(object)
        trace = sum((scatter @ m)[i, i] for i in range(7))
        want.insert(0, -trace // k)
    assert got == want


def test_residues_of_matrices_with_zero_pivots():
    for matrix in (np.zeros((4, 4), object), np.diag([2, 2, 5, 0]).astype(object),
                   np.array([[0, 0, 1], [0, 3, 0], [1, 0, 0]], object)):
        p, want = 101, np.poly(matrix.astype(float))[::-1]
        assert w.polynomial_modulo(matrix, p).tolist() == [round(c) % p for c in want]


def test_roots_are_counted_with_their_multiplicity():
    cubic = [-4, 8, -5, 1]  # (x - 1)(x - 2)^2
    assert [w.roots_above(cubic, a) for a in (0, 1, 2, 3)] == [3, 2, 0, 0]
    roots, s = w.largest_roots(cubic, 5, 8)
    assert [float(Fraction(r, 1 << s)) for r in roots] == [2, 2, 1] and roots[0] == roots[1]


def test_against_plain_formulas(spark):
    rows = random_rows(400, 12, 1)
    awkward = [(900, None), (901, [1.0] * 11 + [math.nan]), (902, [math.inf] * 12), (903, [None] + [0.] * 11), (904, [])]
    twice = [*rows, rows[5], (None, [0.25] * 12)]
    got = w.whiten(vectors(spark, [*twice, *awkward]).repartition(5)).toPandas()
    white, explained, deviation = brute(integers(twice))
    assert len(got) == 8 * len(twice) and set(got.n) == {len(twice)}
    assert got.vec_id.isna().sum() == 8
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    by_id = got.dropna(subset="vec_id").drop_duplicates(["vec_id", "component"]).pivot(
        index="vec_id", columns="component")
    mine = by_id["whitened"].loc[range(400)].to_numpy()
    signs = np.sign((mine * white[:400]).sum(0))
    assert np.allclose(mine * signs, white[:400], atol=1e-9)
    assert np.allclose(by_id["explained"].iloc[0], explained, rtol=1e-9)
    assert by_id["deviation"].loc[range(400)].to_numpy()[:, 0].tolist() == deviation[:400]


def test_equal_eigenvalues_and_fewer_dimensions(spark):
    cross = [(2 * k + (s > 0), [s * (k == d) for d in range(3)] + [0.5]) for k in range(3) for s in (1.0, -1.0)]
    got = w.whiten(vectors(spark, cross)).toPandas()
    assert sorted(set(got.component)) == [1, 2, 3] and got.identity_error.max() < 1e-12
    assert np.allclose(got.explained, 1 / 3)
    assert w.whiten(vectors(spark, [(1, [1., 2.])] * 3)).count() == 0
    assert w.whiten(vectors(spark, [])).collect() == []
    assert w.whiten(vectors(spark, [(7, [1., 2.])])).count() == 0


def test_lengths_apart(spark):
    rows = random_rows(50, 3, 2) + [(100 + i, v) for i, v in random_rows(30, 2, 4)]
    got = w.whiten(vectors(spark, rows), components=2).toPandas()
    assert {(n, c): len(part) for (n, c), part in got.groupby(["n", "component"])} == {
        (50, 1): 50, (50, 2): 50, (30, 1): 30, (30, 2): 30}
    assert got.identity_error.max() < 1e-9


def test_large_entries(spark):
    rows = [(i, [v, 0.]) for i, v in enumerate((1e8, -1e8, 3e7, 5.))]
    got = w.whiten(vectors(spark, rows)).toPandas()
    x = integers(rows)
    want = brute(x, 1)[2]
    assert [int(d) for d in got.sort_values("vec_id").deviation_exact] == want
    assert got.sort_values("vec_id").deviation.isna().tolist() == [d >= 2 ** 63 for d in want]
    with pytest.raises(PySparkException):
        w.whiten(vectors(spark, [(1, [1e30]), (2, [0.])])).collect()
