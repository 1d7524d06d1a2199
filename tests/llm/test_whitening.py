"""Whitening against numpy's eigenvectors, and its exact parts against Fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from reviewloom.llm import queries, whitening

VECTORS = "vec_id bigint, embedding array<float>, x int, n int, component string, d int"


def fitted(vectors):
    """numpy's answer: n, exact sums, eigenvalues and vectors by falling eigenvalue."""
    x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], axes[:, ::-1]


def checked(frame, vectors, components=4):
    """Compares every row with numpy's; vectors are in order of vec_id."""
    x, fit, values, axes = fitted(vectors)
    n, sums = len(fit), fit.sum(axis=0)
    rows = sorted(whitening.whitened(frame).collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(rows) == len(x) * components
    got = np.array([r["whitened"] for r in rows]).reshape(len(x), components)
    wanted = (x - fit.mean(axis=0)) @ axes[:, :components] / np.sqrt(values[:components])
    signs = np.sign((got * wanted).sum(axis=0))
    assert np.abs(got - wanted * signs).max() < 1e-9
    for at, row in enumerate(rows):
        assert row["component"] == at % components + 1 and row["n"] == n
        assert row["deviation"] == sum(int(v) ** 2 for v in n * x[at // components] - sums)
        assert math.isclose(row["explained"], values[at % components] / values.sum(), rel_tol=1e-9)
        assert row["identity_error"] < 1e-10


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 9)) * np.array([5, 3, 2, 1, 1, 0.5, 0.2, 0.1, 0.05])).tolist()
    vectors += vectors[:100] + [vectors[0]] * 150
    rows = [(i, v, 1, 2, "c", 3) for i, v in enumerate(vectors)]
    checked(spark.createDataFrame(rows, VECTORS).repartition(5), vectors)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = [r["embedding"] for r in frame.orderBy("vec_id").collect()]
    checked(frame, vectors)
    assert queries.QUERIES["op12_whitening"](spark, folder).count() == 4 * len(vectors)


def test_rows_without_a_grid_vector_are_dropped(spark):
    vectors = [[0.5, 1.0], [1.5, -1.0], [2.5, 0.25], [0.0, 0.0]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [3e38, 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, 1, 2, "c", 3) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows + [(100 + i, v, 0, 0, "", 0) for i, v in enumerate(bad)], VECTORS)
    checked(frame, vectors, components=2)


def test_components_without_variance_are_left_out(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(5)], "vec_id bigint, embedding array<float>")
    assert {r["component"] for r in whitening.whitened(line).collect()} == {1}
    one = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert whitening.whitened(one).collect() == []
    assert whitening.whitened(one).columns == whitening.whitened(line).columns
    assert whitening.whitened(line.filter("false")).collect() == []


def test_equal_eigenvalues_get_orthogonal_components(spark):
    corners = [(i, [float(a), float(b), float(c)]) for i, (a, b, c) in enumerate(np.ndindex(2, 2, 2))]
    frame = spark.createDataFrame(corners, "vec_id bigint, embedding array<float>")
    rows = whitening.whitened(frame).collect()
    assert len(rows) == 24
    assert max(r["identity_error"] for r in rows) < 1e-12
    assert all(math.isclose(r["explained"], 1 / 3) for r in rows)


def test_close_eigenvalues_are_told_apart(spark):
    """A gap far below double precision of the matrix."""
    matrix = np.array([[10**30, 1, 0], [1, 10**30, 0], [0, 0, 5]], object)
    found = whitening.principal_components(spark, matrix, 3)
    assert [round(root) for root, _ in found] == [10**30 + 1, 10**30 - 1, 5]
    assert np.allclose(np.abs(found[0][1][:2]), math.sqrt(0.5), atol=1e-15)
    assert abs(found[0][1] @ found[1][1]) < 1e-15


def test_large_entries_are_exact(spark):
    values = [2.0**40, -(2.0**40), 2.0**50 + 2.0**30, 3.0]
    rows = [(i, [v, float(i)]) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    fit = whitening.gridded(frame).select("x")
    x = [(int(256 * v), 256 * i) for i, v in enumerate(values)]
    n, sums, matrix = whitening.scatter(fit, 2)
    assert n == 4 and sums == [sum(c) for c in zip(*x)]
    wanted = [[4 * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in (0, 1)] for i in (0, 1)]
    assert matrix.tolist() == wanted
    assert {r["deviation"] for r in whitening.whitened(frame).collect()} == {None}


def determinant(matrix):
    rows = [[Fraction(int(v)) for v in row] for row in matrix]
    result = Fraction(1)
    for k in range(len(rows)):
        pivot = next((i for i in range(k, len(rows)) if rows[i][k]), None)
        if pivot is None:
            return Fraction(0)
        if pivot != k:
            rows[k], rows[pivot] = rows[pivot], rows[k]
            result = -result
        result *= rows[k][k]
        for i in range(k + 1, len(rows)):
            factor = rows[i][k] / rows[k][k]
            rows[i] = [a - factor * b for a, b in zip(rows[i], rows[k])]
    return result


@pytest.mark.parametrize("d, rank", [(1, 1), (4, 4), (7, 3), (8, 8)])
def test_characteristic_polynomial(spark, d, rank):
    rng = random.Random(d)
    half = np.array([[rng.randint(-(10**6), 10**6) for _ in range(rank)] for _ in range(d)], object)
    matrix = half.dot(half.T)
    found = whitening.characteristic_polynomial(spark, matrix)
    assert len(found) == d + 1 and found[-1] == 1
    for t in range(-2, d):
        value = sum(c * t**k for k, c in enumerate(found))
        assert value == determinant(np.eye(d, dtype=int).astype(object) * t - matrix)


def test_roots():
    # (t - 3)^2 (t - 7) (t - 1) t
    polynomial = [0, 63, -114, 64, -14, 1]
    assert [whitening.roots_above(polynomial, at) for at in (-1, 0, 2, 3, 6, 7)] == [5, 4, 3, 1, 1, 0]
    found = whitening.largest_roots(polynomial, 14, 3, bits=30)
    assert [times for _, times in found] == [1, 2]
    assert all(abs(root - at) < Fraction(1, 10**6) for (root, _), at in zip(found, (7, 3)))


def test_limbs():
    x = np.array([[0, -1], [2**62, -(2**63)], [12345678901, -98765432109]], np.int64)
    parts = whitening.limbs(x)
    whole = sum(p.astype(np.int64).astype(object) << (whitening.LIMB * k) for k, p in enumerate(parts))
    assert whole.tolist() == x.tolist()
    assert len(whitening.limbs(np.array([[2**20 - 1, -(2**20)]]))) == 1
