"""Whitening of embeddings through the exact characteristic polynomial of their scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import session

# Grid of the entries: 256 steps to one.
STEPS = 256
COMPONENTS = 4

# Bits of a limb, and rows multiplied at once: sums of products stay below 2**53, where
# double precision is exact.
LIMB = 20
ROWS = 4096

# What a partial sum is split at, so that sums over all tasks fit a decimal.
SPLIT = 60

# Roots are isolated to this many bits after the point. Closer ones count as one root of
# that multiplicity, and fixed-point numbers have three times as many bits.
ROOT_BITS = 96


def gridded(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vectors`` with ``x``, the entries as whole numbers; rows without one are dropped.

    Those are rows whose vector is null, empty, or holds an entry that is null, not finite
    or beyond a long once gridded.
    """
    entry = lambda c: F.floor(c.cast("double") * STEPS) + F.lit(0).cast("long")
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * STEPS) < 2.0**63)
    found = F.col(column)
    whole = F.coalesce(F.size(found) > 0, F.lit(False)) & F.coalesce(
        F.forall(found, lambda c: F.coalesce(usable(c), F.lit(False))), F.lit(False)
    )
    return vectors.filter(whole).withColumn("x", F.transform(column, entry))


def _dimension(fit: DataFrame) -> int | None:
    """The commonest length, the longest of several; None of no vectors."""
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return first and first["d"]


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, limb k times ``2 ** (LIMB * k)``, is ``x`` (whole numbers).

    As many as the largest entry needs; the last one carries the sign.
    """
    parts = []
    while x.size and (x.max() >= 1 << LIMB or x.min() < -(1 << LIMB)):
        parts.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*parts, x.astype(np.float64)]


def _products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of ``x``, as Python numbers."""
    parts = limbs(x)
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's sums of products, one row per pair of dimensions; dimension -1 is the
    constant 1, so that its products are the sums and the number of rows."""
    total = 0
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            x = np.array(batch["x"].iloc[at : at + ROWS].tolist(), np.int64)
            total = total + _products(np.hstack([np.ones((len(x), 1), np.int64), x]))
    if isinstance(total, np.ndarray):
        i, j = np.triu_indices(len(total))
        sums = total[i, j]
        low = (1 << SPLIT) - 1
        yield pd.DataFrame(
            {"i": i - 1, "j": j - 1, "high": [str(s >> SPLIT) for s in sums], "low": [str(s & low) for s in sums]}
        )


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """``n``, the sums ``S`` and the whole-number matrix ``n * sum(x x') - S S'`` over the
    rows of ``fit``, all exact. That matrix is the covariance (divisor n) times ``n ** 2``.

    Each task sends its sums once; the driver gets one number per pair of dimensions.
    """
    partial = fit.mapInPandas(_partial_sums, "i int, j int, high string, low string")
    number = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).cast("string").alias(name)
    sums = np.zeros((d + 1, d + 1), object)
    for row in partial.groupBy("i", "j").agg(number("high"), number("low")).collect():
        value = (int(row["high"]) << SPLIT) + int(row["low"])
        sums[row["i"] + 1, row["j"] + 1] = sums[row["j"] + 1, row["i"] + 1] = value
    n, s = sums[0, 0], sums[0, 1:]
    return n, list(s), n * sums[1:, 1:] - np.multiply.outer(s, s)


def _is_prime(number: int) -> bool:
    return all(number % k for k in range(2, math.isqrt(number) + 1))


def primes_for(bound: int) -> list[int]:
    """Primes below ``2 ** 31``, largest first, whose product is more than ``bound``."""
    found, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(candidate):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo the prime ``p`` with zeros below the first subdiagonal."""
    h = matrix.copy()
    for k in range(len(h) - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not below.size:
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(axis=1)) % p
    return h


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo ``p``, constant term first.

    The leading blocks of the Hessenberg form give one polynomial from those before it.
    """
    h, d = hessenberg(matrix, p), len(matrix)
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        column = h[:k, k - 1].copy()
        product = 1
        for i in range(k - 2, -1, -1):
            product = product * int(h[i + 1, i]) % p
            column[i] = int(column[i]) * product % p
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - (column[:, None] * blocks[:k] % p).sum(axis=0)) % p
    return blocks[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(t - matrix), constant term first.

    ``matrix`` is whole and positive semidefinite, so coefficient k is at most the k-th
    elementary symmetric sum of equal eigenvalues. One task row per prime; remainders are
    put together by the Chinese remainder theorem.
    """
    d, trace = len(matrix), sum(np.diag(matrix))
    bound = 2 * max(math.comb(d, k) * -(-(trace**k) // d**k) for k in range(d + 1))
    primes = primes_for(bound)

    def modulo(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            remainders = [polynomial_modulo((matrix % p).astype(np.int64), p) for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "remainders": remainders})

    given = spark.createDataFrame(pd.DataFrame({"p": np.array(primes, np.int64)}), "p long")
    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    parts = given.repartition(tasks).mapInPandas(modulo, "p long, remainders array<long>").collect()
    whole = math.prod(primes)
    total = [0] * (d + 1)
    for row in parts:
        others = whole // row["p"]
        weight = others * pow(others, -1, row["p"])
        total = [(t + r * weight) % whole for t, r in zip(total, row["remainders"])]
    return [t - whole if 2 * t > whole else t for t in total]


def roots_above(polynomial: list[int], at: int) -> int:
    """Roots greater than ``at``, each as often as it occurs, of a polynomial that has only
    real roots: the changes of sign (Descartes) after ``at`` is made the origin."""
    shifted = list(polynomial)
    for i in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], trace: int, count: int, bits: int = ROOT_BITS) -> list[tuple[Fraction, int]]:
    """The largest ``count`` positive roots, largest first: (centre of an interval that
    holds it, times it occurs). ``trace`` is their sum.

    Intervals ``(low, high]`` on a grid of ``2 ** -bits`` are halved until they are one
    step; the counts at both ends are exact.
    """
    d = len(polynomial) - 1
    scaled = [c << (bits * (d - k)) for k, c in enumerate(polynomial)]
    top = trace << bits
    found: list[tuple[Fraction, int]] = []
    # each interval with the roots above its ends
    waiting = [(0, top, roots_above(scaled, 0), 0)]
    while waiting and sum(times for _, times in found) < count:
        low, high, above_low, above_high = waiting.pop()
        if above_low == above_high:
            continue
        if high - low == 1:
            found.append((Fraction(low + high, 2 << bits), above_low - above_high))
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        waiting.append((low, middle, above_low, above))
        waiting.append((middle, high, above, above_high))
    return found


def _solver(matrix: np.ndarray, bits: int):
    """Solves for ``matrix`` (fixed point, ``bits`` after the point) by elimination with
    row exchanges. A pivot of zero is taken for the smallest number."""
    lu, d = matrix.copy(), len(matrix)
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(lu[i, k]))
        if pivot != k:
            lu[[k, pivot]] = lu[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if lu[k, k] == 0:
            lu[k, k] = 1
        if k + 1 < d:
            lu[k + 1 :, k] = (lu[k + 1 :, k] << bits) // lu[k, k]
            lu[k + 1 :, k + 1 :] -= np.multiply.outer(lu[k + 1 :, k], lu[k, k + 1 :]) >> bits

    def solve(right: np.ndarray) -> np.ndarray:
        y = right[order].copy()
        for k in range(1, d):
            y[k] -= (lu[k, :k] * y[:k]).sum() >> bits
        for k in range(d - 1, -1, -1):
            rest = (lu[k, k + 1 :] * y[k + 1 :]).sum() >> bits if k + 1 < d else 0
            y[k] = ((y[k] - rest) << bits) // lu[k, k]
        return y

    return solve


def _unit(vector: np.ndarray, bits: int) -> np.ndarray:
    length = math.isqrt(sum(int(v) ** 2 for v in vector))
    return (vector << bits) // length


def null_vectors(matrix: np.ndarray, root: Fraction, times: int, bits: int = 3 * ROOT_BITS) -> list[np.ndarray]:
    """Orthogonal unit vectors that ``matrix - root`` sends to almost nothing, ``times`` many.

    Inverse iteration in fixed point: each step multiplies the part along the null space by
    the reciprocal of the root's error. ``matrix`` is scaled to a trace near one before.
    """
    d, scale = len(matrix), int(sum(np.diag(matrix))).bit_length()
    identity = np.array([[int(i == j) for j in range(d)] for i in range(d)], object)
    at = int(root * (1 << bits) / (1 << scale))
    solve = _solver((matrix << bits >> scale) - identity * at, bits)
    found: list[np.ndarray] = []
    for number in range(times):
        # any start with a part along the null space does; powers of a constant have one
        start = np.array([pow(3 + number, k + 1, 1009) - 504 for k in range(d)], object)
        vector = _unit(start << bits, bits)
        for _ in range(3):
            vector = solve(vector)
            for earlier in found:
                vector = vector - (earlier * ((earlier * vector).sum() >> bits) >> bits)
            vector = _unit(vector, bits)
        found.append(vector)
    return found


def principal_components(
    spark: SparkSession, matrix: np.ndarray, count: int = COMPONENTS
) -> list[tuple[Fraction, np.ndarray]]:
    """The largest positive eigenvalues of a whole positive semidefinite matrix and their
    unit vectors as doubles, each with its largest entry positive."""
    trace = int(sum(np.diag(matrix)))
    if trace == 0:
        return []
    polynomial = characteristic_polynomial(spark, matrix)
    found = []
    for root, times in largest_roots(polynomial, trace, count):
        for vector in null_vectors(matrix, root, times):
            unit = np.array([float(Fraction(int(v), 1 << 3 * ROOT_BITS)) for v in vector])
            found.append((root, unit * np.sign(unit[np.argmax(np.abs(unit))])))
    return found[:count]


def _projected(n: int, s: list[int], axes: np.ndarray) -> Column:
    """Per vector ``x`` the ``whitened`` values and the exact ``deviation``."""
    mean = np.array([float(Fraction(v, n)) for v in s])
    largest_sum = max(map(abs, s))
    exact_sums = np.array(s, object)

    @F.pandas_udf("whitened array<double>, deviation long")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch.tolist(), np.int64)
            largest = n * max(int(x.max()), -int(x.min())) + largest_sum
            if x.shape[1] * largest**2 < 1 << 63:
                deviations = ((n * x - exact_sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                exact = ((n * x.astype(object) - exact_sums) ** 2).sum(axis=1)
                deviations = [int(v) if v < 1 << 63 else None for v in exact]
            yield pd.DataFrame(
                {"whitened": list((x - mean) @ axes), "deviation": pd.array(deviations, "Int64")}
            )

    return project(F.col("x"))


def whitened(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """Per vector and component: ``key``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Entries are gridded to whole numbers and every distinct vector counts once in the fit.
    Rows that ``gridded`` drops, and those of another length than most vectors, have no
    result. Components without variance are left out: with fewer than two distinct vectors,
    or an empty table, the result is empty. A null or repeated key is a row like any other.
    ``deviation`` is null where it is beyond a long. Other columns are not read.

    Rows stay on executors: sums by pair of dimensions come to the driver, and the polynomial
    is computed modulo one prime per task row.
    """
    spark = vectors.sparkSession
    rows = gridded(vectors.select(F.col(key), F.col(column)), column).select(key, "x")
    fit = session.store(rows.select("x").distinct())
    d = _dimension(fit)
    found, n = [], 0
    if d is not None:
        fit = fit.filter(F.size("x") == d)
        n, s, matrix = scatter(fit, d)
        found = principal_components(spark, matrix, count)
    if not found:
        return rows.filter(F.lit(False)).select(
            key,
            *(F.lit(None).cast(kind).alias(name) for name, kind in (
                ("component", "int"), ("n", "long"), ("deviation", "long"),
                ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
            )),
        )
    trace = int(sum(np.diag(matrix)))
    # an eigenvalue of the covariance is that of the matrix over n squared
    deviations = [math.sqrt(root / n**2) for root, _ in found]
    axes = np.array([vector / e for (_, vector), e in zip(found, deviations)]).T
    values = _projected(n, s, axes)
    error = _identity_error(fit.select(values.alias("v")).select("v.whitened"), len(found))
    explained = F.array(*(F.lit(float(root / trace)) for root, _ in found))
    return (
        rows.filter(F.size("x") == d)
        .select(key, values.alias("v"))
        .select(key, "v.deviation", F.posexplode("v.whitened").alias("at", "whitened"))
        .select(
            key,
            (F.col("at") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )


def _identity_error(values: DataFrame, count: int) -> float:
    """Largest entry of the covariance of ``whitened`` minus the identity, by amount.
    ``covar_pop`` keeps centred sums."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    entries = values.agg(
        *(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs)
    ).first()
    return max(abs(entries[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
