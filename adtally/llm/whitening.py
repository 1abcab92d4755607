"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become whole numbers, ``floor(1024 c) + 100000``; one aggregate over all vectors adds up their
count, sums and products without rounding, so the scatter ``A = n Σ x xᵀ - S Sᵀ``, which is n² times the
covariance, is an exact integer matrix.

1. Its characteristic polynomial is found modulo as many primes as its largest possible coefficient
   needs (an elementary symmetric function of eigenvalues that are not negative and add up to the trace): a
   task brings the matrix to Hessenberg form modulo its primes and expands that form's determinant. The
   Chinese remainder theorem gives the coefficients.
2. All roots are real, so the sign changes of the polynomial moved to a point count exactly the roots above
   it. Bisection at dyadic points isolates the largest roots that way and narrows them by the sign alone to
   ``RELATIVE`` bits. Roots that stay together down to that width are one root with that multiplicity.
3. Inverse iteration on ``A`` less the root, in whole-number arithmetic with as many bits as the root has and
   more, gives the null space: one unit vector per root, an orthonormal set for a multiple one.

Projections on these vectors over the square root of the eigenvalue are the whitened vectors; the
covariance of what was stored gives ``identity_error``.

Null vectors, empty ones and those with a null or non-finite entry take no part. Of the others those of the
most frequent length do (of the longest, if several are as frequent). Entries beyond 2^62 / 1024 count as
that. A null id stays null; a repeated row counts as often as it occurs and comes out as often; other
columns are not used. There are as many components as nonzero eigenvalues, 8 at most: none, hence no rows,
for an empty table, one row, or equal rows. ``deviation`` is null beyond 38 digits.

What reaches the driver or goes to tasks is bounded by the dimension: sums, coefficients and components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import python_tasks
from adtally.session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 1 << 62
#: Products of numbers below 2^20 are added up without rounding in doubles, 2^13 of them at a time.
LIMB, ROWS = 20, 4096
#: Width of a root's interval, relative to the root, and bits beyond that for inverse iteration.
RELATIVE, SPARE = 120, 136
PRIME_BITS = 31


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the vectors that take part."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & sound & (F.size("vector") > 0))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("vector") == (sizes["dim"] if sizes else 0))


def whole_numbers(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(1024 c) of every entry; ``SHIFT`` changes neither scatter nor deviations and is left out."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64)


def exact_products(rows: np.ndarray) -> np.ndarray:
    """Σ z zᵀ as Python numbers, for z a row with a one before it: count, sums and products at once."""
    limbs, rest = [], np.concatenate([np.ones((len(rows), 1), np.int64), rows], 1)
    while np.abs(rest).max(initial=0) >> LIMB:
        limbs.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
    limbs = [limb.astype(np.float64) for limb in (*limbs, rest)]
    total = np.zeros((rows.shape[1] + 1,) * 2, object)
    for a, one in enumerate(limbs):
        for b, two in enumerate(limbs):
            total += (one.T @ two).astype(np.int64).astype(object) << (LIMB * (a + b))
    return total


def _words(value: int) -> Iterator[tuple[int, int]]:
    """(place, 32-bit word) of a number; the last word has the sign."""
    place = 0
    while not -(1 << 31) <= value < 1 << 31:
        yield place, value & 0xFFFFFFFF
        value, place = value >> 32, place + 1
    yield place, value


def scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums, and the exact matrix n Σ y yᵀ - S Sᵀ, for y = x - SHIFT."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            numbers = whole_numbers(batch.column(0), dim)
            for at in range(0, len(numbers), ROWS):
                total += exact_products(numbers[at:at + ROWS])
        words = [(i, j, *word) for i in range(dim + 1) for j in range(i, dim + 1) for word in _words(int(total[i, j]))]
        names = ["i", "j", "place", "word"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*words, strict=True)], names)

    sums = rows.select("vector").mapInArrow(add, "i bigint, j bigint, place bigint, word bigint")
    total = np.zeros((dim + 1, dim + 1), object)
    for row in sums.groupBy("i", "j", "place").agg(F.sum("word").alias("word")).collect():
        total[row.i, row.j] += row.word << (32 * row.place)
    total = np.triu(total) + np.triu(total, 1).T
    n, s, products = total[0, 0], total[0, 1:], total[1:, 1:]
    return n, list(s), n * products - np.outer(s, s)


def primes_below(limit: int, n: int) -> list[int]:
    """The ``n`` largest primes below ``limit``, which is far above their number."""
    small = np.ones(math.isqrt(limit) + 2, bool)
    small[:2] = False
    for at in range(2, math.isqrt(len(small)) + 1):
        small[at * at::at] = False
    divisors, found, end = np.flatnonzero(small), [], limit
    while len(found) < n:
        start = end - (1 << 16)
        prime = np.ones(end - start, bool)
        for d in divisors.tolist():
            prime[-start % d::d] = False
        found += (start + np.flatnonzero(prime)[::-1]).tolist()
        end = start
    return found[:n]


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime, constant first, by Hessenberg reduction."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        at = k + int(below[0])
        if at != k:
            h[[k, at]] = h[[at, k]]
            h[:, [k, at]] = h[:, [at, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:, k - 1:] = (h[k + 1:, k - 1:] - factor[:, None] * h[k, k - 1:] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(1)) % p
    # The determinant of each leading block from those of the smaller ones, along the last column.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        weight, product = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weight[i] = int(h[i, k - 1]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - (weight[:, None] * blocks[:k] % p).sum(0)) % p
    return blocks[d].tolist()


def combined(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The coefficients of least absolute value that have these residues."""
    product = math.prod(primes)
    parts = [(product // p) * pow(product // p, -1, p) for p in primes]
    values = [sum(r * part for r, part in zip(each, parts, strict=True)) % product for each in zip(*residues, strict=True)]
    return [v - product if 2 * v > product else v for v in values]


def primes_for(matrix: np.ndarray) -> list[int]:
    """Primes whose product exceeds twice any coefficient: binomial(d, k) (trace / d)^k at most, for some k."""
    d, trace = len(matrix), int(np.trace(matrix))
    most = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    return primes_below(1 << PRIME_BITS, 2 + (2 * most).bit_length() // (PRIME_BITS - 1))


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - matrix), constant first; every task takes some primes."""
    primes = primes_for(matrix)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(matrix, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["prime", "residues"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "prime bigint").repartition(tasks)
    found = rows.mapInArrow(reduce, "prime bigint, residues array<bigint>").collect()
    return combined([r.residues for r in found], [r.prime for r in found])


class Roots:
    """Roots of a polynomial all of whose roots are real; points are ``at / 2^bits``."""

    def __init__(self, coefficients: list[int]):
        self.zeros = next(i for i, c in enumerate(coefficients) if c)
        self.coefficients = coefficients[self.zeros:]

    def above(self, at: int, bits: int) -> int:
        """How many roots lie above a point: the sign changes of the polynomial moved there."""
        moved = [c << (bits * (len(self.coefficients) - 1 - i)) for i, c in enumerate(self.coefficients)]
        for first in range(len(moved) - 1):
            for i in range(len(moved) - 2, first - 1, -1):
                moved[i] += at * moved[i + 1]
        signs = [c > 0 for c in moved if c]
        return sum(a != b for a, b in zip(signs, signs[1:], strict=False))

    def sign(self, at: int, bits: int) -> int:
        value = 0
        for i, c in enumerate(reversed(self.coefficients)):
            value = value * at + (c << (bits * i))
        return (value > 0) - (value < 0)

    def narrowed(self, low: int, high: int, bits: int, over: int, many: int) -> Iterator[tuple[int, int, int]]:
        """(at, bits, multiplicity) of the ``many`` roots in (low, high], the largest first; ``over`` roots lie above."""
        while (high - low) << RELATIVE > low:
            if high - low < 2:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            if many == 1:
                sign = self.sign(middle, bits) * (-1) ** over
                if not sign:
                    low = high = middle
                elif sign > 0:
                    high = middle
                else:
                    low = middle
                continue
            upper = self.above(middle, bits) - over
            if 0 < upper < many:
                yield from self.narrowed(middle, high, bits, over, upper)
                yield from self.narrowed(low, middle, bits, over + upper, many - upper)
                return
            low, high = (middle, high) if upper else (low, middle)
        yield low + high, bits + 1, many

    def largest(self, k: int, bound: int) -> list[tuple[int, int, int]]:
        """Positive roots from the largest down until ``k`` are found, all at most ``bound``."""
        found, count = [], 0
        many = self.above(0, 0)
        if many:
            for root in self.narrowed(0, bound, 0, 0, many):
                found.append(root)
                count += root[2]
                if count >= k:
                    break
        return found


def null_space(matrix: np.ndarray, at: int, bits: int, many: int) -> np.ndarray:
    """``many`` orthonormal vectors that ``matrix - at / 2^bits`` takes to (nearly) nothing, by inverse iteration.

    Numbers are whole multiples of 2^-precision.
    """
    d, precision = len(matrix), max(bits, 0) + SPARE + RELATIVE
    lu = matrix * (1 << precision)
    lu[np.arange(d), np.arange(d)] -= at << (precision - bits)
    order = np.arange(d)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(lu[k + i, k]))
        lu[[k, pivot]], order[[k, pivot]] = lu[[pivot, k]], order[[pivot, k]]
        lu[k, k] = lu[k, k] or 1
        factor = (lu[k + 1:, k] * (1 << precision)) // lu[k, k]
        lu[k + 1:, k + 1:] -= (factor[:, None] * lu[k, k + 1:]) >> precision
        lu[k + 1:, k] = factor
    rng = np.random.default_rng(17)
    space = (rng.integers(1, 1 << 30, (d, many)) * rng.choice([-1, 1], (d, many))).astype(object) << (precision - 30)
    for _ in range(3):
        space = space[order]
        for k in range(d):
            space[k + 1:] -= (lu[k + 1:, k][:, None] * space[k]) >> precision
        for k in range(d - 1, -1, -1):
            space[k] = (space[k] * (1 << precision)) // lu[k, k]
            space[:k] -= (lu[:k, k][:, None] * space[k]) >> precision
        space = orthonormal(space, precision)
    return (space.T / (1 << precision)).astype(np.float64)


def orthonormal(space: np.ndarray, precision: int) -> np.ndarray:
    for c in range(space.shape[1]):
        for turn in range(2):
            # A column of full size first, so that rounding does not matter to what is taken off.
            size = max(abs(v) for v in space[:, c]) or 1
            space[:, c] = (space[:, c] * (1 << precision)) // size
            for other in range(c):
                space[:, c] -= (int((space[:, c] * space[:, other]).sum() >> precision) * space[:, other]) >> precision
            length = math.isqrt(int((space[:, c] ** 2).sum())) or 1
            space[:, c] = (space[:, c] * (1 << precision)) // length
    return space


def principal(spark, matrix: np.ndarray, k: int) -> tuple[np.ndarray, list[float], list[float]]:
    """Unit eigenvectors of the ``k`` largest eigenvalues that are not zero, the eigenvalues' square roots
    and their shares of the trace."""
    trace = int(np.trace(matrix))
    roots = Roots(characteristic_polynomial(spark, matrix)).largest(k, trace) if trace else []
    if not roots:
        return np.zeros((0, len(matrix))), [], []

    def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                found = null_space(matrix, *roots[number])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(found), pa.int64()), pa.array(found.tolist(), pa.list_(pa.float64()))], ["number", "component"]
                )

    rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(spaces, "number bigint, component array<double>").collect()
    vectors, sizes, shares = [], [], []
    for number, component in sorted((r.number, r.component) for r in rows):
        at, bits, _ = roots[number]
        vectors.append(component)
        # The root of a root, to 60 bits beyond its own.
        sizes.append(math.isqrt(at << (bits % 2 + 120)) / (1 << ((bits + bits % 2) // 2 + 60)))
        shares.append(at / (trace << bits))
    return np.array(vectors[:k]), sizes[:k], shares[:k]


def projected(rows: DataFrame, n: int, sums: list[int], vectors: np.ndarray, sizes: list[float]) -> DataFrame:
    """Stored (vec_id, deviation, whitened) of every row."""
    dim, kind = len(sums), dict(rows.dtypes)["vec_id"]
    most = max(map(abs, sums), default=0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = whole_numbers(batch.column(1), dim)
            reach = n * int(np.abs(numbers).max(initial=0)) + most
            own = np.array(sums, np.int64 if reach < LARGEST else object)
            from_mean = n * numbers.astype(own.dtype) - own
            wide = from_mean if reach * reach * dim < LARGEST else from_mean.astype(object)
            squares = [s if s < 10 ** 38 else None for s in (wide ** 2).sum(1).tolist()]
            whitened = from_mean.astype(np.float64) @ vectors.T / sizes
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(squares, pa.decimal128(38, 0)), pa.array(list(whitened), pa.list_(pa.float64())),
            ], ["vec_id", "deviation", "whitened"])

    result = rows.select("vec_id", "vector").mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")
    return materialize(result, "whitened")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of the stored ``whitened`` less the identity.

    The vectors were centred before they were projected, so the square of their mean takes off rounding only.
    """
    entry = [F.col("whitened")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = whitened.agg(*(F.sum(e) for e in entry), *(F.sum(entry[i] * entry[j]) for i, j in pairs)).first()
    means, products = [s / n for s in sums[:k]], sums[k:]
    return max(abs(total / n - means[i] * means[j] - (i == j)) for (i, j), total in zip(pairs, products, strict=True))


def whitened_vectors(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component."""
    spark = embeddings.sparkSession
    python_tasks(spark, ROWS)
    kind = dict(embeddings.dtypes)["vec_id"]
    nothing = spark.createDataFrame(
        [], f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    rows = usable(embeddings)
    one = rows.first()
    if one is None:
        return nothing
    n, sums, matrix = scatter(rows, len(one.vector))
    vectors, sizes, shares = principal(spark, matrix, components)
    if not sizes:
        return nothing
    stored = projected(rows, n, sums, vectors, sizes)
    error = identity_error(stored, n, len(sizes))
    each = stored.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.get(F.array(*map(F.lit, shares)), F.col("at"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """``whitened_vectors`` with ``deviation`` as a long (null where it needs more) and exact beside it."""
    return whitened_vectors(embeddings).withColumn("deviation_exact", F.col("deviation")).withColumn(
        "deviation", F.expr("try_cast(deviation AS bigint)")
    )
