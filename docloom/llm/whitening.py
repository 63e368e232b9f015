"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Entries become whole numbers, so that sums and products over all rows are exact: tasks give out partial sums in 32-bit limbs,
and the scatter ``n * sum(x x') - S S'`` is a matrix of integers. Its characteristic polynomial is found modulo many
primes, a prime per Spark row, by reduction to Hessenberg form, and put together by Chinese remaindering; the number of primes
follows from a proven bound of the coefficients. All its roots are real, so the sign changes of the
polynomial shifted to t count exactly the roots above t, repeated ones as often as they occur; that isolates each root by bisection, and
signs at finer points narrow it to ``ROOT_BITS`` binary places. A component solves (scatter - root) v = start by
elimination with ``DIGITS`` digits, twice: inverse iteration into the null space, several vectors at once for a repeated root.
Each component is a Spark row of its own.

What reaches the driver depends on the number of dimensions alone: the scatter, a polynomial per prime, the components.
"""

from __future__ import annotations

import decimal
import random
from collections.abc import Iterator
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.session import pinned

SCALE, SHIFT = 64, 1_000_000
MOST_COMPONENTS = 32
#: Roots are known to so many binary places; roots that agree in all of them count as one that is repeated.
ROOT_BITS = 192
DIGITS = 120
LIMB = 32


# --- whole numbers and their exact sums ------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


def whole_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key, y: floor(64 * entry) of the usable vectors that have the most frequent length, of equally frequent ones the largest.

    Entries beyond the range of a long are held at its ends.
    """
    top = F.lit((1 << 63) - 1 - SHIFT)
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(usable(F.col("v")))
    rows = pinned(rows.select("key", F.transform("v", lambda c: F.least(F.floor(c.cast("double") * SCALE), top)).alias("y")))
    size = rows.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("y") == (size[0].d if size and size[0].d else None))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers; through doubles where no sum can reach 2**53."""
    most = int(np.abs(y.astype(float)).max(initial=0)) + 1
    step = (1 << 53) // (most * most)
    if not step:
        whole = y.astype(object)
        return whole.T @ whole
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), step):
        part = y[i : i + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """Numbers of at most 33 bits whose sum, each shifted by its place, is ``value``; only the last may be negative."""
    place = 0
    while not -(1 << LIMB) < value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def moments(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums per dimension and sums of products, all exact."""

    def partial(batches):
        n, sums, products = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            y = matrix(batch.column("y"))
            n += len(y)
            more = y.astype(object).sum(0) if np.abs(y.astype(float)).max(initial=0) > 1e12 else y.sum(0).astype(object)
            sums = more if sums is None else sums + more
            products = exact_products(y) if products is None else products + exact_products(y)
        if n:
            upper = products[np.triu_indices(len(sums))]
            out = [(k, place, limb) for k, value in enumerate([n, *sums, *upper]) for place, limb in limbs(int(value))]
            yield pa.RecordBatch.from_pylist([dict(zip(("k", "place", "limb"), r)) for r in out])

    parts = rows.select("y").mapInArrow(partial, "k bigint, place bigint, limb bigint").groupBy("k", "place").agg(F.sum("limb").alias("limb"))
    values: dict[int, int] = {}
    for r in parts.collect():
        values[r.k] = values.get(r.k, 0) + (r.limb << LIMB * r.place)
    if not values:
        return 0, [], []
    # 1 + d + d (d + 1) / 2 values
    d = (isqrt(8 * len(values) + 1) - 3) // 2
    products = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(zip(*np.triu_indices(d)), 1 + d):
        products[i][j] = products[j][i] = values[k]
    return values[0], [values[1 + i] for i in range(d)], products


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    """n squared times the covariance, in integers; adding a constant to a dimension doesn't change it."""
    return [[n * p - sums[i] * sums[j] for j, p in enumerate(row)] for i, row in enumerate(products)]


# --- the characteristic polynomial --------------------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller and Rabin's test, exact below 3.2e9 with these bases."""
    if n < 4 or n % 2 == 0:
        return n in (2, 3)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def enough_primes(bound: int) -> list[int]:
    """Primes below 2**31, largest first, whose product is above twice the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo ``p``, constant term first."""
    a, d = a.copy(), len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        i = m + below[0]
        a[[i, m]] = a[[m, i]]
        a[:, [i, m]] = a[:, [m, i]]
        factor = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - factor[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * factor % p).sum(1)) % p
    # of the leading blocks of a Hessenberg matrix, each from the smaller ones
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(d):
        weight, product = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weight[i] = int(a[i, k]) * product % p
            product = product * int(a[i, i - 1]) % p if i else 0
        blocks[k + 1, 1:] = blocks[k, :-1]
        blocks[k + 1] = (blocks[k + 1] - (weight[:, None] * blocks[: k + 1] % p).sum(0)) % p
    return blocks[d]


def characteristic_polynomial(spark, a: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - a), constant term first, for a symmetric matrix without negative eigenvalues."""
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    # the k-th elementary symmetric function of d roots that aren't negative is at most that of d equal ones
    bound = max(comb(d, k) * (trace**k) // d**k + 1 for k in range(d + 1))
    primes = enough_primes(bound)

    def each(batches):
        whole = np.array(a, object)
        for batch in batches:
            for p in batch.column("p").to_pylist():
                found = polynomial_modulo((whole % p).astype(np.int64), p)
                yield pa.RecordBatch.from_pylist([{"p": p, "c": found.tolist()}])

    rows = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 64))
    found = {r.p: r.c for r in rows.mapInArrow(each, "p bigint, c array<bigint>").collect()}
    values, modulus = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((c - v) * inverse % p) for v, c in zip(values, found[p])]
        modulus *= p
    return [v - modulus if v > modulus // 2 else v for v in values]


# --- its roots ----------------------------------------------------------------------------------------------------


def roots_above(c: list[int], t: int) -> int:
    """Roots above ``t``, each as often as it is repeated; all roots are real."""
    c = list(c)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(c: list[int], t: int) -> int:
    value = 0
    for v in reversed(c):
        value = value * t + v
    return (value > 0) - (value < 0)


def scaled(c: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    d = len(c) - 1
    return [v << bits * (d - i) for i, v in enumerate(c)]


def kth_root(c: list[int], k: int, top: int) -> tuple[int, int, int]:
    """The k-th largest root, which is above 0 and at most ``top``, times 2**ROOT_BITS; its place among equal ones from 0, and their number."""
    low, high, at_low, at_high, bits, held = 0, top, roots_above(c, 0), 0, 0, c
    while at_low - at_high > 1:
        if high - low == 1:
            if bits == ROOT_BITS:
                return high, k - 1 - at_high, at_low - at_high
            bits, low, high = bits + 32, low << 32, high << 32
            held = scaled(c, bits)
        middle = (low + high) // 2
        above = roots_above(held, middle)
        low, high, at_low, at_high = (middle, high, above, at_high) if above >= k else (low, middle, at_low, above)
    more = ROOT_BITS - bits
    held, low, high = scaled(c, ROOT_BITS), low << more, high << more
    beyond = sign_at(held, high)
    if not beyond:
        return high, 0, 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if sign_at(held, middle) in (beyond, 0) else (middle, high)
    return high, 0, 1


# --- components -----------------------------------------------------------------------------------------------------


def null_space(a: list[list[int]], root: decimal.Decimal, n: int) -> list[list[decimal.Decimal]]:
    """``n`` orthonormal vectors that a - root takes to almost nothing."""
    d = len(a)
    rows = [[decimal.Decimal(v) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(a)]
    least = max(max(abs(v) for v in row) for row in rows) * decimal.Decimal(10) ** (10 - DIGITS)
    order, factors = list(range(d)), []
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        if abs(rows[k][k]) < least:
            rows[k][k] = least
        pivot, tail = rows[k][k], rows[k][k + 1 :]
        column = []
        for i in range(k + 1, d):
            f = rows[i][k] / pivot
            column.append(f)
            if f:
                rows[i][k + 1 :] = [x - f * y for x, y in zip(rows[i][k + 1 :], tail)]
        factors.append((best, column))

    def solved(b):
        b = list(b)
        for k, (best, column) in enumerate(factors):
            b[k], b[best] = b[best], b[k]
            for i, f in enumerate(column, k + 1):
                b[i] -= f * b[k]
        for k in reversed(order):
            b[k] = (b[k] - sum(x * y for x, y in zip(rows[k][k + 1 :], b[k + 1 :]))) / rows[k][k]
        return b

    rng = random.Random(1)
    found = [[decimal.Decimal(rng.randint(-1000, 1000)) + decimal.Decimal("0.5") for _ in range(d)] for _ in range(n)]
    for _ in range(2):
        basis: list[list[decimal.Decimal]] = []
        for v in map(solved, found):
            for _ in range(2):
                size = sum(x * x for x in v).sqrt()
                v = [x / size for x in v]
                for u in basis:
                    part = sum(x * y for x, y in zip(u, v))
                    v = [x - part * y for x, y in zip(v, u)]
            size = sum(x * x for x in v).sqrt()
            basis.append([x / size for x in v])
        found = basis
    return found


def components(spark, a: list[list[int]], most: int) -> list[tuple[decimal.Decimal, list[float]]]:
    """The largest positive eigenvalues and unit eigenvectors of ``a``, by falling eigenvalue; an eigenvector's largest entry is positive."""
    if not a:
        return []
    c = characteristic_polynomial(spark, a)
    top = sum(a[i][i] for i in range(len(a)))
    n = min(most, roots_above(c, 0))

    def each(batches):
        decimal.getcontext().prec = DIGITS
        for batch in batches:
            for k in batch.column("k").to_pylist():
                root, place, repeated = kth_root(c, k, top)
                value = decimal.Decimal(root) / (1 << ROOT_BITS)
                v = [float(x) for x in null_space(a, value, repeated)[place]]
                sign = 1.0 if max(v, key=abs) > 0 else -1.0
                yield pa.RecordBatch.from_pylist([{"k": k, "e": str(value), "v": [x * sign for x in v]}])

    if not n:
        return []
    rows = spark.createDataFrame([(k,) for k in range(1, n + 1)], "k bigint").repartition(n)
    found = sorted(rows.mapInArrow(each, "k bigint, e string, v array<double>").collect())
    return [(decimal.Decimal(r.e), list(r.v)) for r in found]


# --- whitening ------------------------------------------------------------------------------------------------------


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exact: as longs, or as Python integers where those could be too short."""
    most = float(np.abs(y.astype(float)).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most < 2.0**62:
        return y * n - np.array(sums, np.int64)
    return y.astype(object) * n - np.array(sums, object)


def squared_lengths(x: np.ndarray) -> list[int | None]:
    """Exact; None where a long can't hold it."""
    if x.dtype != object and float(np.abs(x.astype(float)).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
        return (x * x).sum(1).tolist()
    exact = [sum(v * v for v in row) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = MOST_COMPONENTS) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries are left out, and so are those whose length is not the most
    frequent one. Repeated rows and keys, and null keys, count and come out as they are. There are as many components as the
    covariance has positive eigenvalues, ``most`` at most: no row for an empty table, a single vector or equal vectors, which
    vary in no direction. For equal eigenvalues any orthonormal vectors of theirs are taken. A deviation that a long can't
    hold is null. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = whole_rows(vectors, key, vector)
    n, sums, products = moments(rows)
    a = scatter(n, sums, products)
    found = components(spark, a, most)
    trace = sum(a[i][i] for i in range(len(a)))
    k = len(found)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        scale = np.array([float(e.sqrt() / n) for e, _ in found])
        explained = [float(e / trace) for e, _ in found]
    axes = np.array([v for _, v in found]).reshape(k, len(a))

    def projected(batch):
        x = centred(matrix(batch.column("y")), n, sums)
        return x, (x / n).astype(float) @ axes.T / scale

    def sums_of(batches, make):
        total = None
        for batch in batches:
            if batch.num_rows:
                more = make(projected(batch)[1])
                total = more if total is None else total + more
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["k", "v"])

    def over_all(make):
        parts = rows.select("y").mapInArrow(lambda b: sums_of(b, make), "k bigint, v double")
        got = sorted((r.k, r.v) for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect())
        return np.array([v for _, v in got]) / n

    def out(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = projected(batch)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * k, pa.int32()), pa.array(w.ravel()))
            columns = [batch.column("key"), pa.array(squared_lengths(x), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "deviation", "w"])

    kind = dict(rows.dtypes)["key"]
    if not k:
        schema = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"key {kind}, {schema}").withColumnRenamed("key", key)
    mean = over_all(lambda w: w.sum(0))
    covariance = over_all(lambda w: (w - mean).T @ (w - mean)).reshape(k, k)
    error = float(np.abs(covariance - np.eye(k)).max())
    wide = rows.mapInArrow(out, f"key {kind}, deviation bigint, w array<double>")
    long = wide.select("key", "deviation", F.posexplode("w").alias("i", "whitened"))
    return long.select(
        F.col("key").alias(key),
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained), F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
