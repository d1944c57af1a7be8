"""Whitening by the exact characteristic polynomial of the integer scatter matrix.

Entries are integers, so their scatter matrix (n times the sum of products less the product of sums) is summed exactly: tasks
multiply limbs of 20 bits in doubles without rounding and hand on one row of integer limbs per matrix row. Its
characteristic polynomial is found modulo many primes, each reduced to Hessenberg form in a task of its own, and put
together by Chinese remaindering. The matrix is symmetric, so all roots are real and the sign changes
of the polynomial, moved to a point, count the roots beyond that point exactly: bisection over dyadic points isolates the
greatest roots and sharpens them. Their eigenvectors come from inverse iteration near the null space of the moved
matrix, in decimal arithmetic of enough digits. Only sums over rows and residues per prime reach the driver: their number depends on the
vectors' length, not on the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import table

#: What an entry c becomes: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows multiplied at once; with limbs of LIMB bits their sums of products stay below 2 ** 53.
STRIP, LIMB = 4096, 20
#: Bits of the limbs in which sums travel, and of the primes.
WORD, PRIME_BITS = 31, 31
#: Roots are sharpened to this many bits beyond their own first one.
ROOT_BITS = 110


# ---- exact sums ------------------------------------------------------------------------------


def _matrix(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows floor(SCALE * c) as integers; the offset changes no covariance and is added where it shows."""
    return np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), d)).astype(np.int64)


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """Signed limbs of LIMB bits as doubles; as many as the values need."""
    sign, rest, out = np.sign(values), np.abs(values), []
    while rest.any() or not out:
        out.append((sign * (rest & ((1 << LIMB) - 1))).astype(np.float64))
        rest = rest >> LIMB
    return out


def exact_products(values: np.ndarray) -> np.ndarray:
    """The sum of products of every two columns, as Python integers."""
    d = values.shape[1]
    total = np.zeros((d, d), object)
    for k in range(0, len(values), STRIP):
        limbs = _limbs(values[k : k + STRIP])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _words(values: list[int]) -> Iterator[tuple[int, list[int]]]:
    """Signed words of WORD bits of a list of integers: (number of the word, that word of each)."""
    word = 0
    while word == 0 or any(values):
        yield word, [(abs(v) & ((1 << WORD) - 1)) * (1 if v > 0 else -1) for v in values]
        values = [(abs(v) >> WORD) * (1 if v > 0 else -1) for v in values]
        word += 1


@dataclass(frozen=True)
class Scatter:
    """Exact statistics of all vectors of one length: n, sums and n * sum(y y') - sum(y) sum(y)', without offset."""

    n: int
    sums: tuple[int, ...]
    matrix: tuple[tuple[int, ...], ...]


def scatters(rows: DataFrame) -> dict[int, Scatter]:
    """The statistics of `rows` (vec array<double>, all entries fit) for each length of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}
        for batch in batches:
            vectors = batch.column("vec")
            size = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(size).tolist():
                values = _matrix(vectors.take(pa.array(np.flatnonzero(size == d))) if (size != d).any() else vectors, d)
                own = known.setdefault(d, [0, np.zeros(d, object), np.zeros((d, d), object)])
                own[0] += len(values)
                for k in range(0, len(values), STRIP):
                    high = values[k : k + STRIP] >> 32
                    own[1] += (high.sum(0).astype(object) << 32) + (values[k : k + STRIP] - (high << 32)).sum(0)
                own[2] += exact_products(values)
        for d, (n, sums, products) in known.items():
            lines = [(-2, [n]), (-1, sums.tolist()), *enumerate(products.tolist())]
            out = [(d, line, word, part) for line, values in lines for word, part in _words(values)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())))], names=["d", "line", "word", "part"]
            )

    parts = rows.select("vec").mapInArrow(run, "d int, line int, word int, part array<long>")
    total = parts.select("d", "line", "word", F.posexplode("part").alias("at", "v")).groupBy("d", "line", "word", "at").agg(F.sum("v").alias("v"))
    found: dict[int, dict] = {}
    for r in total.toArrow().to_pylist():
        cell = found.setdefault(r["d"], {})
        cell[r["line"], r["at"]] = cell.get((r["line"], r["at"]), 0) + (r["v"] << (WORD * r["word"]))
    out = {}
    for d, cell in found.items():
        n, sums = cell[-2, 0], tuple(cell[-1, j] for j in range(d))
        out[d] = Scatter(n, sums, tuple(tuple(n * cell[i, j] - sums[i] * sums[j] for j in range(d)) for i in range(d)))
    return out


# ---- the characteristic polynomial -----------------------------------------------------------


def _is_prime(p: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2 ** 32."""
    if p < 2 or any(p % q == 0 for q in (2, 3, 5, 7) if p != q):
        return p in (2, 3, 5, 7)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if base % p == 0 or x in (1, p - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes(bits: float) -> list[int]:
    """The greatest primes of PRIME_BITS bits whose product has more than `bits` bits."""
    out, p = [], (1 << PRIME_BITS) - 1
    while bits >= 0:
        if _is_prime(p):
            out.append(p)
            bits -= log2(p)
        p -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant one first, of det(x - matrix) modulo p. Similarity steps bring the matrix to Hessenberg form,
    whose leading blocks give the polynomial by recurrence."""
    h, d = matrix % p, len(matrix)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        ratio = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - ratio[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * ratio % p).sum(1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(d):
        # product of the subdiagonal from column i to k, for every i
        chain, weight = 1, np.zeros(k + 1, np.int64)
        for i in range(k, -1, -1):
            weight[i] = h[i, k] * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else chain
        poly[k + 1, 1:] = poly[k, :-1]
        poly[k + 1] = (poly[k + 1] - (weight[:, None] * poly[: k + 1] % p).sum(0)) % p
    return poly[d]


def characteristic_polynomial(spark: SparkSession, matrix) -> list[int]:
    """Exact coefficients, constant one first, of det(x - matrix) for a symmetric matrix of integers without negative
    roots: modulo one prime per row of a table, then by Chinese remaindering."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # Sums of products of roots are greatest where all roots are equal.
    moduli = primes(d * log2(2 + -(-trace // d)) + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for p in batch.column("p").to_pylist():
                found.append(polynomial_mod(np.array([[v % p for v in line] for line in matrix], np.int64), p).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(moduli), 2 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    residues = {r["p"]: r["c"] for r in dealt.mapInArrow(run, "p long, c array<long>").toArrow().to_pylist()}
    value, modulus = [0] * (d + 1), 1
    for p in moduli:
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((c - v) * inverse % p) for v, c in zip(value, residues[p], strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


# ---- roots -----------------------------------------------------------------------------------


def _scaled(poly: list[int], k: int) -> list[int]:
    """2 ** (k d) p(x / 2 ** k)."""
    d = len(poly) - 1
    return [c << (k * (d - i)) for i, c in enumerate(poly)]


def _beyond(poly: list[int], at: int) -> int:
    """Roots greater than `at`, each as often as it occurs; all roots of `poly` are real (the rule of signs is exact then)."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def greatest_roots(poly: list[int], wanted: int, limit: int) -> list[tuple[int, int, int]]:
    """(numerator, k, multiplicity) of the greatest positive roots, numerator / 2 ** k within 2 ** -ROOT_BITS of each, relative to
    it, until `wanted` of them are covered; roots closer than that count as one. All lie at or below `limit`."""
    zero = next(i for i, c in enumerate(poly) if c)
    poly = poly[zero:]
    out, covered = [], 0
    wanted = min(wanted, len(poly) - 1)
    # As many roots lie beyond `start` / 2 ** k as are covered.
    start, k = limit + 1, 0
    while covered < wanted:
        low, high, many = 0, start, len(poly) - 1
        scaled = _scaled(poly, k)
        # Roots number `covered` + 1 to `many` lie in (low, high].
        while (many - covered != 1 or low == 0) and (low == 0 or (high - low) << ROOT_BITS > low):
            if high - low == 1:
                low, high, k = 2 * low, 2 * high, k + 1
                scaled = _scaled(poly, k)
            middle = (low + high) // 2
            n = _beyond(scaled, middle)
            if n > covered:
                low, many = middle, n
            else:
                high = middle
        start, at = low, k
        if many - covered == 1:
            more = max(0, ROOT_BITS + 1 - (low.bit_length() - 1))
            low, high, at = low << more, high << more, k + more
            scaled = _scaled(poly, at)
            # Beyond the greatest root the polynomial is positive; each root passed turns its sign.
            above = covered % 2 == 0
            while (high - low) << ROOT_BITS > low and high - low > 1:
                middle = (low + high) // 2
                v = _value(scaled, middle)
                if v == 0:
                    low = high = middle
                elif (v > 0) == above:
                    high = middle
                else:
                    low = middle
        out.append((high, at, many - covered))
        covered = many
    return out


# ---- components ------------------------------------------------------------------------------


def _factor(matrix: list[list[Decimal]], tiny: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    """Rows of the triangular factors, pivots by size; a pivot of nothing is replaced by `tiny`."""
    a, order = [list(r) for r in matrix], list(range(len(matrix)))
    for k in range(len(a)):
        best = max(range(k, len(a)), key=lambda i: abs(a[i][k]))
        a[k], a[best] = a[best], a[k]
        order[k], order[best] = order[best], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        top = a[k]
        for row in a[k + 1 :]:
            if row[k]:
                ratio = row[k] = row[k] / top[k]
                row[k + 1 :] = [x - ratio * y for x, y in zip(row[k + 1 :], top[k + 1 :], strict=True)]
    return a, order


def _solve(factors, b: list[Decimal]) -> list[Decimal]:
    a, order = factors
    x = [b[i] for i in order]
    for k in range(len(a)):
        x[k] -= sum((u * v for u, v in zip(a[k][:k], x[:k], strict=True)), Decimal(0))
    for k in reversed(range(len(a))):
        x[k] = (x[k] - sum((u * v for u, v in zip(a[k][k + 1 :], x[k + 1 :], strict=True)), Decimal(0))) / a[k][k]
    return x


def _orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
    out: list[list[Decimal]] = []
    for v in vectors:
        for _ in range(2):
            for u in out:
                along = sum((x * y for x, y in zip(u, v, strict=True)), Decimal(0))
                v = [y - along * x for x, y in zip(u, v, strict=True)]
            length = sum((x * x for x in v), Decimal(0)).sqrt()
            v = [x / length for x in v]
        out.append(v)
    return out


def null_vectors(matrix, root: Decimal, count: int, rounds: int = 3) -> list[list[Decimal]]:
    """`count` orthonormal vectors that matrix - root takes to nearly nothing: inverse iteration from fixed starts."""
    d = len(matrix)
    moved = [[Decimal(v) - (root if i == j else 0) for j, v in enumerate(line)] for i, line in enumerate(matrix)]
    greatest = max((abs(v) for line in moved for v in line), default=Decimal(1)) or Decimal(1)
    factors = _factor(moved, greatest.scaleb(-(ROOT_BITS * 3 // 10)))
    vectors = _orthonormal([[Decimal(1 + (7 * i * i + (3 * i + 1) * (5 * c + 1)) % 101 + (13 if i % count == c else 0)) for i in range(d)] for c in range(count)])
    for _ in range(rounds):
        vectors = _orthonormal([_solve(factors, v) for v in vectors])
    return vectors


@dataclass(frozen=True)
class Whitening:
    """Everything a row needs: sums without offset, components as columns, and the eigenvalues of the covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whitening(spark: SparkSession, scatter: Scatter, components: int = COMPONENTS) -> Whitening:
    """Components with positive eigenvalues, greatest first, at most `components`."""
    d = len(scatter.sums)
    trace = sum(scatter.matrix[i][i] for i in range(d))
    vectors, values, shares = [], [], []
    if trace:
        poly = characteristic_polynomial(spark, scatter.matrix)
        digits = len(str(trace)) + ROOT_BITS * 3 // 5 + 20
        with localcontext(Context(prec=digits)):
            square = Decimal(scatter.n) ** 2
            for numerator, k, times in greatest_roots(poly, components, trace):
                root = Decimal(numerator) / Decimal(2) ** k
                for v in null_vectors(scatter.matrix, root, times):
                    lead = max(v, key=abs)
                    vectors.append([float(x if lead > 0 else -x) for x in v])
                    values.append(float(root / square))
                    shares.append(float(root / Decimal(trace)))
    kept = slice(0, components)
    return Whitening(scatter.n, scatter.sums, np.array(vectors[kept], float).reshape(len(vectors[kept]), d).T, np.array(values[kept]), np.array(shares[kept]))


ROWS = "key long, d int, n long, deviation long, deviation_exact decimal(38,0), whitened array<double>, explained array<double>"


def _whitened(rows: DataFrame, found: dict[int, Whitening]) -> DataFrame:
    def deviations(values: np.ndarray, w: Whitening) -> tuple[np.ndarray, list[int]]:
        """n * x - S in doubles, each correctly rounded, and the exact sums of its squares."""
        most = max(int(values.max(initial=0)), -int(values.min(initial=0))) * w.n + max((abs(s) for s in w.sums), default=0)
        if most < 1 << 62:
            moved = w.n * values - np.array(w.sums, np.int64)
        else:
            moved = w.n * values.astype(object) - np.array(w.sums, object)
        squares = moved * moved if most * most * max(1, len(w.sums)) < 1 << 63 else moved.astype(object) ** 2
        return moved.astype(np.float64), squares.sum(1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vec")
            size = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(size).tolist():
                at, w = np.flatnonzero(size == d), found[d]
                for k in range(0, len(at), STRIP):
                    part = pa.array(at[k : k + STRIP])
                    moved, squares = deviations(_matrix(vectors.take(part), d), w)
                    white = (moved / w.n) @ w.components / np.sqrt(w.eigenvalues)
                    ends = pa.array(np.arange(len(part) + 1) * len(w.explained), pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (white, np.tile(w.explained, (len(part), 1)))]
                    exact = pa.array(squares if all(s < 10**38 for s in squares) else [s if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(part), pa.array([d] * len(part), pa.int32()), pa.array([w.n] * len(part), pa.int64()),
                            pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()), exact, *lists,
                        ],
                        names=["key", "d", "n", "deviation", "deviation_exact", "whitened", "explained"],
                    )

    return rows.mapInArrow(run, ROWS)


def identity_errors(rows: DataFrame, found: dict[int, Whitening]) -> dict[int, float]:
    """For each length: the greatest absolute entry of the whitened rows' covariance, centred, less the identity."""
    width = max((len(w.explained) for w in found.values()), default=0)
    if not width:
        return {}
    w = [F.get("whitened", i) for i in range(width)]
    means = {r["d"]: r for r in rows.groupBy("d").agg(*(F.avg(x).alias(f"m{i}") for i, x in enumerate(w))).collect()}
    lengths = sorted(means)
    mean = [F.coalesce(*(F.when(F.col("d") == d, F.lit(means[d][f"m{i}"])) for d in lengths)) for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    centred = rows.select("d", *((x - m).alias(f"c{i}") for i, (x, m) in enumerate(zip(w, mean, strict=True))))
    sums = centred.groupBy("d").agg(*(F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"v{i}_{j}") for i, j in pairs)).collect()
    return {r["d"]: max((abs(r[f"v{i}_{j}"] - (i == j)) for i, j in pairs if r[f"v{i}_{j}"] is not None), default=0.0) for r in sums}


def whiten(embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n, deviation, whitened, explained, identity_error, deviation_exact) for every row that remains; `whitened` and
    `explained` are arrays with an entry per component, greatest eigenvalue first.

    Rows go whose vector is null, holds null or non-finite entries, or an entry too great for a long. Vectors of different lengths are
    spaces of their own, each with its own statistics. Components of eigenvalue 0 are left out: equal rows, a single row and vectors
    without entries have empty arrays. Close eigenvalues (2 ** -110 apart, relatively) share a space whose basis is fixed but arbitrary.
    `deviation` is null where it does not fit a long, `deviation_exact` beyond 38 digits. Repeated rows count as often as they occur,
    null keys stay null. A table without rows gives one without rows. Other columns are not read."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vec"))
    fits = F.forall("vec", lambda c: F.coalesce(F.abs(c) < float(1 << 52), F.lit(False)))
    rows = rows.where(F.coalesce(fits, F.lit(False)))
    found = {d: whitening(spark, s, components) for d, s in sorted(scatters(rows).items())}
    white = table(_whitened(rows, found), "whitened")
    errors = identity_errors(white, found)
    error = F.coalesce(*(F.when(F.col("d") == d, F.lit(e)) for d, e in errors.items()), F.lit(0.0)) if errors else F.lit(0.0)
    return white.select(F.col("key").alias(key), "n", "deviation", "whitened", "explained", error.alias("identity_error"), "deviation_exact")


def by_component(white: DataFrame, key: str = "vec_id") -> DataFrame:
    """A row per row of `whiten` and component, numbered from 1."""
    each = F.arrays_zip("whitened", "explained")
    parts = white.select(key, "n", "deviation", "identity_error", "deviation_exact", F.posexplode(each).alias("at", "part"))
    return parts.select(key, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("part.whitened"), F.col("part.explained"), "identity_error", "deviation_exact")
