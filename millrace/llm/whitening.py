"""Whitening from the exact characteristic polynomial of the integer scatter.

1. Tasks add up integer moments of the vectors; ``n * sum(x x') - s s'`` is the scatter, n squared times the
   covariance, without any rounding.
2. Its characteristic polynomial is found modulo many primes (similarity to Hessenberg form, then the
   recurrence over leading blocks), one task per few primes, and put together by Chinese remaindering.
3. All roots are real, so the sign changes of the polynomial shifted by ``a`` count the roots above ``a`` with
   their multiplicities: bisection on that count isolates the largest roots to ``ROOT_BITS`` bits.
4. Inverse iteration in long decimals gives the null space of scatter minus root: the components. Roots that
   bisection can't tell apart share one block of vectors, kept orthogonal.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_schema
from millrace.llm.pivot_search import usable

ROOT_BITS = 120     # of a root, below the trace
DIGITS = 110        # of the decimals in inverse iteration
LARGEST = 1 << 40   # components beyond raise: their squares must add up within 38 digits
MAX_CELLS = 1 << 24  # of all scatter matrices (one per vector length), which the driver holds

MOMENT = "dim int, i int, j int, value decimal(38,0)"
RESIDUE = "dim int, prime bigint, residues array<bigint>"
SPREAD = "dim int, i int, j int, value double"
WHITE = ("vec_id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), "
         "whitened double, explained double")
COUNT, TOTAL, HIGHEST = -1, -2, -3  # rows of a moment table beside the products


def integers(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """vec_id, dim and x: ``floor(scale * c) + shift`` of every component."""
    def entry(c):
        y = c.cast("double") * scale
        return F.when(F.abs(y) < LARGEST, F.floor(y)).otherwise(
            F.raise_error(F.lit(f"a component times {scale} reaches {LARGEST}")).cast("bigint")) + shift

    return (vectors.filter(usable("embedding"))
            .select(F.col("vec_id").cast("bigint"), F.size("embedding").alias("dim"),
                    F.transform("embedding", entry).alias("x")))


def by_length(batch: pa.RecordBatch):
    """(length, places in the batch, matrix of integers) per vector length of a batch."""
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        places = np.flatnonzero(dims == dim)
        rows = batch["x"].take(pa.array(places))
        yield dim, places, rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exact_product(y: np.ndarray) -> np.ndarray:
    """``y' y`` as Python integers; in doubles where all sums are whole numbers below 2^53."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, len(y)) < 1 << 53:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def moments(rows: DataFrame, shift: int) -> dict[int, tuple[int, int, np.ndarray, np.ndarray]]:
    """Per length: n, the largest absolute x - shift, sums and sums of products of x - shift, as integers."""
    schema = arrow_schema(rows.sparkSession, MOMENT)

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in by_length(batch):
                y = x - shift
                new = [len(y), int(np.abs(y).max()), y.sum(0).astype(object), exact_product(y)]
                old = held.get(dim)
                held[dim] = new if old is None else [old[0] + new[0], max(old[1], new[1]), old[2] + new[2], old[3] + new[3]]
        for dim, (n, top, total, product) in held.items():
            a, b = np.triu_indices(dim)
            i = np.r_[COUNT, HIGHEST, np.full(dim, TOTAL), a]
            j = np.r_[0, 0, np.arange(dim), b]
            values = [Decimal(v) for v in (n, top, *total.tolist(), *product[a, b].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(values, pa.decimal128(38, 0))], schema=schema)

    lengths = [r["dim"] for r in rows.select("dim").distinct().collect()]
    if sum(dim * dim for dim in lengths) > MAX_CELLS:
        raise ValueError(f"the scatters of {len(lengths)} vector lengths have over {MAX_CELLS} cells")
    summed = rows.select("dim", "x").mapInArrow(run, MOMENT).groupBy("dim", "i", "j").agg(
        F.when(F.col("i") == HIGHEST, F.max("value")).otherwise(F.sum("value")).alias("value"))
    found = {dim: [0, 0, np.zeros(dim, object), np.zeros((dim, dim), object)] for dim in lengths}
    for dim, i, j, value in summed.collect():
        value, one = int(value), found[dim]
        if i == COUNT:
            one[0] = value
        elif i == HIGHEST:
            one[1] = value
        elif i == TOTAL:
            one[2][j] = value
        else:
            one[3][i, j] = one[3][j, i] = value
    return {dim: tuple(one) for dim, one in found.items()}


def primes_below(limit: int, product: int) -> list[int]:
    """The largest primes below ``limit`` (2^31 at most) whose product exceeds ``product``."""
    def is_prime(p: int) -> bool:  # deterministic for 32 bits
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x in (1, p - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    found, reached, p = [], 1, limit - 1 + limit % 2
    while reached <= product:
        if is_prime(p):
            found.append(p)
            reached *= p
        p -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo p with zeros below the first subdiagonal."""
    a = a.copy()
    for m in range(1, len(a) - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            a[[pivot, m]] = a[[m, pivot]]
            a[:, [pivot, m]] = a[:, [m, pivot]]
        factor = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - factor[:, None] * a[m]) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * factor % p).sum(1)) % p
    return a


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo p < 2^31, constant first."""
    h = hessenberg((matrix % p).astype(np.int64), p)
    n = len(h)
    leading = np.zeros((n + 1, n + 1), np.int64)
    leading[0, 0] = 1
    for k in range(1, n + 1):
        new = np.roll(leading[k - 1], 1)
        new = (new - h[k - 1, k - 1] * leading[k - 1]) % p
        chain = 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if not chain:
                break
            new = (new - chain * int(h[i - 1, k - 1]) % p * leading[i - 1]) % p
        leading[k] = new
    return leading[n]


def polynomials(spark, scatters: dict[int, np.ndarray]) -> dict[int, list[int]]:
    """Characteristic polynomials, constant first: residues from Spark tasks, joined by remainders."""
    chosen, rows = {}, []
    for dim, scatter in scatters.items():
        trace = sum(scatter[i, i] for i in range(dim))
        # No root is negative, so a coefficient is at most that of dim equal roots with this trace.
        mean = -(-trace // dim)
        bound = max(comb(dim, k) * mean ** k for k in range(dim + 1))
        chosen[dim] = primes_below(1 << 31, bound)
        rows += [(dim, p) for p in chosen[dim]]
    schema = arrow_schema(spark, RESIDUE)
    shared = spark.sparkContext.broadcast(scatters)

    def run(batches):
        for batch in batches:
            for dim, p in zip(*(batch[c].to_pylist() for c in ("dim", "prime"))):
                residues = polynomial_modulo(shared.value[dim], p).tolist()
                yield pa.RecordBatch.from_pylist([{"dim": dim, "prime": p, "residues": residues}], schema=schema)

    tasks = spark.createDataFrame(rows, "dim int, prime bigint").repartition(max(1, len(rows) // 8))
    residues = {(r["dim"], r["prime"]): r["residues"] for r in tasks.mapInArrow(run, RESIDUE).collect()}
    shared.unpersist()
    out = {}
    for dim, primes in chosen.items():
        whole = 1
        for p in primes:
            whole *= p
        weights = [whole // p * pow(whole // p, -1, p) for p in primes]
        out[dim] = []
        for k in range(dim + 1):
            value = sum(residues[dim, p][k] * w for p, w in zip(primes, weights)) % whole
            # Signs alternate; only the size is bounded by the product.
            out[dim].append(value if (dim - k) % 2 == 0 or value == 0 else value - whole)
    return out


def roots_above(polynomial: list[int], at: int) -> int:
    """How many roots are larger than ``at``; exact, as all roots are real."""
    c = polynomial[::-1]
    shifted = []
    while c:  # one Horner pass gives the next coefficient of the shifted polynomial
        for i in range(1, len(c)):
            c[i] += c[i - 1] * at
        shifted.append(c.pop())
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], trace: int, wanted: int, bits: int = ROOT_BITS) -> tuple[list[int], int]:
    """The ``wanted`` largest positive roots, as integers times 2^-s: each the upper end of an interval of
    length 2^-s that holds it. s makes the trace ``bits`` long. Equal integers can't be told apart."""
    s = max(0, bits - trace.bit_length())
    degree = len(polynomial) - 1
    scaled = [c << (s * (degree - k)) for k, c in enumerate(polynomial)]
    known: dict[int, int] = {}

    def above(at: int) -> int:
        if at not in known:
            known[at] = roots_above(scaled, at)
        return known[at]

    roots = []
    for nth in range(1, min(wanted, above(0)) + 1):
        low, high = 0, trace << s
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= nth else (low, middle)
        roots.append(high)
    return roots, s


def null_space(scatter: np.ndarray, root: int, s: int, vectors: int) -> list[list[Decimal]]:
    """Orthonormal vectors v with ``scatter v = root v``: inverse iteration by one elimination."""
    n = len(scatter)
    with localcontext() as context:
        context.prec = DIGITS
        unit = Decimal(max(1, sum(int(scatter[i, i]) for i in range(n))))
        value = Decimal(root) / (1 << s)
        rows = [[(Decimal(int(v)) - (value if i == j else 0)) / unit for j, v in enumerate(row)]
                for i, row in enumerate(scatter)]
        tiny = Decimal(10) ** (-DIGITS + 10)
        order = list(range(n))
        for k in range(n):
            pivot = max(range(k, n), key=lambda i: abs(rows[i][k]))
            rows[k], rows[pivot] = rows[pivot], rows[k]
            order[k], order[pivot] = order[pivot], order[k]
            top = rows[k]
            if abs(top[k]) < tiny:
                top[k] = tiny
            for i in range(k + 1, n):
                row = rows[i]
                f = row[k] / top[k]
                row[k] = f  # kept below the diagonal, and moved along with later exchanges
                if f:
                    for j in range(k + 1, n):
                        row[j] -= f * top[j]

        def solve(b):
            y = [b[i] for i in order]
            for i in range(n):
                row = rows[i]
                y[i] -= sum((row[j] * y[j] for j in range(i)), Decimal(0))
            for i in reversed(range(n)):
                row = rows[i]
                y[i] = (y[i] - sum((row[j] * y[j] for j in range(i + 1, n)), Decimal(0))) / row[i]
            return y

        def orthonormal(block):
            done = []
            for v in block:
                for _ in range(2):
                    for u in done:
                        along = sum(a * b for a, b in zip(u, v))
                        v = [a - along * b for a, b in zip(v, u)]
                    length = sum(a * a for a in v).sqrt()
                    v = [a / length for a in v]
                done.append(v)
            return done

        start = np.random.default_rng(11).standard_normal((vectors, n))
        block = orthonormal([[Decimal(float(x)) for x in row] for row in start])
        for _ in range(3):
            block = orthonormal([solve(v) for v in block])
        return block


class Model:
    """Components of one vector length: sums, roots and unit vectors, as doubles where rows need them."""

    def __init__(self, n: int, top: int, total: np.ndarray, scatter: np.ndarray, polynomial: list[int], wanted: int):
        dim = len(scatter)
        trace = int(sum(scatter[i, i] for i in range(dim)))
        self.n, self.top, self.total, self.dim = n, top, total, dim
        roots, s = largest_roots(polynomial, trace, wanted)
        vectors = []
        for root in dict.fromkeys(roots):
            vectors += null_space(scatter, root, s, roots.count(root))
        self.roots = [float(Decimal(r) / (1 << s)) for r in roots]
        self.explained = [float(Decimal(r) / (1 << s) / trace) for r in roots]
        v = np.array([[float(x) for x in row] for row in vectors]).reshape(len(roots), dim)
        # One sign for all rows: the largest entry of a component is positive.
        signs = np.sign(v[np.arange(len(v)), np.abs(v).argmax(1)]) if len(v) else np.ones(0)
        self.components = v * signs[:, None]

    def centred(self, y: np.ndarray) -> np.ndarray:
        """``n * y - total`` as exact integers."""
        if 2 * self.n * max(1, self.top) < 1 << 62:
            return self.n * y - self.total.astype(np.int64)
        return self.n * y.astype(object) - self.total

    def deviations(self, t: np.ndarray) -> list[int]:
        if t.dtype != object and (2 * self.n * max(1, self.top)) ** 2 * self.dim < 1 << 63:
            return (t * t).sum(1).tolist()
        t = t.astype(object)
        return (t * t).sum(1).tolist()

    def whitened(self, t: np.ndarray) -> np.ndarray:
        return t.astype(np.float64) @ self.components.T / np.sqrt(self.roots)


def fitted(rows: DataFrame, components: int, shift: int) -> dict[int, Model]:
    """One model per vector length. Covariances don't depend on ``shift``, so sums are taken without it."""
    found = moments(rows, shift)
    scatters = {dim: n * product - np.outer(total, total) for dim, (n, _, total, product) in found.items()}
    if not scatters:
        return {}
    polys = polynomials(rows.sparkSession, scatters)
    return {dim: Model(n, top, total, scatters[dim], polys[dim], components)
            for dim, (n, top, total, _) in found.items()}


def identity_error(rows: DataFrame, models, shift: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, over all lengths."""
    schema = arrow_schema(rows.sparkSession, SPREAD)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in by_length(batch):
                model = models.value[dim]
                if model.roots:
                    # The rows are centred exactly, before they are projected; the last row adds up what is left.
                    w = np.c_[model.whitened(model.centred(x - shift)), np.ones(len(x))]
                    held[dim] = held.get(dim, 0) + w.T @ w
        for dim, products in held.items():
            i, j = np.indices(products.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(products.size, dim, np.int32)), pa.array(i.ravel().astype(np.int32)),
                 pa.array(j.ravel().astype(np.int32)), pa.array(products.ravel())], schema=schema)

    sums: dict[int, dict] = {}
    for r in rows.select("dim", "x").mapInArrow(run, SPREAD).groupBy("dim", "i", "j").agg(
            F.sum("value").alias("value")).collect():
        sums.setdefault(r["dim"], {})[r["i"], r["j"]] = r["value"]
    worst = None
    for cells in sums.values():
        last = max(i for i, _ in cells)
        n = cells[last, last]
        for (i, j), value in cells.items():
            if i < last and j < last:
                covariance = value / n - cells[i, last] / n * (cells[j, last] / n)
                worst = max(worst or 0.0, abs(covariance - (i == j)))
    return worst


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact.

    ``vectors`` has vec_id and embedding. Rows whose vector is null, empty or holds null or non-finite entries
    are dropped; null ids and repeated rows take part like others. Vectors of several lengths are whitened
    length by length, each over its own n. Only components with a positive eigenvalue exist: there are fewer than
    ``components`` where the vectors span fewer dimensions, and no row at all for equal vectors or an empty
    input. Of equal eigenvalues any orthonormal components serve. ``deviation`` is null beyond 64 bits,
    ``deviation_exact`` beyond 38 digits. Entries that reach 2^40 after scaling raise an error. Meant for some
    hundred dimensions: the driver holds one scatter matrix per length, and their polynomials.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, scale, shift)
    models = spark.sparkContext.broadcast(fitted(rows, components, shift))
    error = identity_error(rows, models, shift)
    schema = arrow_schema(spark, WHITE)

    def run(batches):
        for batch in batches:
            for dim, places, x in by_length(batch):
                model = models.value[dim]
                k = len(model.roots)
                if not k:
                    continue
                t = model.centred(x - shift)
                deviation, white = model.deviations(t), model.whitened(t)
                yield pa.RecordBatch.from_arrays([
                    batch["vec_id"].take(pa.array(np.repeat(places, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, model.n)),
                    pa.array([d if d < 1 << 63 else None for d in deviation for _ in range(k)], pa.int64()),
                    pa.array([Decimal(d) if d < 10 ** 38 else None for d in deviation for _ in range(k)], pa.decimal128(38, 0)),
                    pa.array(white.ravel()), pa.array(np.tile(model.explained, len(x)))], schema=schema)

    return rows.mapInArrow(run, WHITE).withColumn("identity_error", F.lit(error).cast("double"))
