"""Whitening of embeddings by the leading eigenvectors of their covariance.

1. Per-dimension sums of the quantised vectors, exact, added map-side.
2. Covariance of the centred vectors: every task multiplies its own rows, and
   the partial matrices are added row by row of the matrix, as a stream.
3. On the driver, for a matrix of the vectors' length (never of the rows):
   Householder reflections make it tridiagonal, Sturm counts bisect the leading
   eigenvalues, inverse iteration gives their vectors, and vectors of close
   eigenvalues are made orthogonal to each other while they are iterated.
4. The components are broadcast and every row is projected; a pass over the
   projections measures how far their covariance is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import lean

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond this do not become a long (64 c + 1,000,000).
LARGEST = 2.0 ** 56
_EPS = np.finfo(float).eps
_EXACT = 2 ** 62


# ------------------------------------------------------- eigenvectors (driver)
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix by Householder
    reflections; reflector i acts on the coordinates from i + 1 on."""
    a = np.array(v, dtype=float)
    d = len(a)
    off, reflectors = np.zeros(max(0, d - 1)), []
    for i in range(d - 1):
        x = a[i + 1:, i]
        size = np.abs(x).max()
        u = x / size if size else np.zeros_like(x)           # scaled, so that squares neither vanish nor overflow
        norm = np.linalg.norm(u)
        if norm == 0 or np.abs(x[1:]).max(initial=0) == 0:
            off[i] = x[0]
            reflectors.append(np.zeros_like(x))
            continue
        alpha = -np.copysign(norm, u[0])
        off[i] = alpha * size
        u[0] -= alpha
        u /= np.linalg.norm(u)
        p = a[i + 1:, i + 1:] @ u
        w = 2 * (p - (u @ p) * u)
        a[i + 1:, i + 1:] -= np.outer(u, w) + np.outer(w, u)
        reflectors.append(u)
    return np.diag(a).copy(), off, reflectors


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``."""
    tiny = _EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    q = diag[0] - at
    below = (q < 0).astype(int)
    for a, b in zip(diag[1:], off):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = a - at - b * (b / q)
        below += q < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected to the last bits."""
    d = len(diag)
    r = np.zeros(d)
    r[:-1] += np.abs(off)
    r[1:] += np.abs(off)
    reach = max(np.abs(diag - r).max(), np.abs(diag + r).max())
    want = d - np.arange(1, k + 1)                            # eigenvalues below the i-th largest
    lo, hi = np.full(k, (diag - r).min() - _EPS * reach), np.full(k, (diag + r).max() + _EPS * reach)
    while True:
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi) & (hi - lo > 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if not open_.any():
            return mid
        above = sturm_counts(diag, off, mid) <= want          # the i-th largest is not below mid
        lo, hi = np.where(open_ & above, mid, lo), np.where(open_ & ~above, mid, hi)


def _solver(diag: np.ndarray, off: np.ndarray, shift: float):
    """Solves (T - shift) x = b by Gaussian elimination with row exchanges."""
    d = len(diag)
    tiny = _EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    up0, up1, up2 = diag - shift, np.append(off, 0.0), np.zeros(d)
    mult, swap = np.zeros(d), np.zeros(d, dtype=bool)
    for i in range(d - 1):
        low, here, right = off[i], diag[i + 1] - shift, up1[i + 1]
        if abs(low) > abs(up0[i]):
            swap[i], mult[i] = True, up0[i] / low
            up0[i], old = low, up1[i]
            up1[i], up2[i] = here, right
            up0[i + 1], up1[i + 1] = old - mult[i] * here, -mult[i] * right
        else:
            mult[i] = low / up0[i] if up0[i] else 0.0
            up0[i + 1] = here - mult[i] * up1[i]
    up0 = np.where(np.abs(up0) < tiny, tiny, up0)

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(d - 1):
            if swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= mult[i] * x[i]
        for i in range(d - 1, -1, -1):
            rest = (up1[i] * x[i + 1] if i + 1 < d else 0.0) + (up2[i] * x[i + 2] if i + 2 < d else 0.0)
            x[i] = (x[i] - rest) / up0[i]
            if abs(x[i]) > 1e150:                             # a near singular matrix: only the direction counts
                x /= abs(x[i])
        return x
    return solve


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix for falling ``values``.
    A vector is kept orthogonal to those of its cluster: eigenvalues that follow
    each other closer than a thousandth of the matrix's norm."""
    d = len(diag)
    norm = np.abs(diag).max() + 2 * np.abs(off).max(initial=0)
    rnd = np.random.default_rng(7)
    out, first = np.zeros((len(values), d)), 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            first = i
        cluster = out[first:i]
        solve, x = _solver(diag, off, value), rnd.standard_normal(d)
        for _ in range(5):
            for _ in range(2):
                x = x - cluster.T @ (cluster @ x)
            size = np.linalg.norm(x)
            x = solve(x / size if size else rnd.standard_normal(d))
            x /= np.abs(x).max()
        for _ in range(2):
            x = x - cluster.T @ (cluster @ x)
            x /= np.linalg.norm(x)
        out[i] = x
    return out


def leading_components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as rows) of a covariance: at most the ``k``
    largest, those above rounding (length of the vectors times 16 units in the
    last place of the largest)."""
    d = len(v)
    if not d or not np.abs(v).max():
        return np.zeros(0), np.zeros((0, d))
    diag, off, reflectors = tridiagonal(v)
    values = leading_eigenvalues(diag, off, min(k, d))
    values = values[values > 16 * d * _EPS * values[0]]
    q = inverse_iteration(diag, off, values).T
    for i in range(len(reflectors) - 1, -1, -1):
        u = reflectors[i]
        q[i + 1:] -= 2 * np.outer(u, u @ q[i + 1:])
    return values, (q / np.linalg.norm(q, axis=0)).T


# ------------------------------------------------------------ passes over rows
def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    ok = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(LARGEST)))
    return df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(ok)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The batch's quantised vectors, less the shift: floor(64 c) as int64."""
    col = batch.column("v")
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(batch), d)


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """(rows, exact sums of floor(64 c) per dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for b in batches:
            x = _matrix(b, d)
            n += len(x)
            if len(x) * int(np.abs(x).max(initial=0)) < _EXACT:
                s = [a + int(c) for a, c in zip(s, x.sum(0))]
            else:
                s = [a + sum(map(int, c)) for a, c in zip(s, x.T)]
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(-1, d), pa.int32()),
                                              "s": pa.array([str(a) for a in (n, *s)])})

    parts = rows.select("v").mapInArrow(run, "dim int, s string")
    got = parts.groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()     # one row per dimension
    total = {r["dim"]: int(r["s"]) for r in got}
    return total.get(-1, 0), [total.get(i, 0) for i in range(d)]


def _gram(rows: DataFrame, make, d: int, width: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``make(batch)`` (rows of ``width``)."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            y = make(_matrix(b, d))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            with lean():
                for i in range(0, width, 256):
                    some = total[i:i + 256]
                    yield pa.RecordBatch.from_arrays([pa.array(range(i, i + len(some)), pa.int32()),
                                                      pa.array([r.tobytes() for r in some], pa.binary())], names=["i", "r"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}                       # rows of one matrix: width x width at most
        for b in batches:
            for i, r in zip(b.column("i").to_pylist(), b.column("r")):
                part = np.frombuffer(r.as_buffer(), dtype=float)
                if i in acc:
                    acc[i] += part
                else:
                    acc[i] = part.copy()
        if acc:
            yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int32()), pa.array([r.tobytes() for r in acc.values()], pa.binary())],
                                             names=["i", "r"])

    parts = rows.select("v").mapInArrow(multiply, "i int, r binary")
    out = np.zeros((width, width))
    for r in parts.repartition("i").mapInArrow(add, "i int, r binary").collect():        # width rows
        out[r["i"]] += np.frombuffer(bytes(r["r"]), dtype=float)
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (n x - S)^2; None beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < _EXACT and x.shape[1] * most ** 2 < _EXACT:
        y = n * x - np.array(sums, dtype=np.int64)
        return (y * y).sum(1).tolist()
    if most < _EXACT:
        y = n * x - np.array(sums, dtype=np.int64)
        if x.shape[1] * int(np.abs(y).max(initial=0)) ** 2 < _EXACT:
            return (y * y).sum(1).tolist()
    out = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    return [v if v < 2 ** 63 else None for v in out]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    An entry c counts as x = floor(64 c) + 1,000,000. Covariances are over all
    vectors that take part, with divisor n. Rows without a vector, or with a
    null, non-finite or huge (2^56) entry take no part; where lengths differ,
    the commonest takes part (of ties the longest). Components whose eigenvalue
    is not above rounding are left out, so that equal vectors, a single one, or
    an empty table give no rows. ``deviation`` is exact, null beyond a long.
    Repeated ids and null ids are rows like others; other columns are ignored.
    """
    spark = df.sparkSession
    rows = _vectors(df, id_col, vec_col)
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if top is None or not top["d"]:
        return spark.createDataFrame([], schema)
    d = top["d"]
    rows = rows.filter(F.size("v") == d)
    n, sums = _sums(rows, d)
    base = np.array([s // n for s in sums], dtype=np.int64)   # whole part of the mean: differences to it are exact
    rest = np.array([(s - n * (s // n)) / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base).astype(float) - rest

    cov = _gram(rows, centred, d, d) / n
    values, q = leading_components(cov, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    project = spark.sparkContext.broadcast((q / np.sqrt(values)[:, None]).T)      # vector length x components
    error = float(np.abs(_gram(rows, lambda x: centred(x) @ project.value, d, len(values)) / n - np.eye(len(values))).max())
    explained = values / np.trace(cov)
    k = len(values)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 2048):
                part = b.slice(at, 2048)
                x = _matrix(part, d)
                m = len(part)
                dev = pa.array(_deviations(x, n, sums), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     dev.take(each), pa.array((centred(x) @ project.value).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(emit, schema)
