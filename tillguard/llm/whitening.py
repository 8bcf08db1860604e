"""Embedding whitening by a bidiagonal qd solver.

Entries are put on an integer grid, so sums and deviations are exact.  The fit
list (each distinct grid vector once) is centred by its exact mean; every task
reduces its centred rows to one triangle by QR, block after block, and
triangles of 32 tasks at a time are reduced again until one is left.  The
driver gets that d x d triangle and nothing else: Householder reflections make
it bidiagonal, dqds finds its singular values to high relative accuracy, and
twisted factorisations of B'B - e give the directions.

Defined results: a vector that is null or holds a null or non-finite entry is
dropped, and so is one whose length is not the table's commonest (of equally
common lengths the longest); repeated rows are returned each, and count once
in the fit; a null id is returned as null; directions without variance (rank
below ``k``; a single distinct vector; an empty table) have no rows; other
columns are ignored.  Grid values, sums or deviations beyond 64 bits raise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, releasing, written

#: Grid: x = floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Triangles that one task reduces to one.
FAN_IN = 32
#: Rows of a block that is reduced at once.
BLOCK = 4096
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------- the solver

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: diagonal and superdiagonal of B = U' r V, and V."""
    a = np.array(r, np.float64)
    d = a.shape[0]
    v = np.eye(d)

    def reflector(x):
        """w of I - 2 w w' that maps x onto its first axis, or None."""
        norm = math.sqrt(float(x @ x))
        if norm == 0.0 or not x[1:].any():
            return None
        w = x.copy()
        w[0] += math.copysign(norm, x[0])
        return w / math.sqrt(float(w @ w))

    for i in range(d):
        w = reflector(a[i:, i])
        if w is not None:
            a[i:, i:] -= 2.0 * np.outer(w, w @ a[i:, i:])
        if i + 2 < d:
            w = reflector(a[i, i + 1:])
            if w is not None:
                a[i:, i + 1:] -= 2.0 * np.outer(a[i:, i + 1:] @ w, w)
                v[:, i + 1:] -= 2.0 * np.outer(v[:, i + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _step(q, e, shift):
    """One dqds transform: (q, e, least d, last d, place of a negative d)."""
    n = len(q)
    q2, e2 = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0.0:
            return q2, e2, least, d, i
        q2[i] = d + e[i]
        if q2[i] > 0.0:
            t = q[i + 1] / q2[i]
            e2[i] = e[i] * t
            d = d * t - shift
        else:  # row and column of zeros: the array splits here
            e2[i] = 0.0
            d = q[i + 1] - shift
        least = min(least, d)
    q2[n - 1] = d
    return q2, e2, least, d, n - 1 if d < 0.0 else None


def dqds(diagonal, superdiagonal) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by the
    differential qd algorithm with shifts."""
    q = [float(x) * float(x) for x in diagonal]
    e = [float(x) * float(x) for x in superdiagonal]
    tol = (100 * EPS) ** 2
    found: list[float] = []
    todo = [(q, e, 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        if not q:
            continue
        if 1.5 * q[0] < q[-1]:  # small values converge at the end
            q, e = q[::-1], e[::-1]
        least = 0.0
        for _ in range(60 * len(q) + 60):
            while len(q) > 1 and (e[-1] <= tol * (sigma + q[-1]) or e[-1] <= tol * q[-2] and q[-1] <= tol * q[-2]):
                found.append(sigma + q.pop())
                e.pop()
                least = 0.0
            n = len(q)
            if n == 1:
                found.append(sigma + q[0])
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tol * q[i] or e[i] <= tol * sigma), None)
            if cut is not None:
                todo += [(q[:cut + 1], e[:cut], sigma), (q[cut + 1:], e[cut + 1:], sigma)]
                break
            # the lower eigenvalue of the last two rows, less what binds them to the others
            x, off = q[-2] + e[-1], q[-1] * e[-1]
            big = 0.5 * (x + q[-1]) + math.sqrt(0.25 * (x - q[-1]) ** 2 + off)
            low = q[-2] * q[-1] / big if big > 0 else 0.0
            share = off / (off + (x - low) ** 2) if off > 0 else 0.0
            bind = math.sqrt(q[-2] * e[-2] * share) if n > 2 else 0.0
            shift = max(low - bind, 0.25 * least, 0.0)
            for attempt in range(4):
                if attempt == 3 or sigma + shift == sigma:
                    shift = 0.0
                q2, e2, least2, last, bad = _step(q, e, shift)
                if bad is None:
                    break
                shift = max(0.0, shift + last) if bad == n - 1 and attempt == 0 else 0.25 * shift
            q, e, least, sigma = q2, e2, max(least2, 0.0), sigma + shift
        else:
            raise ArithmeticError("the qd array does not converge")
    return np.sort(np.array(found))[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, value: float):
    """Pivots of every twisted factorisation of B'B - value, and the multipliers
    of its two halves."""
    n = len(a)
    tiny = EPS * EPS * max(float(np.max(a * a)), float(np.max(b * b)) if n > 1 else 0.0) + np.finfo(np.float64).tiny
    d = a * a
    low = np.concatenate([b / a[:-1], [0.0]])
    down, s = np.zeros(max(n - 1, 0)), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = d[i] * low[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - value
    up, p = np.zeros(max(n - 1, 0)), np.zeros(n)
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] * low[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        t = d[i] / pivot
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    return np.where(np.abs(gamma) > tiny, gamma, tiny), down, up


def _solved(k: int, down: np.ndarray, up: np.ndarray) -> np.ndarray:
    """z with N(k) z = gamma(k) e(k), z(k) = 1."""
    z = np.zeros(len(down) + 1)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, len(down)):
        z[i + 1] = -up[i] * z[i]
    return z


def vectors(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for its falling ``values``.  Values
    far enough apart get theirs from one twisted factorisation; those of a
    tight cluster from inverse iteration of a block, its inverse put together
    from all twists; near neighbours are made orthogonal."""
    a, b = np.array(diagonal, np.float64), np.array(superdiagonal, np.float64)
    n = len(a)
    scale = math.sqrt(float(np.max(a * a) + (np.max(b * b) if n > 1 else 0.0))) or 1.0
    a = np.where(np.abs(a) < EPS * EPS * scale, EPS * EPS * scale, a)
    parts = np.concatenate([[0], np.nonzero(np.abs(b) <= 8 * EPS * scale)[0] + 1, [n]])
    if len(parts) > 2:  # each part has its own values and vectors
        pairs = []
        for lo, hi in zip(parts[:-1], parts[1:]):
            own = dqds(a[lo:hi], b[lo:hi - 1])
            for x, z in zip(own, vectors(a[lo:hi], b[lo:hi - 1], own).T):
                pairs.append((x, np.concatenate([np.zeros(lo), z, np.zeros(n - hi)])))
        pairs.sort(key=lambda t: -t[0])
        return np.array([z for _, z in pairs[:len(values)]]).T
    out = np.zeros((n, len(values)))
    diag = a * a
    diag[1:] += b * b
    off = a[:-1] * b
    near = lambda i, rel: i > 0 and values[i - 1] - values[i] <= rel * values[i - 1]
    i = 0
    while i < len(values):
        j = i + 1
        while j < len(values) and near(j, 1e-10):
            j += 1
        if j - i == 1:
            gamma, down, up = _twisted(a, b, float(values[i]))
            z = _solved(int(np.argmin(np.abs(gamma))), down, up)
            out[:, i] = z / math.sqrt(float(z @ z))
        else:
            gamma, down, up = _twisted(a, b, float(values[i]) * (1 + 1e-11))  # beside the cluster, so that the inverse is sound
            inverse = np.array([_solved(k, down, up) / gamma[k] for k in range(n)]).T
            block = np.random.default_rng(i).standard_normal((n, j - i))
            for _ in range(8):
                block, _ = np.linalg.qr(inverse @ (block / np.max(np.abs(block))))
            t = diag[:, None] * block
            t[:-1] += off[:, None] * block[1:]
            t[1:] += off[:, None] * block[:-1]
            turn = np.linalg.eigh(block.T @ t)[1][:, ::-1]
            out[:, i:j] = block @ turn
        i = j
    start = 0
    for i in range(len(values)):
        start = start if near(i, 1e-3) else i
        for _ in range(2 if i > start else 0):
            out[:, i] -= out[:, start:i] @ (out[:, start:i].T @ out[:, i])
        out[:, i] /= math.sqrt(float(out[:, i] @ out[:, i]))
    return out


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of r'r and the unit vectors (columns) of the first ``k``."""
    a, b, v = bidiagonalise(r)
    values = dqds(a, b)
    z = v @ vectors(a, b, values[:k])
    sign = np.sign(z[np.argmax(np.abs(z), axis=0), np.arange(z.shape[1])])
    return values, z * sign


# ------------------------------------------------------------------- on Spark

@dataclass
class Whitening:
    """A fit: exact count and sums of the fit list, directions (columns),
    eigenvalues, their shares and the identity error of the whitened list."""
    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def grid(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that take part: x is the vector on the grid."""
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET).cast("long"))
    rows = df.filter(F.coalesce(fine, F.lit(False))).select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == F.lit(length.d if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(x: np.ndarray):
    for i in range(0, len(x), BLOCK):
        yield x[i:i + BLOCK]


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact."""
    if n * (int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) // max(n, 1) + 1) >= 1 << 63:
        raise ArithmeticError("a deviation goes beyond 64 bits")
    return x * np.int64(n) - sums


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension: one row a dimension leaves a task."""
    def run(batches):
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                if total is None:
                    total = [0] * x.shape[1]
                if (n + len(x)) * int(np.abs(x).max(initial=0)) >= 1 << 63:
                    raise ArithmeticError("a sum goes beyond 64 bits")
                total = [t + int(s) for t, s in zip(total, x.sum(axis=0))]
                n += len(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64()), pa.array([n] * len(total), pa.int64())],
                ["i", "s", "n"])

    rows = fit.select("x").mapInArrow(releasing(run), "i int, s long, n long").groupBy("i").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect()  # one row a dimension
    return (rows[0].n if rows else 0), [r.s for r in rows]


def _reduced(held, block):
    return np.linalg.qr(block if held is None else np.concatenate([held, block]), mode="r")


def _as_batch(number: int, m: np.ndarray | None):
    if m is None:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], ["task", "r"])
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([m.astype("<f8").tobytes()], pa.binary())], ["task", "r"])


def _merged(parts: DataFrame, tasks: int, merge) -> DataFrame:
    """Parts (task, r) merged ``FAN_IN`` at a time until one is left."""
    def run(key, table):
        held = None
        for r in table.column("r").to_pylist():
            held = merge(held, np.frombuffer(r, "<f8"))
        return pa.Table.from_batches([_as_batch(key[0].as_py(), held)])

    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("task", F.col("task") % tasks).groupBy("task").applyInArrow(run, "task long, r binary")
    return parts


def _triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list."""
    d, total = len(sums), np.array(sums, np.int64)

    def run(batches):
        held = None
        for batch in batches:
            for x in _blocks(_matrix(batch.column(0)) if batch.num_rows else np.zeros((0, d), np.int64)):
                held = _reduced(held, _deviations(x, n, total) / n)
        yield _as_batch(TaskContext.get().partitionId(), held)

    parts = fit.select("x").mapInArrow(releasing(run), "task long, r binary")
    merge = lambda held, r: _reduced(held, r.reshape(-1, d))
    rows = _merged(parts, fit.rdd.getNumPartitions(), merge).collect()  # one d x d triangle
    r = np.zeros((d, d))
    if rows:
        got = np.frombuffer(rows[0].r, "<f8").reshape(-1, d)
        r[:len(got)] = got
    return r


def _moments(held: np.ndarray | None, part: np.ndarray) -> np.ndarray:
    """Counts, means and centred products of two lists as those of their union."""
    if held is None:
        return part
    k = int(round((math.sqrt(1 + 4 * (len(part) - 1)) - 1) / 2))
    n, m = held[0], part[0]
    step = part[1:k + 1] - held[1:k + 1]
    out = held + part
    out[1:k + 1] = held[1:k + 1] + step * (m / (n + m))
    out[k + 1:] += (np.outer(step, step) * (n * m / (n + m))).ravel()
    return out


def _identity_error(fit: DataFrame, n: int, sums: list[int], scaled: np.ndarray) -> float:
    """Largest absolute entry of the whitened list's covariance minus I."""
    total, k = np.array(sums, np.int64), scaled.shape[1]

    def run(batches):
        held = None
        for batch in batches:
            for x in _blocks(_matrix(batch.column(0)) if batch.num_rows else np.zeros((0, len(total)), np.int64)):
                w = _deviations(x, n, total) / n @ scaled
                mean = w.mean(axis=0)
                c = w - mean
                held = _moments(held, np.concatenate([[float(len(w))], mean, (c.T @ c).ravel()]))
        yield _as_batch(TaskContext.get().partitionId(), held)

    parts = fit.select("x").mapInArrow(releasing(run), "task long, r binary")
    rows = _merged(parts, fit.rdd.getNumPartitions(), _moments).collect()  # one row of k * k + k + 1 numbers
    m = np.frombuffer(rows[0].r, "<f8")
    return float(np.max(np.abs(m[k + 1:].reshape(k, k) / m[0] - np.eye(k))))


def fit_whitening(rows: DataFrame, k: int = COMPONENTS) -> Whitening:
    """Fits on the distinct x of ``rows``.  Copies of a vector are dropped in
    each task before they move."""
    bound_batches(rows.sparkSession)
    fit = written(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "whitening-fit")
    n, sums = _sums(fit)
    none = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), np.zeros(0), 0.0)
    if n < 2:
        return none
    values, z = principal(_triangle(fit, n, sums), k)
    values = values / n
    trace = float(values.sum())
    rank = int(np.sum(np.sqrt(values) > max(n, len(values)) * EPS * math.sqrt(values[0]))) if values[0] > 0 else 0
    k = min(k, rank)
    if not k:
        return none
    z, values = z[:, :k], values[:k]
    error = _identity_error(fit, n, sums, z / np.sqrt(values))
    return Whitening(n, sums, z, values, values / trace, error)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row for each row (id, x) and component; nothing moves."""
    bound_batches(rows.sparkSession)
    n, total, k = model.n, np.array(model.sums, np.int64), len(model.eigenvalues)
    scaled = model.directions / np.sqrt(model.eigenvalues)
    explained, error = model.explained, model.identity_error
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows if k else 0, BLOCK):
                part = batch.slice(i, BLOCK)
                x = _matrix(part.column(1))
                c = _deviations(x, n, total)
                if len(total) * int(np.abs(c).max(initial=0)) ** 2 >= 1 << 63:
                    raise ArithmeticError("a deviation goes beyond 64 bits")
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)), pa.array(np.repeat((c * c).sum(axis=1), k)),
                     pa.array((c / n @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names)

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(releasing(run), f"vec_id {id_type}, component int, n long, deviation long, "
                                                             "whitened double, explained double, identity_error double")


def digest(df: DataFrame, k: int = COMPONENTS) -> DataFrame:
    rows = grid(df)
    return whitened(rows, fit_whitening(rows, k))
