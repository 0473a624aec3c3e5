"""Whitening of vectors by principal components, from a bidiagonal form and its singular values.

Centred rows are reduced by QR block by block where they are read, and the triangles of the partitions are stacked and
reduced again, sixteen at a time, until a few are left. From there on the work is of the size of the dimension alone:
Householder reflections bring the last triangle R to an upper bidiagonal B, the shifted quotient-difference algorithm
(dqds) finds B's singular values to high relative accuracy, and twisted factorisations of B'B less an eigenvalue give
its vectors. With n rows the covariance's eigenvalues are the squared singular values over n; no covariance of the rows
is ever summed.

A vector's entries are taken as whole numbers x = floor(1024 * c) + 100000, so sums and deviations are exact.

Defined results: vectors that are null or hold null or non-finite entries go, and vectors of another length than the
commonest one (of equally common ones the greatest) go too, as empty ones do. 1024 * c is held within 2 ** 52. A
direction without variance has whitened null and takes no part in identity_error (which is null where there is none);
explained is null without any variance. A deviation beyond a long is null. Rows that share an id, and rows without one,
are rows of their own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Triangles that are stacked at once.
FAN = 16
#: A triangle has at most this many rows; longer vectors are refused.
MAX_DIMENSION = 4096
#: Sums of a task that are held before they are passed on.
HELD = 1 << 20
#: Rows of an Arrow batch that are multiplied at once.
ROWS = 1024
EPS = float(np.finfo(float).eps)


class Whitener(NamedTuple):
    """The fit: n rows with sums S; eigenvalues (falling) and the columns of ``vectors`` for the first components."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v (array of doubles) of the rows that take part, whatever their length."""
    v = F.col(vector_col).cast("array<double>")
    finite: Column = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return vectors.where(v.isNotNull() & finite & (F.size(v) > 0)).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _blocks(batch: pa.RecordBatch, dimension: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length in the batch (or the one given) the places of its rows and their whole numbers."""
    v = batch.column("v")
    flat, ends = v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy()
    ends = ends - ends[0]
    sizes = np.diff(ends)
    for d in [dimension] if dimension else np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        for begin in range(0, len(rows), max(1, min(ROWS, (ROWS * 64) // d))):
            part = rows[begin : begin + max(1, min(ROWS, (ROWS * 64) // d))]
            c = flat[ends[part][:, None] + np.arange(d)]
            yield part, np.floor(np.clip(1024 * c, -(2.0**52), 2.0**52)).astype(np.int64) + 100_000


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many rows have the commonest length, and the sum of each of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            cells = [(d, k, n, Decimal(int(t))) for d, (n, total) in held.items() for k, t in enumerate(total)]
            held.clear()
            columns = list(zip(*cells, strict=True)) or [[]] * 4
            types = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["d", "k", "n", "total"])

        for batch in batches:
            for _, x in _blocks(batch):
                n, total = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = n + len(x), total + x.sum(axis=0).astype(object)
            if sum(map(int, held)) > HELD:
                yield out()
        yield out()

    each = rows.mapInArrow(run, "d int, k int, n long, total decimal(38,0)").groupBy("d", "k").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    most = each.where("k = 0").orderBy(F.desc("n"), F.desc("d")).select("d", "n").first()
    if most is None:
        return 0, []
    found = each.where(F.col("d") == most["d"]).select("k", "total").collect() if most["d"] <= MAX_DIMENSION else None
    if found is None:
        raise ValueError(f"vectors of {most['d']} entries; at most {MAX_DIMENSION} are supported")
    return most["n"], [int(r["total"]) for r in sorted(found)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, where the whole part is taken away exactly."""
    whole, rest = zip(*(divmod(s, n) for s in sums), strict=True)
    return (x - np.array(whole, np.int64)) - np.array(rest, float) / n


def _stacked(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def triangle(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    d = len(sums)
    schema = "part int, r binary"

    def record(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for _, x in _blocks(batch, d):
                r = _stacked([r, _centred(x, n, sums)])
        if len(r):
            yield record(TaskContext.get().partitionId(), r)

    def reduce_triangles(table: pa.Table) -> pa.Table:
        # By part: the result is then the same in every run.
        found = sorted(zip(table.column("part").to_pylist(), table.column("r").to_pylist(), strict=True))
        return pa.Table.from_batches([record(found[0][0] // FAN, _stacked([np.frombuffer(r).reshape(-1, d) for _, r in found]))])

    blocks = cut(rows.mapInArrow(reduce_rows, schema))
    parts = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    while parts > FAN:
        blocks = blocks.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(reduce_triangles, schema)
        parts = -(-parts // FAN)
    last = [np.frombuffer(r["r"]).reshape(-1, d) for r in blocks.orderBy("part").collect()]
    r = _stacked(last)
    return np.vstack([r, np.zeros((d - len(r), d))])


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The diagonal and upper diagonal of B, and W, where R = U B W'."""
    a, d = r.copy(), len(r)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray:
        v, top = x.copy(), np.linalg.norm(x)
        v[0] += top if x[0] >= 0 else -top
        size = np.linalg.norm(v)
        return v / size if size else v

    for k in range(d):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None where the shift was above the least eigenvalue."""
    d, new_q, new_e = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        new_q.append(d + e[k])
        t = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e.append(e[k] * t)
        d = d * t - shift
    return None if d < 0 or d != d else ([*new_q, d], new_e)


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """By dqds, of an upper bidiagonal matrix: squares of the diagonal are q, of the upper diagonal e."""
    todo, found = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)], []
    while todo:
        q, e, moved = todo.pop()
        while q:
            small = [k for k in range(len(e)) if e[k] <= EPS * EPS * (min(q[k], q[k + 1]) + moved)]
            if small:  # the matrix falls into two
                k = small[-1]
                todo.append((q[: k + 1], e[:k], moved))
                q, e = q[k + 1 :], e[k + 1 :]
                continue
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # The least eigenvalue of the last two rows is near the least of all; where it is too much, less is tried.
            half = (q[-2] + e[-1] + q[-1]) / 2
            guess = q[-2] * q[-1] / (half + max(half * half - q[-2] * q[-1], 0.0) ** 0.5) if half else 0.0
            for share in (1 - 4 * EPS, 0.9, 0.5, 0.1, 0.0):
                if swept := _sweep(q, e, guess * share):
                    moved += guess * share
                    break
            q, e = swept
    return sorted(found, reverse=True)


def _twisted(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """A unit vector of B'B at this eigenvalue, from the twisted factorisation whose middle pivot is least.

    ``others`` are vectors of eigenvalues so near that they must be kept at right angles by hand."""
    m, tiny = len(a), EPS * EPS * max(value, float(np.finfo(float).tiny) / EPS**2)
    d, below = a * a, b * b
    up, s = np.empty(m), np.empty(m)
    s[0] = -value
    for k in range(m):  # from the top: L+ D+ L+'
        up[k] = d[k] + s[k]
        if abs(up[k]) < tiny:
            up[k] = -tiny
        if k < m - 1:
            s[k + 1] = below[k] * s[k] / up[k] - value
    down, p = np.empty(m), np.empty(m)
    p[m - 1] = d[m - 1] - value
    for k in range(m - 2, -1, -1):  # from below: U- D- U-'
        down[k + 1] = below[k] + p[k + 1]
        if abs(down[k + 1]) < tiny:
            down[k + 1] = -tiny
        p[k] = p[k + 1] * d[k] / down[k + 1] - value
    gamma = s + p + value
    for r in np.argsort(np.abs(gamma), kind="stable"):
        z = np.zeros(m)
        z[r] = 1
        for k in range(r - 1, -1, -1):
            z[k] = -(a[k] * b[k] / up[k]) * z[k + 1]
        for k in range(r, m - 1):
            z[k + 1] = -(a[k] * b[k] / down[k + 1]) * z[k]
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for o in others:
                left = left - o * (o @ left)
        size = np.linalg.norm(left)
        if size > 0.1 or m == len(others) + 1:
            return left / size
    return left / size


def eigenpairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of B'B, falling, and their vectors as columns."""
    top = float(max(np.abs(a).max(), np.abs(b).max(initial=0.0)))
    a = np.where(np.abs(a) < EPS * EPS * top, EPS * EPS * top, a)  # a pivot of nought is none
    ends = [0, *(np.flatnonzero(np.abs(b) <= EPS * top / 8) + 1).tolist(), len(a)]
    pairs = []
    for begin, end in zip(ends, ends[1:], strict=False):
        diagonal, upper = a[begin:end], b[begin : end - 1]
        near: list[np.ndarray] = []
        before = None
        for value in squared_singular_values(diagonal, upper):
            if before is None or before - value > 1e-6 * before:
                near = []
            z = _twisted(diagonal, upper, value, near)
            near.append(z)
            before = value
            whole = np.zeros(len(a))
            whole[begin:end] = z
            pairs.append((value, whole))
    pairs.sort(key=lambda p: -p[0])
    return np.array([p[0] for p in pairs]), np.stack([p[1] for p in pairs], axis=1)


def fit(rows: DataFrame, components: int = 8) -> Whitener | None:
    """Of all rows of ``usable``; None where there are none."""
    n, sums = _sums(rows)
    if not n:
        return None
    r = triangle(rows, n, sums)
    if not r.any():
        return Whitener(n, sums, np.zeros(min(components, len(sums))), np.eye(len(sums))[:, :components], 0.0)
    a, b, w = bidiagonal(r)
    values, vectors = eigenpairs(a, b)
    trace = float((r * r).sum()) / n
    values = np.where(values > values[0] * (len(sums) * EPS) ** 2, values, 0.0) / n
    return Whitener(n, sums, values[:components], (w @ vectors)[:, :components], trace)


def _directions(w: Whitener) -> np.ndarray:
    """Columns that whiten; those without variance are NaN."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w.eigenvalues > 0, w.vectors / np.sqrt(w.eigenvalues), np.nan)


def identity_error(rows: DataFrame, w: Whitener) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over directions with variance."""
    used = _directions(w)[:, w.eigenvalues > 0]
    n, sums, d = w.n, w.sums, len(w.sums)
    m = used.shape[1]
    if not m:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whitened rows are centred but for rounding; a column of ones gives the sums that are left.
        total = np.zeros((m + 1, m + 1))
        for batch in batches:
            for _, x in _blocks(batch, d):
                z = np.hstack([_centred(x, n, sums) @ used, np.ones((len(x), 1))])
                total += z.T @ z
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "total"])

    found = rows.mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    total = np.zeros((m + 1, m + 1))
    for r in found:
        total[r["i"], r["j"]] = r["total"]
    mean = total[:m, m] / n
    return float(np.abs(total[:m, :m] / n - np.outer(mean, mean) - np.eye(m)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S) ** 2 of each row, exactly; None where it is no long."""
    whole, rest = zip(*(divmod(s, n) for s in sums), strict=True)
    apart = x - np.array(whole, np.int64)
    if (((np.abs(apart).astype(float) + 1) * n) ** 2).sum(axis=1).max(initial=0) < 2.0**62:
        return (((n * apart - np.array(rest, np.int64)) ** 2).sum(axis=1)).tolist()
    out = []
    for row in apart.tolist():
        total = sum((n * v - s) ** 2 for v, s in zip(row, rest, strict=True))
        out.append(total if total < 1 << 63 else None)
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(vectors, id_col, vector_col)
    w = fit(rows, components)
    if w is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, used, d = identity_error(rows, w), _directions(w), len(w.sums)
    explained = (w.eigenvalues / w.trace).tolist() if w.trace else [None] * len(w.eigenvalues)
    n, sums, m = w.n, w.sums, len(w.eigenvalues)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _blocks(batch, d):
                k = len(part)
                z = (_centred(x, n, sums) @ used).ravel()
                ids = batch.column("vec_id").take(pa.array(np.repeat(part, m)))
                deviation = pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(k), m)))
                columns = [ids, pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.full(k * m, n)), deviation, pa.array(z, from_pandas=True), pa.array(explained * k, pa.float64()), pa.array([error] * (k * m), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)
