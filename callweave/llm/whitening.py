"""Whitening of embeddings by their leading principal components.

Spark finds the distinct vectors, their sums and the centred covariance.  The
driver gets one square matrix of the vectors' length, brings it to tridiagonal
form by Householder reflections, finds the leading eigenvalues by bisection on
Sturm counts and their vectors by inverse iteration, and hands the projection
back to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING, NamedTuple

from pyspark.sql import DataFrame, functions as F

from .storage import written

if TYPE_CHECKING:
    import numpy as np

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 62  # entries beyond it, which no embedding has, count as it
WIDEST = 8192  # longer vectors would make a covariance of more than half a gigabyte


# The driver's part: leading eigenpairs of a symmetric matrix
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix by Householder's method."""
    import numpy as np

    a = a.copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        length = np.linalg.norm(x)
        if length == 0 or not x[1:].any():
            continue
        v = x.copy()
        v[0] += length if v[0] >= 0 else -length
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        q = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, q) + np.outer(q, v)
        a[k + 1 :, k] = a[k, k + 1 :] = x - 2 * (v @ x) * v
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each point: the negative pivots."""
    import numpy as np

    least = np.finfo(float).tiny * max(1.0, float(np.max(e * e, initial=0.0))) / np.finfo(float).eps
    q = d[0] - at
    below = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = d[i] - at - e[i - 1] ** 2 / np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, bisected until the bounds are neighbours."""
    import numpy as np

    n = len(d)
    reach = np.abs(np.concatenate([e, [0.0]])) + np.abs(np.concatenate([[0.0], e]))
    ranks = np.arange(n - 1, n - 1 - min(most, n), -1)
    low, high = np.full(len(ranks), (d - reach).min()), np.full(len(ranks), (d + reach).max())
    margin = 2 * np.finfo(float).eps * max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - margin, high + margin
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = sturm_counts(d, e, middle) <= ranks
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """A solution of (T - shift) x = b by elimination with row exchanges."""
    n = len(d)
    main, up, up2, x = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * n, b.tolist()
    down = e.tolist()
    for i in range(n - 1):
        if abs(down[i]) > abs(main[i]):
            main[i], down[i] = down[i], main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            if i + 1 < n - 1:
                up2[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(main[i]) < least:
            main[i] = least
        f = down[i] / main[i]
        main[i + 1] -= f * up[i]
        if i + 1 < n - 1:
            up[i + 1] -= f * up2[i]
        x[i + 1] -= f * x[i]
    if abs(main[-1]) < least:
        main[-1] = least
    import numpy as np

    for i in range(n - 1, -1, -1):
        later = (up[i] * x[i + 1] if i + 1 < n else 0.0) + (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - later) / main[i]
    out = np.array(x)
    return out / np.abs(out).max()


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, by inverse iteration.  Vectors of values closer than a
    thousandth of the matrix's norm are one cluster, and orthogonal to those before them in it."""
    import numpy as np

    n = len(d)
    norm = max(float(np.abs(d).max() + 2 * np.abs(e).max(initial=0.0)), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = min(value, shift - 4 * eps * norm)  # equal values get shifts of their own
        x = np.random.default_rng(j).standard_normal(n)
        for _ in range(5):
            x = _solve(d, e, shift, x, eps * norm)
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_pairs(a: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as columns) of the ``most`` largest eigenvalues, falling."""
    d, e, reflections = tridiagonal(a)
    values = leading_values(d, e, most)
    vectors = leading_vectors(d, e, values)
    for start, v in reversed(reflections):
        part = vectors[start:]
        part -= 2 * v[:, None] * (v @ part)
    return values, vectors


# Spark's part
def _matrix(column, width: int) -> np.ndarray:  # type: ignore[no-untyped-def]
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def quantised(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, width, x): vectors as packed longs floor(64 c) + 1000000.  Rows whose vector
    is null, or holds null or non-finite entries, are left out."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            lists = b.column(1)
            b = b.filter(pc.is_valid(lists))
            lists = b.column(1)
            widths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().cast(pa.float64())
            c = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
            x = np.clip(np.floor(np.where(np.isfinite(c), c, 0) * SCALE), -LARGEST, LARGEST).astype("<i8") + OFFSET
            ends = np.cumsum(widths)
            sound = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
            good = sound[ends] == sound[ends - widths]
            raw, starts = x.tobytes(), ends - widths
            packed = [raw[8 * s : 8 * t] for s, t, g in zip(starts.tolist(), ends.tolist(), good.tolist()) if g]
            keep = b.column(0).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([keep, pa.array(widths[good], pa.int64()), pa.array(packed, pa.binary())], ["vec_id", "width", "x"])

    src = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return src.mapInArrow(run, "vec_id long, width long, x binary")


def _cells(fit: DataFrame, width: int, side: int, part) -> np.ndarray:  # type: ignore[no-untyped-def]
    """The sum over tasks of ``part(matrix)``, a matrix of ``side`` columns: tasks give its
    cells, and Spark adds equal ones."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = None
        for b in batches:
            if b.num_rows:
                one = part(_matrix(b.column(0), width))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    got = fit.select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(side * side)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return out.reshape(side, side)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum of (n x - S)^2 over each row; in longs where a bound shows that they suffice."""
    import numpy as np

    if not x.size or n * int(np.abs(x).max()) < 1 << 62:
        exact = x * n - np.array(sums, np.int64)
        if x.size and int(np.abs(exact).max()) ** 2 * x.shape[1] >= 1 << 62:
            exact = exact.astype(object)
    else:
        exact = x.astype(object) * n - np.array(sums, object)
    return [int(d) for d in (exact * exact).sum(axis=1)]


class Model(NamedTuple):
    """A fit: n distinct vectors with sums, components as columns over the root of their values."""

    n: int
    sums: list[int]
    project: np.ndarray
    explained: np.ndarray
    identity_error: float


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """How many vectors, and the exact sum of each dimension."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, total = 0, [0] * width
        for b in batches:
            x = _matrix(b.column(0), width)
            n += len(x)
            high, low = (x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0)  # no sum of a batch overflows
            total = [t + (int(h) << 31) + int(lo) for t, h, lo in zip(total, high, low)]
        if n:
            import decimal

            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width + 1), pa.int64()), pa.array([decimal.Decimal(t) for t in [n, *total]], pa.decimal128(38, 0))], ["i", "v"]
            )

    rows = fit.select("x").mapInArrow(run, "i long, v decimal(38,0)").groupBy("i").agg(F.sum("v").cast("decimal(38,0)").alias("v")).orderBy("i").collect()
    return int(rows[0]["v"]), [int(r["v"]) for r in rows[1:]]


def learn(rows: DataFrame, width: int, most: int = 16) -> Model:
    """The fit over each distinct vector of ``rows`` (``quantised``) of that width, once.
    Components whose value is zero, by rounding or by rank, can't be whitened and are left out."""
    import numpy as np

    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; the covariance is held by the driver up to {WIDEST}")
    fit = written(rows.where(F.col("width") == width).select("x").distinct(), "distinct-vectors")
    n, sums = _sums(fit, width)
    mean = np.array([s / n for s in sums])

    def outer(x: np.ndarray) -> np.ndarray:
        c = x - mean
        return c.T @ c

    v = _cells(fit, width, width, outer) / n
    if not v.any():
        return Model(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    values, vectors = leading_pairs((v + v.T) / 2, most)
    sound = values > width * np.finfo(float).eps * values[0]
    values, vectors = values[sound], vectors[:, sound]
    project = vectors / np.sqrt(values)
    explained = values / np.trace(v)
    k = len(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        w = np.hstack([(x - mean) @ project, np.ones((len(x), 1))])  # the last column gives the means
        return w.T @ w

    moments = _cells(fit, width, k + 1, whitened) / n
    off = moments[:k, k]
    error = float(np.abs(moments[:k, :k] - np.outer(off, off) - np.eye(k)).max())
    return Model(n, sums, project, explained, error)


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact), one row per sound vector and component up to ``most``.

    Rows with a null vector, or null or non-finite entries, are left out.  Vectors
    of each length are a fit of their own, as lengths can't be projected on one
    another.  Repeated rows give repeated rows and count once in the fit; ids may
    be null; entries of 2**56 and more count as 2**56.  Equal
    eigenvalues have components that are orthogonal but not unique.  Empty
    vectors, and fits without spread, have no component and no rows, and neither
    has an empty table.  ``deviation`` is null where it exceeds a long;
    ``deviation_exact`` holds it as text at any size.
    """
    spark = table.sparkSession
    rows = quantised(table, id_col, vector_col)
    widths = [r["width"] for r in rows.select("width").where("width > 0").distinct().orderBy("width").collect()]
    models = spark.sparkContext.broadcast({w: learn(rows, w, most) for w in widths})  # a matrix of at most ``most`` columns each

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, widths = b.column(0), b.column(1).to_numpy()
            for w in np.unique(widths).tolist():
                m = models.value.get(w)
                if m is None or not m.project.shape[1]:
                    continue
                at = np.flatnonzero(widths == w)
                x = _matrix(b.column(2).take(pa.array(at)), w)
                k, mean = m.project.shape[1], np.array([s / m.n for s in m.sums])
                deviation = _deviations(x, m.n, m.sums)
                fits = [d if d < 1 << 63 else None for d in deviation]
                whitened = (x - mean) @ m.project
                rows = len(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, m.n)),
                        pa.array([d for d in fits for _ in range(k)], pa.int64()), pa.array(whitened.ravel()), pa.array(np.tile(m.explained, rows)),
                        pa.array(np.full(rows * k, m.identity_error)), pa.array([s for d in deviation for s in [str(d)] * k]),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
    return rows.mapInArrow(run, kinds)
