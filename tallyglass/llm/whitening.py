"""Embedding whitening: leading principal components by contour integration (FEAST).

Spark reduces the rows to their exact per-dimension sums and, in a second pass, to the covariance of the centred rows;
both are partial sums per task, added up by dimension. Of that one matrix, inertia counts (Sturm sequences of its
tridiagonal form) cut the upper end of the spectrum into intervals of few eigenvalues. Each interval is a task: Gauss
quadrature over a circle around it, one complex shifted solve per node, projects a random subspace onto the
interval's eigenvectors, Rayleigh-Ritz extracts them, and the step repeats until the residuals are at rounding level.
A task fails if it has not found as many eigenvalues as the inertia counts say, so none is missed. A third pass over
the rows projects and scales them.

Rows whose vector is null or holds null or non-finite entries take no part. Vectors of unequal length count as filled
up with entries of 0. A null or repeated ``vec_id`` is an ordinary row. Components of (numerically) no variance cannot
be scaled and are left out, so constant vectors, or a single one, give no rows; neither does an empty table. Equal
eigenvalues share a space of which any orthonormal basis may come. ``deviation`` is null where it needs more than 64
bits. Entries are meant to stay below 2^40. Further columns are left out. What a task and the driver hold is the
square of the vectors' length, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm.common import table
from tallyglass.workspace import materialize

COMPONENTS = 8
SCALE = 1024.0
SHIFT = 100_000
NODES = 8
PER_INTERVAL = 4
ROUNDS = 40
TOLERANCE = 1e-13
BATCH_ROWS = 4096
RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


# Rows


def whole_rows(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the rows that take part, and their entries as whole numbers."""
    kept, vectors = [], []
    offsets = column.offsets.to_numpy()
    entries = column.values.cast(pa.float64())
    nulls = entries.is_null().to_numpy(zero_copy_only=False)
    values = entries.fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(nulls | ~np.isfinite(values))))
    limit = 9.2e18
    scaled = np.clip(np.floor(SCALE * np.where(np.isfinite(values), values, 0.0)) + SHIFT, -limit, limit).astype(np.int64)
    for i in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])).tolist():
        kept.append(i)
        vectors.append(scaled[offsets[i] : offsets[i + 1]])
    return np.array(kept, np.int64), vectors


def filled(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """One matrix; missing entries are entries of 0."""
    if all(len(v) == width for v in vectors):
        return np.stack(vectors) if vectors else np.zeros((0, width), np.int64)
    out = np.full((len(vectors), width), SHIFT, np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            column = pa.concat_arrays([part.column("embedding")])  # offsets from 0
            kept, vectors = whole_rows(column)
            if len(kept):
                yield part, kept, vectors


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum per dimension."""

    def run(batches):
        count, total = 0, np.zeros(0, np.int64)
        for _, _, rows in _parts(batches):
            width = max(len(total), max(len(v) for v in rows))
            total = np.pad(total, (0, width - len(total)))
            count += len(rows)
            total += filled(rows, width).sum(axis=0) - SHIFT * len(rows)
        if count:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(-1, len(total)), "s": np.concatenate(([count], total))})

    # Sums of x - SHIFT, so that rows without an entry add nothing; row -1 counts the rows.
    added = vectors.select("embedding").mapInArrow(run, "dim bigint, s bigint").groupBy("dim").agg(F.sum("s").alias("s"))
    found = {r["dim"]: r["s"] for r in added.collect()}  # one row per dimension
    n = found.pop(-1, 0)
    return n, [found[d] + SHIFT * n for d in sorted(found)]


def covariance(vectors: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance of the rows, centred before multiplying: one partial matrix per task."""
    width = len(mean)

    def run(batches):
        total = np.zeros((width, width))
        for _, _, rows in _parts(batches):
            centred = filled(rows, width) - mean
            total += centred.T @ centred
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": total[i, j]})

    added = vectors.select("embedding").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    cells = added.toPandas()  # width squared, whatever the number of rows
    out = np.zeros((width, width))
    out[cells["i"], cells["j"]] = cells["s"] / n
    return out + np.triu(out, 1).T


# Eigenvalue intervals


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        alpha = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= alpha
        size = np.linalg.norm(x)
        if size == 0:
            continue
        v = x / size
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = alpha
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """How many eigenvalues lie above a shift: signs of the pivots of the shifted tridiagonal form."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.off = tridiagonal(matrix)
        reach = np.zeros(len(self.diagonal))
        reach[:-1] += np.abs(self.off)
        reach[1:] += np.abs(self.off)
        self.low, self.high = float((self.diagonal - reach).min()), float((self.diagonal + reach).max())
        self.tiny = max(np.abs(self.off).max(initial=0.0), np.abs(self.diagonal).max(), 1e-300) * 1e-30

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for i, entry in enumerate(self.diagonal):
            pivot = entry - shift - (self.off[i - 1] ** 2 / pivot if i else 0.0)
            if pivot == 0:
                pivot = -self.tiny
            count += bool(pivot > 0)
        return count


def upper_intervals(inertia: Inertia, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals from the top of the spectrum, with their eigenvalue counts, until ``wanted`` are covered."""
    size = max(abs(inertia.low), abs(inertia.high), 1e-300)
    margin = 1e-3 * size
    waiting, out, held = [(inertia.low - margin, inertia.high + margin)], [], 0
    while waiting and held < wanted:
        low, high = waiting.pop()
        count = inertia.above(low) - inertia.above(high)
        if not count:
            continue
        if count <= PER_INTERVAL or high - low <= 1e-10 * size:
            out.append((low, high, count))
            held += count
            continue
        cut = _cut(inertia, low, high)
        waiting += [(low, cut), (cut, high)]
    return out


def _cut(inertia: Inertia, low: float, high: float) -> float:
    """A place near the middle with no eigenvalue close by, if there is one."""
    for room in (0.02, 0.005, 0.001):
        for share in (0.5, 0.44, 0.56, 0.38, 0.62, 0.31, 0.69):
            at, free = low + share * (high - low), room * (high - low)
            if inertia.above(at - free) == inertia.above(at + free):
                return at
    return (low + high) / 2


def contour(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in the interval: quadrature over a circle, then Rayleigh-Ritz, repeated."""
    width = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - nodes)
    size = min(width, 2 * count + 4)
    scale = max(abs(np.trace(matrix)), 1e-300)
    basis = np.random.default_rng(13).normal(size=(width, size))
    identity = np.eye(width)
    best = None
    for round_ in range(ROUNDS):
        projected = np.zeros_like(basis)
        for angle, weight in zip(angles, weights):
            turn = radius * np.exp(1j * angle)
            solved = np.linalg.solve((centre + turn) * identity - matrix, basis.astype(complex))
            projected += weight / 2 * np.real(turn * solved)
        left, strength, _ = np.linalg.svd(projected, full_matrices=False)
        left = left[:, strength > strength[0] * 1e-15]
        values, turned = np.linalg.eigh(left.T @ matrix @ left)
        basis = left @ turned
        residual = np.linalg.norm(matrix @ basis - basis * values, axis=0) / scale
        inside = np.flatnonzero((values > low) & (values < high))
        if len(inside) >= count:
            pick = inside[np.argsort(residual[inside], kind="stable")[:count]]
            worst = float(residual[pick].max())
            if best is None or worst < best[0]:
                best = (worst, values[pick], basis[:, pick])
            elif best[0] < 1e-11:
                break  # rounding level
            if best[0] < TOLERANCE:
                break
        if basis.shape[1] < min(width, count + 1):  # directions were lost: start them anew
            extra = np.random.default_rng(31 + round_).normal(size=(width, size - basis.shape[1]))
            basis = np.concatenate((basis, extra), axis=1)
    if best is None or best[0] > 1e-9:
        raise ArithmeticError(f"interval ({low}, {high}) holds {count} eigenvalues; the contour did not find them all")
    return best[1], best[2]


def leading(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors; one Spark task per interval."""
    intervals = upper_intervals(Inertia(matrix), wanted)
    if not intervals:
        return np.zeros(0), np.zeros((len(matrix), 0))

    def solve(batches):
        for df in batches:
            for low, high, count in zip(df["low"], df["high"], df["count"]):
                values, vectors = contour(matrix, low, high, count)
                yield pd.DataFrame({"value": values, "vector": [v.tolist() for v in vectors.T]})

    rows = spark.createDataFrame(intervals, "low double, high double, count int").repartition(len(intervals))
    pairs = rows.mapInPandas(solve, "value double, vector array<double>").collect()  # a few per interval
    # One more Rayleigh-Ritz step over all intervals makes the vectors orthogonal to rounding.
    basis, _ = np.linalg.qr(np.array([p["vector"] for p in pairs]).T)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = basis @ turned[:, order]
    return values[order], vectors / np.linalg.norm(vectors, axis=0)


# Whitening


@dataclass(frozen=True)
class Whitener:
    """What a fit leaves: row count, exact sums, eigenvalues, unit eigenvectors, trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def transform(self, vectors: DataFrame) -> DataFrame:
        """``vec_id``, ``deviation`` and the whitened components of every row that takes part."""
        n, total, width = self.n, np.array(self.sums, object), len(self.sums)
        mean = np.array([s / n for s in self.sums])
        turn = self.vectors / np.sqrt(self.values)

        def run(batches):
            for part, kept, rows in _parts(batches):
                x = filled(rows, width)
                white = (x - mean) @ turn
                far = max(int(np.abs(x).max(initial=0)) * n, *(abs(s) for s in self.sums))
                if 4 * far * far * width < 1 << 63:
                    off = n * x - total.astype(np.int64)
                    deviation = (off * off).sum(axis=1).tolist()
                else:
                    exact = [sum((n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
                    deviation = [d if d < 1 << 63 else None for d in exact]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(kept)).cast(pa.int64()),
                        pa.array(deviation, pa.int64()),
                        pa.array(list(white), pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "deviation", "white"],
                )

        rows = vectors.select("vec_id", "embedding")
        return rows.mapInArrow(run, "vec_id bigint, deviation bigint, white array<double>")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on all rows that take part; None if there is none."""
    n, total = sums(vectors)
    if not n:
        return None
    matrix = covariance(vectors, np.array([s / n for s in total]), n)
    trace = float(np.trace(matrix))
    if not trace > 0:
        return Whitener(n, tuple(total), np.zeros(0), np.zeros((len(total), 0)), trace)
    values, turned = leading(vectors.sparkSession, matrix, min(components, len(total)))
    varied = values > trace * len(total) * np.finfo(float).eps * 4
    return Whitener(n, tuple(total), values[varied], turned[:, varied], trace)


def identity_error(white: DataFrame, components: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, centred before multiplying."""
    cells = [F.col("white")[k] for k in range(components)]
    means = white.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(cells)]).first()
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    centred = [c - F.lit(means[k]) for k, c in enumerate(cells)]
    found = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (1.0 if i == j else 0.0)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: fit on all rows, then transform all rows."""
    fitted = fit(vectors, components)
    count = 0 if fitted is None else len(fitted.values)
    if not count:
        return vectors.sparkSession.createDataFrame([], RESULT)
    white = materialize(fitted.transform(vectors), "white")
    error = identity_error(white, count)
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    return white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLE: dict[str, str] = {}
