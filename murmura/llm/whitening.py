"""Embedding whitening: leading components of the covariance by FEAST contour integration.

Entries become whole numbers, floor(64 c) + 1,000,000. The covariance is taken
over the distinct vectors, centred at the whole part of the mean: sums of
products of small whole numbers are exact in doubles and do not depend on how
rows are dealt; the rest of the mean, under one, is taken off at the end.

The covariance is as large as the dimensions squared, whatever the table. Its
inertia at a shift (the signs of the pivots of a symmetric factorisation) counts
the eigenvalues above it; bisecting by it gives intervals that hold the leading
ones, few each. Per interval, complex shifted solves at the nodes of a contour
around it, one task per node, project a random block onto its eigenvectors;
Rayleigh-Ritz extracts them, and rounds go on until as many converge as the
inertia counts. All of them together pass a last Rayleigh-Ritz step, which keeps
vectors of neighbouring intervals orthogonal, and the inertia below the least one
verifies that none is missed.

Vectors that are null, hold null or non-finite entries, entries beyond 2**46 or
fewer entries than the longest vector are dropped. Repeated rows are returned
each and fitted once. Components without variance (relative to the first) are
not returned, so equal vectors give no rows, and neither does an empty table.
Equal eigenvalues may come in any rotation, the same for all rows. A deviation
beyond a long is null. Null ids are carried; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import query, table
from murmura.session import materialize

STEP, SHIFT = 64, 1_000_000
COMPONENTS = 16

# Eigenvalues per interval at most, unless they are too close to part; nodes of a half contour; rounds before giving up.
_PER_INTERVAL, _NODES, _ROUNDS = 8, 8, 30
# Relative to the largest eigenvalue: what counts as no variance, and a converged residual.
_NONE, _CONVERGED = 1e-11, 1e-13
# Beyond this a whole entry has no exact double with six bits to spare.
_LARGEST = float(1 << 46)
_SEED = 11


# --- vectors and covariance ----------------------------------------------------------


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<bigint>) of the rows that have all entries."""
    entries = F.col("embedding").cast("array<double>")
    sound = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= _LARGEST))
    kept = vectors.filter(F.col("embedding").isNotNull()).select("vec_id", entries.alias("embedding")).filter(F.coalesce(sound, F.lit(False)))
    whole = F.transform("embedding", lambda c: F.floor(c * STEP) + F.lit(SHIFT).cast("bigint"))
    return kept.select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension, as whole numbers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = _matrix(batch.column("x"), d).sum(0)
                columns = [pa.array(range(d), pa.int32()), pa.array([batch.num_rows] * d, pa.int64()), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "s"])

    found = fit.select("x").mapInArrow(rows, "i int, n bigint, s bigint")
    found = found.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [0] * d)


def _cells(parts: DataFrame, d: int) -> np.ndarray:
    """The sum of matrices given as rows (i, values)."""
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    out = np.zeros((d, d))
    out[cells["i"], cells["j"]] = cells["v"]
    return out


def covariance(fit: DataFrame, n: int, s: list[int]) -> np.ndarray:
    """Covariance with divisor ``n`` of the fit list."""
    d = len(s)
    middle = np.array([v // n for v in s], np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            y = (_matrix(batch.column("x"), d) - middle).astype(float)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    rest = np.array([v % n for v in s]) / n
    gram = _cells(fit.select("x").mapInArrow(rows, "i int, v array<double>"), d)
    return gram / n - np.outer(rest, rest)


# --- FEAST ---------------------------------------------------------------------------


def inertia_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive pivots of L D L^T of the shifted matrix,
    with pivots of one or two rows by the rule of Bunch and Kaufman."""
    a = v - shift * np.eye(len(v))
    alpha, above = (1 + 17**0.5) / 8, 0
    while len(a):
        below = np.abs(a[1:, 0])
        r = int(np.argmax(below)) + 1 if len(below) else 0
        lead = below[r - 1] if r else 0.0
        if not lead:
            above += a[0, 0] > 0
            a = a[1:, 1:]
            continue
        widest = np.abs(np.delete(a[:, r], r)).max()
        two = False
        if abs(a[0, 0]) * widest < alpha * lead * lead:
            if abs(a[r, r]) >= alpha * widest:
                _swap(a, 0, r)
            else:
                _swap(a, 1, r)
                two = True
        if two:
            pivot, side = a[:2, :2], a[2:, :2]
            above += int((np.linalg.eigvalsh(pivot) > 0).sum())
            a = a[2:, 2:] - side @ np.linalg.solve(pivot, side.T)
        else:
            above += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0]) / a[0, 0]
    return int(above)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def _border(v: np.ndarray, low: float, at: float, high: float) -> float:
    """A shift with as many eigenvalues above it as ``at`` has, well inside the gap between its neighbours where there is one."""
    over = inertia_above(v, at)

    def last(same: float, other: float) -> float:
        for _ in range(50):
            if abs(other - same) <= 0.1 * abs(same - at) + 1e-12 * high:
                break
            middle = (same + other) / 2
            same, other = (middle, other) if inertia_above(v, middle) == over else (same, middle)
        return same

    return (last(at, low) + last(at, high)) / 2


def leading_intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside), from the top, that hold the ``wanted`` largest eigenvalues."""
    top = float(np.abs(v).sum(1).max()) * 1.01 + 1e-300
    out: list[tuple[float, float, int]] = []

    def part(low: float, high: float, over_low: int, over_high: int) -> None:
        count = over_low - over_high
        if not count or over_high >= wanted:
            return
        if (count <= _PER_INTERVAL and over_low <= wanted) or high - low < 1e-9 * top:
            out.append((low, high, count))
            return
        # Not the middle itself: spectra with round values would have eigenvalues on the borders.
        middle = _border(v, low, low + 0.4871 * (high - low), high)
        over = inertia_above(v, middle)
        part(middle, high, over, over_high)
        part(low, middle, over_low, over)

    floor = _border(v, 0.0, _NONE * top, top)
    part(floor, top, inertia_above(v, floor), 0)
    return out


def _contour(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre nodes and weights on the upper half of the circle around an interval."""
    x, w = np.polynomial.legendre.leggauss(_NODES)
    radius, angle = (high - low) / 2, np.pi / 2 * (x + 1)
    turn = np.exp(1j * angle)
    return (low + high) / 2 + radius * turn, w / 2 * radius * turn


def _projected(spark: SparkSession, v: np.ndarray, blocks: dict[int, np.ndarray], intervals: list[tuple[float, float, int]]) -> dict[int, np.ndarray]:
    """Each block, projected onto the eigenvectors of its interval: a weighted sum of solves, one task per node."""
    shared = spark.sparkContext.broadcast((v, blocks))
    nodes = [(k, float(z.real), float(z.imag), float(w.real), float(w.imag)) for k in blocks for z, w in zip(*_contour(*intervals[k][:2]), strict=True)]
    columns = dict(zip(("k", "zr", "zi", "wr", "wi"), map(list, zip(*nodes, strict=True)), strict=True))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, blocks = shared.value
        for frame in frames:
            for r in frame.itertuples():
                # Nodes in the lower half give the conjugate, which leaves twice the real part.
                part = (complex(r.wr, r.wi) * np.linalg.solve(complex(r.zr, r.zi) * np.eye(len(v)) - v, blocks[r.k])).real
                yield pd.DataFrame({"k": [r.k], "v": [part.ravel()]})

    asked = spark.createDataFrame(pa.table(columns)).repartition(len(nodes), "k", "zr")
    out = {k: np.zeros_like(b) for k, b in blocks.items()}
    # As many rows as nodes, each as large as a block: dimensions times a few.
    for row in sorted(asked.mapInPandas(solve, "k bigint, v array<double>").collect(), key=lambda r: (r["k"], r["v"])):
        out[row["k"]] += np.array(row["v"]).reshape(out[row["k"]].shape)
    return out


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and vectors of the span of a block; directions it lacks are left out."""
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    q = left[:, size > 1e-14 * size[0]] if len(size) and size[0] else left[:, :1]
    values, turn = np.linalg.eigh(q.T @ v @ q)
    return values[::-1], q @ turn[:, ::-1]


def leading_components(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    d, scale = len(v), float(np.abs(v).max()) if len(v) else 0.0
    if not scale:
        return np.zeros(0), np.zeros((d, 0))
    intervals = leading_intervals(v, wanted)
    rng = np.random.default_rng(_SEED)
    blocks = {k: rng.standard_normal((d, min(d, 2 * count + 4))) for k, (_, _, count) in enumerate(intervals)}
    found: list[np.ndarray] = [np.zeros((d, 0))] * len(intervals)
    norm = float(np.linalg.norm(v, 2))
    for _ in range(_ROUNDS):
        for k, block in _projected(spark, v, blocks, intervals).items():
            low, high, count = intervals[k]
            values, vectors = _ritz(v, block)
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(v @ vectors - vectors * values, axis=0)
            blocks[k] = vectors
            if inside.sum() == count and (residual[inside] <= _CONVERGED * d * norm).all():
                found[k] = vectors[:, inside]
                del blocks[k]
        if not blocks:
            break
    else:
        raise RuntimeError(f"{len(blocks)} of {len(intervals)} intervals did not converge")
    values, vectors = _ritz(v, np.concatenate(found, axis=1))
    total = sum(count for _, _, count in intervals)
    below = min(low for low, _, _ in intervals)
    if len(values) != total or inertia_above(v, below) != total:
        raise RuntimeError("eigenvalues were missed")
    return values[:wanted], vectors[:, :wanted]


# --- whitening -----------------------------------------------------------------------


def _turned(x: np.ndarray, n: int, s: np.ndarray, map_: np.ndarray) -> np.ndarray:
    return ((n * x - s) / n) @ map_


def identity_error(fit: DataFrame, n: int, s: list[int], map_: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    d, k = map_.shape
    centre = np.array(s, np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            y = _turned(_matrix(batch.column("x"), d), n, centre, map_)
            y = np.concatenate([y, np.ones((len(y), 1))], axis=1)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    whole = _cells(fit.select("x").mapInArrow(rows, "i int, v array<double>"), k + 1) / n
    return float(np.abs(whole[:k, :k] - np.outer(whole[:k, k], whole[:k, k]) - np.eye(k)).max())


def _deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares as whole numbers; null beyond a long."""
    small = (centred.astype(float) ** 2).sum(1) < 2.0**62
    out = np.where(small, (np.where(small[:, None], centred, 0) ** 2).sum(1), 0).tolist()
    for i in np.flatnonzero(~small):
        exact = sum(int(c) ** 2 for c in centred[i])
        out[i] = exact if exact < 2**63 else None
    return pa.array(out, pa.int64())


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component of a table (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors)
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.filter(F.size("x") == d)
    fit = materialize(rows.select("x").distinct())
    n, s = sums(fit, d)
    none = spark.createDataFrame([], _OUT)
    if not n or not d:
        return none
    v = covariance(fit, n, s)
    values, axes = leading_components(spark, v, components)
    if not len(values):
        return none
    map_ = axes / np.sqrt(values)
    explained, error = values / np.trace(v), identity_error(fit, n, s, map_)
    centre, k = np.array(s, np.int64), len(values)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column("vec_id").cast(pa.int64()).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                _deviations(n * x - centre).take(each),
                pa.array(_turned(x, n, centre, map_).ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, _OUT)


@query("op11_embedding_whitening", None)
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"))
