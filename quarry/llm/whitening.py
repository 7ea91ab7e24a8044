"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never turned into a covariance.  Each step multiplies
them by the newest right vector v, orthogonalises the product u against all
left vectors before it, and multiplies back, X'u, for the next right vector,
which the driver orthogonalises against all right vectors before it.  What
comes out is X ~ U B V' with a small bidiagonal B; its singular values and
vectors give deviations and components.

Left vectors have one entry per row, so they are never stored or gathered:
u = X a for a short vector a that the steps add up, and a task has its rows'
entries of all left vectors again by one small matrix product.  A task sends
back one row per step: the products of its part of the new u with all left
vectors, and its part of X'u.  Full reorthogonalisation, the norm of u and the
product back thus need one pass over the rows per step.

A start vector meets only one direction of an eigenvalue that occurs twice.
Where a step finds an invariant subspace, and once more when the wanted
components have converged, the steps go on from a new random vector.

Rows are stored once, packed many to a row of a written table; a pass reads
packed numbers only.  Sums of tasks are added up in a second small stage, so
what the driver gets grows with the square root of the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import store

#: x = floor(SCALE * entry) + SHIFT
SCALE, SHIFT = 1024, 100_000
#: Vectors in a packed row.
PACK = 2_048
PACKED = "n int, ids array<long>, x binary"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Eigenvalues below this share of the largest count as zero: no component.
LEAST = 1e-12


def packed(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """The usable vectors as whole numbers x (64 bits), many to a row of a
    written table, and their dimension: the commonest length (the larger one
    of equally common ones).

    Left out: null vectors, vectors with null or non-finite entries, and those
    of another length, which belong to no common space."""
    vectors = embeddings.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    good = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sizes = vectors.filter(good).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = sizes.d if sizes else 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PACK):
                part = batch.slice(start, PACK)
                x = np.floor(SCALE * part["v"].flatten().to_numpy(zero_copy_only=False)).astype("<i8") + SHIFT
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), pa.array([part["id"].to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["n", "ids", "x"])

    return store.table(vectors.filter(good & (F.size("v") == dimension)).mapInArrow(task, PACKED), "whitening-rows"), dimension


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], dimension: int, dtype: type = np.float64) -> np.ndarray | None:
    """Sum over all packed rows of ``part`` (matrix of x) -> vector; None
    without rows.  Whole numbers are added exactly."""

    def of(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.astype(dtype).tobytes()], pa.binary())], ["total"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch["x"]:
                own = part(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, dimension))
                total = own if total is None else total + own
        if total is not None:
            yield of(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.frombuffer(x, dtype) for batch in batches for x in batch["total"].to_pylist()]
        if totals:
            yield of(np.sum(totals, axis=0))

    sums = rows.select("x").mapInArrow(first, "total binary")
    groups = max(1, isqrt(rows.rdd.getNumPartitions()))
    got = [np.frombuffer(x, dtype) for x in sums.repartition(groups).mapInArrow(again, "total binary").toArrow()["total"].to_pylist()]
    return np.sum([g.astype(object) if dtype is np.int64 else g for g in got], axis=0) if got else None


@dataclass
class Spectrum:
    """n, exact sums per dimension, and the leading eigenvalues (falling) and
    unit eigenvectors (columns) of the covariance, with its trace."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    steps: int = 0


def _against(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` without its parts along the columns of ``basis``, twice over."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(rows: DataFrame, mean: np.ndarray, n: int, want: int, tolerance: float = 1e-13, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """Leading ``want`` eigenvalues and eigenvectors of the covariance of the
    packed rows around ``mean``, and the number of steps."""
    d = len(mean)
    random = np.random.default_rng(seed)
    steps = min(d, n)
    v_all, a_all, p_all, b = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((0, 0))
    waiting, again, norm = [], False, 0.0
    v = random.standard_normal(d)
    v /= np.linalg.norm(v)
    for k in range(steps):
        v_all = np.column_stack([v_all, v])
        known = p_all.T @ v  # products of Xv with the left vectors so far: the one before, save after a new start
        fresh = v - a_all @ known
        coefficients = np.column_stack([a_all, fresh])

        def part(x: np.ndarray, c: np.ndarray = coefficients) -> np.ndarray:
            y = x - mean
            u = y @ c
            return np.concatenate([u[:, -1] @ u, u[:, -1] @ y])

        got = summed(rows, part, d)
        along, square, back = got[:k], got[k], got[k + 1 :]
        alpha = float(np.sqrt(max(square - along @ along, 0.0)))
        norm = max(norm, alpha)
        b = np.pad(b, (0, 1))
        b[:k, k] = known + along
        if alpha > tolerance * norm:
            b[k, k] = alpha
            a_all = np.column_stack([a_all, (fresh - a_all @ along) / alpha])
            p_all = np.column_stack([p_all, (back - p_all @ along) / alpha])
            waiting.append(p_all[:, -1])
        else:  # no variance beside that of the vectors before
            a_all, p_all = np.column_stack([a_all, np.zeros(d)]), np.column_stack([p_all, np.zeros(d)])
        left, singular, right = np.linalg.svd(b)
        off = np.linalg.norm((p_all - v_all @ (v_all.T @ p_all)) @ left[:, :want], axis=0)
        if len(singular) >= want and (off <= tolerance * singular[0]).all():
            if again:
                break
            again = True
            waiting.insert(0, norm * random.standard_normal(d))
        if k + 1 == steps:
            break
        size = 0.0
        while size <= tolerance * norm:
            r = _against(waiting.pop(0) if waiting else (norm or 1.0) * random.standard_normal(d), v_all)
            size = float(np.linalg.norm(r))
        v = _against(r / size, v_all)
        v /= np.linalg.norm(v)
    return singular[:want] ** 2 / n, (v_all @ right.T)[:, :want], len(b)


def spectrum(rows: DataFrame, dimension: int, components: int = 8) -> Spectrum | None:
    """Mean, trace and leading components of the packed rows; None without any."""
    first = summed(rows, lambda x: np.append(x.sum(axis=0), len(x)), dimension, np.int64) if dimension else None
    if first is None:
        return None
    *sums, n = (int(x) for x in first)
    mean = np.array([s / n for s in sums])
    trace = float(summed(rows, lambda x: np.array([((x - mean) ** 2).sum()]), dimension)[0]) / n
    if not trace:
        return Spectrum(n, sums, mean, np.zeros(0), np.zeros((dimension, 0)), trace)
    values, vectors, steps = bidiagonalise(rows, mean, n, min(components, dimension, n))
    some = values > LEAST * values[0]
    return Spectrum(n, sums, mean, values[some], vectors[:, some] / np.linalg.norm(vectors[:, some], axis=0), trace, steps)


def identity_error(rows: DataFrame, s: Spectrum) -> float:
    """Largest entry of the whitened rows' covariance, less the identity."""
    k = len(s.values)
    scaled = s.vectors / np.sqrt(s.values)

    def part(x: np.ndarray) -> np.ndarray:
        w = (x - s.mean) @ scaled
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = summed(rows, part, len(s.mean)) / s.n
    centre = got[:k]  # of rounding size
    return float(np.abs(got[k:].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)**2, exact; null where a 64-bit number
    can't hold it."""
    bound = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums))) if len(x) else 0
    if bound**2 * len(sums) < 2**63:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in exact.tolist()]


def whiten(embeddings: DataFrame, components: int = 8, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error.

    Null, broken and odd-length vectors give no rows (see ``packed``); a null
    vec_id stays null; repeated rows count and are returned each.  Components
    without variance are left out, so one vector alone, equal vectors only or
    an empty table give no rows.  Equal eigenvalues: any orthogonal directions
    of theirs.  Other columns play no part."""
    rows, dimension = packed(embeddings, column, key)
    s = spectrum(rows, dimension, components)
    if s is None or not len(s.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    error, k = identity_error(rows, s), len(s.values)
    scaled, explained = s.vectors / np.sqrt(s.values), s.values / s.trace

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch["ids"], batch["x"], strict=True):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dimension)
                m = len(x)
                every = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, s.n)), pc.take(pa.array(deviations(x, s.n, s.sums), pa.int64()), every),
                    pa.array(((x - s.mean) @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ], RESULT.replace(" long", "").replace(" int", "").replace(" double", "").split(", "))

    return rows.mapInArrow(task, RESULT)
