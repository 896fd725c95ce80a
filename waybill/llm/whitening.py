"""Whitening of embeddings by the eigenvectors of their distributed covariance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import written

COMPONENTS = 16
# Entries are whole numbers of this size at most: floats hold them, and their squares' sums, well.
_LARGEST = float(2**40)
_EPS = np.finfo(np.longdouble).eps


def lattice(vector: Column, scale: int, offset: int) -> Column:
    """Entries as whole numbers: floor(scale * entry) + offset."""
    return F.transform(
        vector,
        lambda c: F.floor(
            F.greatest(F.least(c.cast("double") * scale, F.lit(_LARGEST)), F.lit(-_LARGEST))
        ) + F.lit(offset).cast("long"),
    )


def _clean(vector: Column) -> Column:
    """Not null, not empty, and no entry is null, infinite or not a number."""
    bad = F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


# --- refinement of eigenvectors ---

def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One correction of all eigenvectors by matrix products.

    Gives the new vectors, their eigenvalues, the correction, and the gap below which two
    eigenvalues can't be told apart by it.
    """
    lack = np.eye(len(a), dtype=x.dtype) - x.T @ x
    inner = x.T @ (a @ x)
    lack, inner = (lack + lack.T) / 2, (inner + inner.T) / 2  # so that corrections keep right angles
    value = np.diag(inner) / (1 - np.diag(lack))
    off = inner - np.diag(value)
    gap = 2 * (np.linalg.norm(off.astype(float)) +
               np.linalg.norm(a.astype(float)) * np.linalg.norm(lack.astype(float)))
    apart = value[None, :] - value[:, None]
    far = np.abs(apart) > gap
    turn = np.where(far, (inner + value[None, :] * lack) / np.where(far, apart, 1), lack / 2)
    return x + x @ turn, value, turn, float(gap)


def _clusters(value: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of neighbouring eigenvalues that are within ``gap`` of each other, if several."""
    order = np.argsort(value)
    cuts = np.flatnonzero(np.diff(value[order]) > gap) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def eigen(a: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors (columns) of a symmetric matrix, to
    the last bits of a double.

    Start: eigenvectors in float32. They are corrected by matrix products in extended precision
    (Ogita and Aishima), which doubles the number of right digits each time for eigenvalues that
    stand apart. Vectors of eigenvalues that are too close to be told apart span the right
    space but may be turned within it: there the matrix, shifted by the eigenvalues'
    mean and taken on that space alone, is solved by itself, where the small differences are
    the whole spectrum, and the vectors are turned by its solution.
    """
    a = np.asarray(a, np.longdouble)
    scale = np.abs(a).max() if a.size else 0
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = (a + a.T) / (2 * scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    best = np.inf
    for _ in range(rounds):
        x, value, turn, gap = _step(a, x)
        for group in _clusters(value, max(gap, 64 * len(a) * float(_EPS))):
            space = np.linalg.qr(x[:, group].astype(float))[0].astype(np.longdouble)
            space = x[:, group] if _orthogonal(x[:, group]) else space
            shift = value[group].mean()
            inner = space.T @ (a @ space) - shift * (space.T @ space)
            size = np.abs(inner).max()
            if size > 0:  # scaled up, so that a double holds the small differences in full
                x[:, group] = space @ np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(float))[1]
        moved = float(np.abs(turn).max())
        if moved < 8 * float(_EPS) * len(a) or (moved >= best / 2 and moved < 1e-13):
            break
        best = min(best, moved)
    x, value, _, _ = _step(a, x)
    order = np.argsort(-value, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return (value[order] * scale).astype(float), x.astype(float)


def _orthogonal(x: np.ndarray) -> bool:
    return bool(np.abs(x.T @ x - np.eye(x.shape[1])).max() < 1e-6)


# --- distributed sums ---

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, all ``width`` long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(width: int):
    """Per task: number of rows, and the sum of each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            count, total = count + len(x), total + x.sum(axis=0)
        yield pa.record_batch([pa.array([count]), pa.array([total.tolist()])], names=["n", "total"])

    return run


def _products(width: int, middle: np.ndarray, project: np.ndarray | None):
    """Per task: sums and products of rows moved by ``middle``, and projected if asked for.

    Moved rows are small whole numbers, so without a projection all sums are exact.
    """
    size = width if project is None else project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            y = (_matrix(batch.column(0), width) - middle).astype(float)
            if project is not None:
                y = y @ project
            total += y.sum(axis=0)
            product += y.T @ y
        yield pa.record_batch(
            [pa.array(range(size + 1), pa.int32()),
             pa.array([*product.tolist(), total.tolist()], pa.list_(pa.float64()))],
            names=["line", "entries"],
        )

    return run


def _moments(fit: DataFrame, middle: np.ndarray, project: np.ndarray | None = None):
    """Sums and products over ``fit``; the driver gets one matrix, whatever the number of rows."""
    width = len(middle)
    size = width if project is None else project.shape[1]
    parts = fit.select("x").mapInArrow(
        _products(width, middle, project), "line int, entries array<double>"
    )
    rows = (
        parts.select("line", F.posexplode("entries").alias("column", "entry"))
        .groupBy("line", "column").agg(F.sum("entry").alias("entry"))
        .groupBy("line").agg(F.sort_array(F.collect_list(F.struct("column", "entry"))).alias("e"))
        .select("line", "e.entry").orderBy("line").collect()
    )
    table = np.array([row.entry for row in rows]) if rows else np.zeros((size + 1, size))
    return table[-1], table[:-1]


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: x -> (x - mean) @ project.

    ``n`` and ``total``: rows of the fit list and the sum of each entry, exact; ``values``: the
    eigenvalues, largest first, ``explained`` their shares of the variance; ``project``: a column for each of the
    components, scaled to variance one (zero where there is no variance);
    ``identity_error``: how far the covariance of the whitened fit list is from the identity.
    """

    n: int
    total: list[int]
    values: np.ndarray
    explained: np.ndarray
    project: np.ndarray
    identity_error: float

    @property
    def middle(self) -> np.ndarray:
        """The mean to the nearest whole number, from which rows are told."""
        return np.array([(2 * t + self.n) // (2 * self.n) for t in self.total], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times what the mean has beyond ``middle``, exact."""
        return np.array([t - self.n * int(m) for t, m in zip(self.total, self.middle)], np.int64)


def fit_whitening(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors ``x`` (array<long>, all of one length); None without vectors."""
    first = distinct.select(F.size("x").alias("width")).first()
    if first is None:
        return None
    width = first.width
    parts = distinct.select("x").mapInArrow(_sums(width), "n long, total array<long>")
    n, *total = parts.agg(
        F.sum("n"), *[F.sum(F.col("total")[i]) for i in range(width)]
    ).first()
    bare = Whitening(n, total, np.zeros(0), np.zeros(0), np.zeros((width, 0)), 0.0)
    moved, product = _moments(distinct, bare.middle)
    rest = np.array([np.longdouble(int(r)) / n for r in bare.rest])
    # Rows were told from a whole number next to the mean; at most 1/2 an entry is left.
    covariance = product.astype(np.longdouble) / n - np.outer(rest, rest)
    values, vectors = eigen(covariance)
    trace = float(np.trace(covariance))
    count = min(components, width)
    real = values[:count] > 1e-14 * width * max(trace, 0)
    scaled = np.where(real, vectors[:, :count] / np.sqrt(np.where(real, values[:count], 1)), 0)
    sums, squares = _moments(distinct, bare.middle, scaled)
    spread = squares / n - np.outer(sums / n, sums / n)
    wrong = np.abs(spread - np.eye(count))[np.ix_(real, real)]
    explained = values[:count] / trace if trace > 0 else np.zeros(count)
    return Whitening(n, total, values[:count], explained, scaled, float(wrong.max(initial=0)))


def _apply(model: Whitening):
    n, middle, rest = model.n, model.middle, model.rest
    shift = (rest.astype(np.longdouble) / n).astype(float)
    real = np.abs(model.project).max(axis=0, initial=0) > 0
    limit = float(2**62)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), len(middle)) - middle
            # n * x - S = n * y - rest; wrapped 64-bit numbers are exact if the result fits.
            with np.errstate(over="ignore"):
                deviation = ((np.int64(n) * y - rest) ** 2).sum(axis=1)
            about = ((float(n) * y - rest) ** 2).sum(axis=1)
            whitened = (y - shift) @ model.project
            whitened[:, ~real] = np.nan
            flat = pa.array(whitened.ravel(), from_pandas=True)  # NaN: null
            bounds = np.arange(len(y) + 1, dtype=np.int32) * model.project.shape[1]
            yield pa.record_batch(
                [batch.column(0), pa.array(deviation, mask=about > limit),
                 pa.ListArray.from_arrays(pa.array(bounds), flat)],
                names=["vec_id", "deviation", "whitened"],
            )

    return run


def whiten(
    embeddings: DataFrame, vector: str = "embedding", scale: int = 64, offset: int = 1_000_000,
    components: int = COMPONENTS,
) -> tuple[DataFrame, Whitening | None]:
    """Whitened vectors, and what whitens them.

    Entries become whole numbers (``lattice``). The fit list is each distinct vector once. Its
    mean and covariance are summed by tasks, in numbers that are exact (small whole
    numbers, told from the mean); the driver gets one matrix of the vectors' width, whatever the
    number of rows, and finds the eigenvectors (``eigen``). Tasks then project every row.

    Left out: rows whose vector is null or empty, holds a null or non-finite entry, or has
    another length than most of the others (of equally common lengths, the longest counts).
    Repeated rows are whitened each, and null ids stay null. Entries beyond 2**40 / ``scale`` are
    taken as that. A component without variance (fewer vectors than components, or constant
    entries) has null in ``whitened`` and 0 in ``explained``. Without any vector the result has no rows.

    Columns: vec_id, n (size of the fit list), deviation (sum of (n * x - S) ** 2, exact; null if
    a long can't hold it), whitened (array, one number per component).
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector")
    ).filter(_clean(F.col("vector")))
    width = (
        rows.groupBy(F.size("vector").alias("width")).count()
        .orderBy(F.desc("count"), F.desc("width")).first()
    )
    empty = spark.createDataFrame([], "vec_id long, n long, deviation long, whitened array<double>")
    if width is None:
        return empty, None
    told = rows.filter(F.size("vector") == width.width).select(
        "vec_id", lattice(F.col("vector"), scale, offset).alias("x")
    )
    model = fit_whitening(written(told.select("x").distinct(), "fit"), components)
    made = told.mapInArrow(_apply(model), "vec_id long, deviation long, whitened array<double>")
    return made.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened"), model
