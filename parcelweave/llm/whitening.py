"""Whitening of embeddings by the eigenvectors of their covariance, in mixed precision.

Spark sums the covariance over all distinct vectors; what reaches the driver is one matrix of the
dimension of the vectors.  Its eigenvectors are found in float32 and then corrected by the iteration of
Ogita and Aishima, which needs nothing but products of matrices in a higher precision and converges
quadratically.  Where eigenvalues are too close together for the correction to tell their vectors apart,
the problem is solved anew within the space of those vectors, whose spread is then the scale.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import cut_lineage, prepare

#: Entries are multiplied by SCALE, floored and moved by SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components returned for each row.
COMPONENTS = 16
#: Corrections stop when none is larger, or after so many rounds.
SMALL, ROUNDS = 1e-17, 30
#: The precision of the matrix products: 64 bits of mantissa where the machine has them.
HIGH = np.longdouble


@dataclass
class Whitener:
    """``n`` distinct vectors with the sums ``sums`` of each entry; ``values`` and ``vectors`` (rows) of
    the covariance by falling eigenvalue, its trace, and the identity error of the fit."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def scales(self) -> np.ndarray:
        """Factor of each component, 0 where the data have no extent."""
        low = len(self.sums) * np.finfo(float).eps * max(self.trace, 0.0)
        with np.errstate(divide="ignore"):
            return np.where(self.values > low, 1 / np.sqrt(np.maximum(self.values, 0)), 0.0)


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One round of the correction of the eigenvectors (columns) ``x`` of ``a``: eigenvalues, what to add
    to the vectors in terms of themselves, and the gap up to which they cannot be told apart."""
    r = np.eye(len(a), dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    near = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return values, step, near


def _norm(m: np.ndarray) -> float:
    return np.sqrt((m * m).sum())


def _clusters(values: np.ndarray, near) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``near``, in groups of two or more."""
    order = np.argsort(values)
    cuts = np.nonzero(np.diff(values[order]) > near)[0] + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _refined(a: np.ndarray, x: np.ndarray, small: float) -> np.ndarray:
    """``x`` corrected until no correction is larger than ``small``, or none helps any more."""
    exact = 64 * float(np.finfo(x.dtype).eps)
    best, idle = np.inf, 0
    for _ in range(ROUNDS):
        values, step, near = corrected(a, x)
        x = x + x @ step
        change = float(np.abs(step).max())
        for group in _clusters(values, near):
            # The same problem within the cluster, less its middle, so that its own spread is the scale.
            part = x[:, group]
            middle = values[group].mean()
            inner = part.T @ (a @ part - middle * part)
            spread = float(np.abs(inner).max())
            if spread > exact:
                turn = np.linalg.eigh(((inner + inner.T) / (2 * spread)).astype(float))[1]
                x[:, group] = part @ turn.astype(x.dtype)
                change = max(change, float(np.abs(inner - np.diag(np.diag(inner))).max()) / spread)
        idle = 0 if change < best / 2 else idle + 1
        best = min(best, change)
        if change <= small or idle == 3:
            break
    # What noise has moved the vectors of almost equal eigenvalues leaves them out of square.
    for _ in range(2):
        x = x @ (3 * np.eye(len(a), dtype=x.dtype) - x.T @ x) / 2
    return x


def eigenpairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (rows) of a symmetric matrix, to double precision."""
    a = np.asarray(a, dtype=HIGH)
    a = (a + a.T) / 2
    size = np.abs(a).max() if a.size else HIGH(0)
    if not a.size or size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1]
    # Doubles are soon exhausted and cheap to multiply; the last rounds need more.
    x = _refined(a.astype(float), x.astype(float), 1e-10)
    x = _refined(a, x.astype(HIGH), SMALL)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(float), x[:, order].T.astype(float)


def scaled(vector: Column) -> Column:
    """Whole-number vector: floor(SCALE * entry) + SHIFT of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + F.lit(SHIFT).cast("long"))


def usable(vector: Column) -> Column:
    """True for a vector without null and non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(batches: Iterator) -> Iterator:
    """Each batch that has rows, with its last column as a matrix."""
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        if batch.num_rows:
            yield batch, column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, by way of the exact n * x - sums where that fits a long."""
    low = sums // n
    rest = sums - low * n
    near = x - low
    if n * (float(np.abs(near).max(initial=0)) + 1) < 2**53:
        return (n * near - rest) / n
    return near - rest / n


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over entries of (n * x - sums)^2."""
    low = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    near = x - low
    top = n * (int(np.abs(near).max(initial=0)) + 1)
    if top < 2**31 and top * top * max(1, x.shape[1]) < 2**63:
        y = n * near - rest
        return (y * y).sum(axis=1).tolist()
    y = n * near.astype(object) - rest.astype(object)
    return [int(v) for v in (y * y).sum(axis=1)]


def _products(n: int, sums: list[int], project: np.ndarray | None):
    """Function that sums the outer products of the centred (and projected) vectors of a task, as rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = None
        for _, x in _matrix(batches):
            y = _centred(x, n, np.array(sums, dtype=np.int64))
            y = y if project is None else y @ project
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total), pa.list_(pa.float64()))], ["row", "part"])

    return run


def _added(table):
    import pyarrow as pa

    parts = np.stack([np.asarray(p) for p in table.column("part").to_pylist()])
    # Fixed order, so that a rerun adds up alike.
    total = np.sort(parts, axis=0).sum(axis=0)
    return pa.table({"row": table.column("row").slice(0, 1), "part": pa.array([total], pa.list_(pa.float64()))})


def _second_moment(vectors: DataFrame, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """Mean of the outer products: one row of the matrix per task and then per group."""
    kind = "row long, part array<double>"
    parts = vectors.select("x").mapInArrow(_products(n, sums, project), kind).groupBy("row").applyInArrow(_added, kind)
    return np.array([r.part for r in parts.orderBy("row").collect()]) / n


def _dimension(rows: DataFrame) -> int | None:
    """The length most vectors have; of equally frequent ones the largest."""
    sizes = rows.groupBy(F.size("x").alias("d")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return None if best is None else best.d


def fit(vectors: DataFrame) -> Whitener | None:
    """The whitener of the distinct vectors ``x`` (arrays of long of one length); None without any.

    The driver holds matrices of the vectors' dimension, whatever the number of rows.
    """
    distinct = cut_lineage(vectors.groupBy("x").agg(F.count("*").alias("copies")).select("x"))
    n = distinct.count()
    if n == 0:
        return None
    each = distinct.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in each.orderBy("at").collect()]
    covariance = _second_moment(distinct, n, sums) if sums else np.zeros((0, 0))
    values, rows = eigenpairs(covariance)
    out = Whitener(n, sums, values, rows, float(np.trace(covariance)))
    count = min(COMPONENTS, len(sums))
    live = out.scales()[:count]
    if (live > 0).any():
        project = (rows[:count] * live[:, None]).T[:, live > 0]
        found = _second_moment(distinct, n, sums, project)
        out.identity_error = float(np.abs(found - np.eye(len(found))).max())
    return out


def _whitened(model: Whitener):
    count = min(COMPONENTS, len(model.sums))
    live = model.scales()[:count]
    project = (model.vectors[:count] * live[:, None]).T
    share = model.values[:count] / model.trace if model.trace > 0 else np.zeros(count)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, x in _matrix(batches):
            m = batch.num_rows
            w = _centred(x, model.n, np.array(model.sums, dtype=np.int64)) @ project
            told = pa.array(w.ravel(), pa.float64(), mask=np.tile(live == 0, m))
            far = pa.array(np.repeat(np.array(_deviation(x, model.n, model.sums), dtype=object), count).tolist(), pa.int64())
            places = np.repeat(np.arange(m), count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()), pa.array(np.full(m * count, model.n)), far, told, pa.array(np.tile(share, m)), pa.array(np.full(m * count, model.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are those of
    another length than most have (of equally frequent lengths the largest counts); where vectors are
    empty there is no component and no row.  Equal vectors count once in the fit, whatever their number,
    but every row is answered; null and repeated ids are answered as they are.  A component along which
    the data have no extent, as with fewer vectors than components, has ``whitened`` null and takes no part
    in ``identity_error``; ``explained`` is 0 where there is no extent at all.  A deviation that does not
    fit a long ends the job with an error.  An empty table gives no rows; further columns are left out.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kept = vectors.filter(usable(F.col(f"`{vector}`"))).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), scaled(F.col(f"`{vector}`")).alias("x"))
    kept = cut_lineage(kept)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dimension = _dimension(kept)
    if not dimension:
        return spark.createDataFrame([], kind)
    kept = kept.filter(F.size("x") == dimension)
    return kept.mapInArrow(_whitened(fit(kept)), kind)
