"""Whitening against NumPy on the whole table, odd rows, clustered eigenvalues."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelweave.llm import q_whitening, whitening

SF = "/root/testdata/sf0.01"


def plain(rows):
    """(component count, n, {row place: deviation}, whitened matrix, explained) of (id, vector) rows."""
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    w, v = np.linalg.eigh(y.T @ y / n)
    w, v = w[::-1], v[:, ::-1]
    k = min(16, len(w))
    return n, [int(d) for d in ((n * x - s).astype(object) ** 2).sum(axis=1)], ((n * x - s) / n) @ v[:, :k] / np.sqrt(w[:k]), w[:k] / w.sum()


def test_query_equals_numpy(spark):
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    n, far, want, share = plain(rows)
    got = q_whitening.query(spark, SF).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in got] == [(i, c) for i, _ in rows for c in range(1, 17)]
    assert {r.n for r in got} == {n} and [r.deviation for r in got[::16]] == far
    found = np.array([r.whitened for r in got]).reshape(-1, 16)
    assert np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() < 1e-10
    assert np.abs(np.array([r.explained for r in got[:16]]) - share).max() < 1e-12
    assert {r.identity_error < 1e-12 for r in got} == {True} and len({r.identity_error for r in got}) == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [3.0, 2.5], 2), (None, [0.0, -7.25], 3), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [1.0, -inf], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1), (9, [0.5, 0.5], 1), (9, [0.5, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int")
    got = whitening.whiten(df).collect()
    kept = [(i, v) for i, v, _ in rows if v in ([1.0, 2.0], [3.0, 2.5], [0.0, -7.25], [0.5, 0.5])]
    n, far, _, _ = plain(kept)
    assert n == 4 and len(got) == 2 * len(kept)
    assert sorted((r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted((i or 0, d) for (i, _), d in zip(kept, far, strict=True))
    assert got[0].identity_error < 1e-12
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id = 7")).count() == 0
    alone = whitening.whiten(df.filter("vec_id = 1")).collect()
    assert {(r.whitened, r.deviation, r.explained, r.n) for r in alone} == {(None, 0, 0.0, 1)}
    doubles = whitening.whiten(df.withColumn("embedding", F.col("embedding").cast("array<double>"))).count()
    assert doubles == len(got)


def test_line_has_one_component_with_extent(spark):
    df = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id") * 1.0, F.col("id") * 2.0, F.lit(3.0)).alias("embedding"))
    got = whitening.whiten(df).collect()
    assert {r.component for r in got if r.whitened is not None} == {1} and {r.component for r in got} == {1, 2, 3}
    assert abs(np.var([r.whitened for r in got if r.component == 1]) - 1) < 1e-12 and got[0].identity_error < 1e-12


@pytest.mark.parametrize("values", [[9, 5, 4, 1], [5, 5 + 1e-9, 5 + 3e-9, 3, 3 + 1e-7, 1e-3], [7] * 4 + [2] * 4 + [0] * 3, [1e6, 1, 1e-6, 0, 0], list(range(1, 60))])
def test_eigenvectors_of_clusters(values):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (3 * np.eye(len(q)) - q.T @ q) / 2
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    w, v = whitening.eigenpairs(a)
    assert np.abs(w - np.sort(values)[::-1]).max() <= 1e-14 * max(values)
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 2e-15
    # Each vector lies in the space of the eigenvalues that cannot be told from its own.
    order = np.argsort(-np.array(values), kind="stable")
    for i, x in enumerate(v):
        alike = [j for j in order if abs(values[j] - w[i]) <= 1e-10 * max(values)]
        others = [j for j in order if j not in alike]
        assert float(np.abs(x @ q[:, others]).max(initial=0)) < 1e-8


def test_deviation_beyond_doubles_is_exact():
    x = np.array([[1_000_000 + 2**40, 1_000_000], [1_000_000, 1_000_001]])
    sums = [2_000_000 + 2**40, 2_000_001]
    assert whitening._deviation(x, 2, sums) == [2**80 + 1, 2**80 + 1]
