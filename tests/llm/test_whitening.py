"""Whitening against numpy's eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from quarry.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def reference(vectors, k=8):
    """x, eigenvalues, eigenvectors, deviations and trace by the plain way."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    off = x - sums / n
    cov = off.T @ off / n
    values, vecs = np.linalg.eigh(cov)
    return off, values[::-1][:k], vecs[:, ::-1][:, :k], [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x], np.trace(cov)


def frame(spark, vectors, ids=None):
    """Rows with extra columns whose names clash with results'."""
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, component int, whitened string")


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    got = queries.op11_embedding_whitening(spark, SF).toPandas()
    off, values, vecs, dev, trace = reference(np.stack(table.embedding))
    want = off @ vecs / np.sqrt(values)
    have = got.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert np.abs(have * np.sign((have * want).sum(axis=0)) - want).max() < 1e-9
    assert got.groupby("vec_id").deviation.first().loc[table.vec_id].tolist() == dev and set(got.n) == {len(table)}
    assert np.allclose(got.groupby("component").explained.first(), values / trace, rtol=1e-12)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], [2, 1], None, [None, 1], [nan, 1], [inf, 0], [1, 2, 3], [], [0.5, 0.25], [0.5, 0.25], [-3, 1]]
    ids = [1, None, 3, 4, 5, 6, 7, 8, 9, 9, 9]
    got = whitening.whiten(frame(spark, vectors, ids)).toPandas()
    kept = [0, 1, 8, 9, 10]
    off, values, vecs, dev, _ = reference([vectors[i] for i in kept])
    assert sorted(got.vec_id.fillna(-1)) == sorted([1, 1, -1, -1] + [9] * 6)
    assert sorted(got.deviation) == sorted(dev * 2)
    for k in (1, 2):
        have, want = sorted(got[got.component == k].whitened), off @ vecs[:, k - 1] / np.sqrt(values[k - 1])
        assert np.allclose(have, sorted(want), atol=1e-9) or np.allclose(have, sorted(-want), atol=1e-9)


@pytest.mark.parametrize("vectors", [[], [None], [[1, 2, 3]], [[1, 2]] * 5, [[]]], ids=["empty", "null", "one", "equal", "no entries"])
def test_no_variance(spark, vectors):
    got = whitening.whiten(frame(spark, vectors))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.collect() == []


@pytest.mark.parametrize(
    "vectors",
    [np.vstack([np.eye(12), -np.eye(12)]), np.random.default_rng(0).normal(size=(5, 20)), np.random.default_rng(1).normal(size=(300, 30)) * np.r_[9, 9, 9, 5, np.full(26, 0.1)], np.random.default_rng(2).normal(size=(50, 3)), np.repeat(np.random.default_rng(3).normal(size=(4, 16)), 30, axis=0)],
    ids=["equal eigenvalues", "fewer rows than dimensions", "early end", "few dimensions", "groups of copies"],
)
def test_eigenpairs(spark, vectors):
    rows, dimension = whitening.packed(frame(spark, vectors))
    s = whitening.spectrum(rows, dimension)
    off, values, _, _, trace = reference(vectors)
    values = values[values > 1e-9 * values[0]]
    assert len(s.values) == len(values) and np.allclose(s.values, values, rtol=1e-10) and np.isclose(s.trace, trace)
    left = off.T @ (off @ s.vectors) / len(off) - s.vectors * s.values
    assert np.abs(left).max() < 1e-9 * values[0]
    assert np.abs(s.vectors.T @ s.vectors - np.eye(len(values))).max() < 1e-12
    assert whitening.identity_error(rows, s) < 1e-10


def test_steps_end_early(spark):
    vectors = np.random.default_rng(4).normal(size=(400, 60)) * np.r_[20 / (1 + np.arange(8)), np.full(52, 0.01)]
    rows, dimension = whitening.packed(frame(spark, vectors))
    assert whitening.spectrum(rows, dimension).steps < 60


def test_large_deviations():
    x = np.array([[100_000 + 10_000_000, 100_000], [100_000, 100_000]])
    n = 1_000
    sums = (x.sum(axis=0) * 500).tolist()
    assert whitening.deviations(x, n, sums) == [None, None]
    assert whitening.deviations(x[:, 1:], n, sums[1:]) == [0, 0]
