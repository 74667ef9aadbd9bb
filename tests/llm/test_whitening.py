"""Whitening against numpy's eigenvectors."""

import numpy as np
import pytest

from sluice.llm import queries
from sluice.llm import whitening as W


def plain(vectors, k):
    x = np.floor(256 * np.array(vectors, float)).astype(int)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    y = fit - total / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), (x - total / n) @ u / np.sqrt(e), e / np.trace(v)


def check(got, vectors, ids, k=4):
    n, deviation, z, shares = plain(vectors, k)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(rows) == len(got) == len(ids) * k
    mine = np.array([[rows[i, c + 1].whitened for c in range(k)] for i in ids])
    assert np.abs(mine * np.sign((mine * z).sum(axis=0)) - z).max() < 1e-8 * max(1, np.abs(z).max())
    for j, i in enumerate(ids):
        r = rows[i, 1]
        assert (r.n, r.deviation) == (n, deviation[j])
    assert np.allclose([rows[ids[0], c + 1].explained for c in range(k)], shares, rtol=1e-10)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_registered_query_over_the_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(queries.queries()["op12_embedding_whitening"](spark, sf).collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_copies_count_once_and_bad_vectors_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(60, 5)).round(3).tolist()
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(100 + i, good[0], "x") for i in range(90)]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    df = spark.createDataFrame(rows + [(1000 + i, v, "x") for i, v in enumerate(bad)], "vec_id long, embedding array<double>, component string")
    check(W.whiten(df.repartition(7)).collect(), [v for _, v, _ in rows], [i for i, _, _ in rows])


def test_defined_results_of_small_and_degenerate_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], kind)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).count() == 0  # no variance
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)] + [(None, [0.0, 0.0, 5.0])], kind)).collect()
    assert {r.component for r in line} == {1} and len(line) == 10 and abs(line[0].explained - 1) < 1e-12
    assert sum(r.vec_id is None for r in line) == 1
    # Large entries: deviations beyond 64 bits are null, projections stay finite.
    far = W.whiten(spark.createDataFrame([(i, [1e16 * i, float(i * i), 0.5]) for i in range(6)], "vec_id long, embedding array<double>")).collect()
    assert all(np.isfinite(r.whitened) for r in far) and any(r.deviation is None for r in far)


@pytest.mark.parametrize("dim", [2, 9, 33])
def test_contour_finds_close_and_equal_eigenvalues(spark, dim):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    e = np.sort(rng.uniform(0, 10, dim))[::-1]
    e[: dim // 2] = e[0]
    e[dim // 2:] = np.linspace(e[-1], e[-1] * 1.001, dim - dim // 2)[::-1]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    for wanted in {1, 2, dim // 2 + 1, dim}:
        values, vectors = W.leading_pairs(spark, a, wanted, per_interval=4)
        assert np.allclose(values, e[:wanted], atol=1e-9) and np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-10)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-9


def test_inertia_counts():
    rng = np.random.default_rng(0)
    for dim in (1, 2, 5, 20):
        for _ in range(20):
            a = rng.normal(size=(dim, dim))
            a = a + a.T
            np.fill_diagonal(a, 0 if dim > 1 and rng.random() < 0.5 else np.diag(a))
            for shift in rng.normal(size=3) * dim:
                assert W.count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
