"""E8 decoding by exhaustive search; links, counts and classes against all pairs."""

import math

import numpy as np
import pytest

from sluice.llm import lattice_dedup as L


def test_roots_and_nearest_points():
    roots = L._roots()
    assert roots.shape == (240, 8) and np.allclose((roots ** 2).sum(1), 2)
    x = np.random.default_rng(0).normal(size=(300, 8)) * 2
    near = L.nearest_e8(x)
    twice = 2 * near
    assert np.allclose(twice, np.rint(twice)) and np.allclose(near.sum(1) % 2, 0)
    assert ((x - near) ** 2).sum(1).max() <= 1 + 1e-9  # the covering radius is 1
    for r in roots:  # no neighbour is nearer
        assert (((x - near) ** 2).sum(1) <= ((x - near - r) ** 2).sum(1) + 1e-9).all()


def vectors(n_groups=30, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(n_groups):
        base = rng.normal(size=dim)
        for k in range(rng.integers(1, 9)):
            noise = rng.normal(size=dim) * rng.choice([0, 0.02, 0.15, 0.3])
            out.append((g % 3, (base * rng.choice([1, 2.5]) + noise).astype(np.float32).tolist()))
    return out


def brute(rows, threshold=0.93):
    good = [label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    parent, count = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    for i in (a, b):
                        count[rows[i][0]] += 1
                    p, q = find(rows[a][0]), find(rows[b][0])
                    parent[max(p, q)] = min(p, q)
    return {i: (count[i], find(i)) for i, _, _ in rows}


@pytest.mark.parametrize("block", [2048, 4])
def test_links_match_all_pairs(spark, block):
    rows = [(i, v, label) for i, (label, v) in enumerate(vectors())]
    n = len(rows)
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(40)]  # a hot vector
    rows += [(n + 50, None, 1), (n + 51, [0.0] * 16, 1), (n + 52, [float("nan")] * 16, 1), (n + 53, [], 1), (n + 54, rows[0][1], None),
             (n + 55, [1.0, None], 1), (n + 56, [1.0, float("inf")], 1), (n + 57, [1.0, 2.0], 1), (n + 58, [1.0, 2.0], 1), (n + 59, [1.0, 2.01], 1)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    # small vectors of little dimension: many tables, so that no pair is missed by chance
    out = L.near_vectors(df, tables=24, probes=4, block=block).collect()
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows])
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == want
    assert all(r.kept == (r.vec_id == r.component_id) and r.node == "own" for r in out)


def test_recall_at_the_threshold(spark):
    """Pairs at cosine 0.931 exactly, the hardest ones: at least nine in ten are found."""
    rng = np.random.default_rng(5)
    rows = []
    for g in range(300):
        x, z = rng.normal(size=64), rng.normal(size=64)
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        rows += [(2 * g, x.tolist(), 0), (2 * g + 1, (0.931 * x + math.sqrt(1 - 0.931 ** 2) * z).tolist(), 0)]
    out = L.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sum(r.n_links for r in out) >= 0.9 * 600
    assert all(r.component_id // 2 == r.vec_id // 2 for r in out)


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, None, 1)], "vec_id long, embedding array<float>, label int")
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in L.near_vectors(df).collect()), key=str)
    assert out == [(4, 1, 4, True), (None, 0, None, True), (None, 1, 4, False)]
    assert L.near_vectors(df.limit(0)).count() == 0
