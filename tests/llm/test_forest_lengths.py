"""Vectors of several lengths in one table, against all pairs of equal length."""

from __future__ import annotations

import numpy as np

from riskflow.llm import forest


def test_vectors_of_each_length_are_compared(spark):
    rng = np.random.default_rng(4)
    rows = []
    for d, n, copies in ((8, 150, 3), (5, 60, 2), (12, 1, 2)):
        base = rng.normal(size=(n, d))
        rows += [v for k in range(copies) for v in base + rng.normal(size=base.shape) * 0.15 * k]
    rows += [rows[460], np.array([2.0]), np.array([3.0]), np.array([-1.0])]  # an equal copy; vectors of length 1
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    want = []
    for i, v in enumerate(rows):
        want.append(sum(len(w) == len(v) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9 for k, w in enumerate(rows) if k != i))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    for leaf_rows in (400, 100):  # one leaf for each length; a forest for the commonest
        got = {r.vec_id: r.n_links for r in forest.near_duplicates(table, leaf_rows=leaf_rows, margin=0.3).collect()}
        assert [got[i] for i in range(len(rows))] == want
