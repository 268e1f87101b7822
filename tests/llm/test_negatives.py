"""Hard negatives against plain Python, the bounds, and odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from riskflow.llm import negatives


def mined(rows, k=5, share=80):
    """The contract by comparing each anchor with all rows."""
    kept = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for i, y, v in kept:
        if i % 100 or (i, y, tuple(v)) in done:
            continue
        done.add((i, y, tuple(v)))
        others = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in kept if j != i and len(w) == len(v))
        for s, j, _ in [o for o in others if o[2] == y][:k]:
            band = [o for o in others if o[2] != y and share * -s <= 100 * -o[0] <= 100 * -s]
            out += [(i, j, r, b[1], -s, -b[0]) for r, b in enumerate(band[:k], 1)]
    return out


def clustered(n, d, labels, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    v = (centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, d))).astype(np.float32)
    v[n // 2 :: 9] = v[3]  # ties
    return [(i, v[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("d", [1, 5, 16, 24, 64])
def test_bounds_hold(d):
    rng = np.random.default_rng(d)
    v = rng.integers(-300, 300, (80, d)) + rng.integers(-200, 200, (80, 1))
    exact = v @ v.T
    means, devs = negatives.summaries(v)
    import pyarrow as pa

    lists = [pa.array([row.tolist() for row in x]) for x in (v, means, devs)]
    side = negatives.Side(pa.table([pa.array(range(80)), pa.array([0] * 80), *lists], names=["vec_id", "label", "v", "means", "devs"]))
    low, high = negatives._first_bounds(side, side, slice(0, 80))
    assert (low <= exact).all() and (exact <= high).all()
    i, j = np.divmod(np.arange(6400), 80)
    lower, upper = negatives._last_bounds(side, side, i, j)
    assert (lower <= exact.ravel()).all() and (exact.ravel() <= upper).all()
    assert (upper - lower).sum() <= (high - low).sum() + 1


@pytest.mark.parametrize("blocks", [{}, {"row_block": 30, "anchor_block": 2}])
def test_equal_to_all_pairs(spark, blocks):
    rows = clustered(1200, 24, 4) + [(3000 + i, [float(i % 3)] * 7, i % 2) for i in range(200)]
    table = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<float>, label int, d int, anchor string, means double")
    got = [tuple(r) for r in negatives.mine(table, **blocks).collect()]
    assert len(got) > 200 and sorted(got) == sorted(mined(rows))


def test_a_label_that_most_rows_share(spark):
    rows = [(i, v, 0 if i % 10 else y) for i, v, y in clustered(900, 16, 5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in negatives.mine(table, row_block=64).collect()) == sorted(mined(rows))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2),
        (4, None, 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [1.0, 0.4], None), (None, [1.0, 0.5], 2),
        (100, [], 1), (101, [], 1), (102, [], 2), (200, [0.0, 0.0], 1), (300, [-1.0, -1.0], 3), (301, [1.0, 1.0], 3), (400, [2.0, 2.0, 2.0], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in negatives.mine(table).collect()]
    assert sorted(got) == sorted(mined(rows)) and (0, 1, 1, 2, 256 * 256 + 128 * 128, 230 * 256 + 128 * 128) in got
    assert negatives.mine(table.limit(0)).count() == 0
    assert negatives.mine(table.where("label = 1")).count() == 0
