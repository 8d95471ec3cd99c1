from __future__ import annotations

import random

import numpy as np
import pytest

from catchframe.llm import topk


def brute(rows, k):
    out, usable = [], []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    for i, q in usable:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def run(spark, rows, k=20, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS block")
    return sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k, **options).collect())


def test_against_brute_force(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, [round(r.gauss(0, 0.03)) / 64 for _ in range(12)]) for i in range(200)]  # many ties
    rows += [(600, None), (601, [None] * 12), (602, [float("nan")] * 12), (603, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (620, []), (640, [0.5] * 3)]
    assert run(spark, rows, 7, block_rows=60) == brute(rows, 7)


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0, -1.0]), (1, [0.5, 0.5]), (20, [-2.0, 0.1])]) == brute([(0, [1.0, -1.0]), (1, [0.5, 0.5]), (20, [-2.0, 0.1])], 20)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_sliced_sums():
    g = np.random.default_rng(0)
    for rows, low, high in ((1, -5, 5), (130, -40, 40), (200, 0, 1), (64, 7, 8)):
        values = g.integers(low, high, (rows, 9))
        block = topk.SlicedBlock(np.arange(rows), values)
        query = g.integers(-33, 33, 9)
        ids, scores = block.top(query, -1, rows)
        assert len(ids) == rows and (scores == values[ids] @ query).all()


def test_large_components(spark):
    """No component is cut; scores that 64 bits cannot hold are an error, not another score."""
    rows = [(0, [256.0, 0.0]), (1, [300_000.0, 0.0]), (2, [400_000.0, 0.0]), (3, [-1e6, 5.0]), (20, [0.0, 1e6])]
    assert run(spark, rows) == brute(rows, 20)
    assert [r[2] for r in run(spark, rows) if r[0] == 0][:2] == [2, 1]
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [1e9, 1e9]), (1, [1e9, 1e9])])
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, [1.0]), (1, [1e30])])
