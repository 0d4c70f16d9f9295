"""Exact search against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import vector_search as V

NAN, INF = float("nan"), float("inf")


def plain(rows, k=5):
    kept = [
        (i, r, [math.floor(256 * x) for x in v]) for r, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, r, v in kept:
        if i is None or i % 50:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, s, w in kept if s != r and len(w) == len(v)
        )
        out += [(i, n, None if null else j, -score) for n, (score, null, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, config=V.SearchConfig()):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = V.top_k(df.repartition(4), F.col("vec_id") % 50 == 0, config=config)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("config", [V.SearchConfig(), V.SearchConfig(portion=40, block=2, segments=(1, 3, 7))])
def test_by_all_products(spark, config):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(5, 24))
    vectors = (centres[draw.integers(0, 5, 400)] + 0.1 * draw.normal(size=(400, 24))).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(1000 + k, rows[0][1]) for k in range(30)]  # ties
    rows += [(2000, None), (2050, [NAN] * 24), (2100, [INF] + [0.0] * 23), (2150, [None] + [1.0] * 23)]
    rows += [(2200, [1.0, 2.0]), (2201, [3.0, -1.0]), (2250, []), (2251, []), (0, rows[3][1]), (None, rows[0][1])]
    assert found(spark, rows, config) == plain(rows)


def test_wide_components():
    big = np.array([[2**40, -(2**40)], [2**40, 2**40]], dtype=np.int64)
    got = V.exact_products(np.array([2**40, 2**40], dtype=np.int64), big)
    assert got.tolist() == [0, 2**63 - 1]
    small = np.array([[2**29, 1], [3, 4]], dtype=np.int64)
    assert V.exact_products(np.array([2**29, 7]), small).tolist() == [2**58 + 7, 3 * 2**29 + 28]


def test_bounds_hold():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(50, 30)), draw.normal(size=(60, 30))
    last = None
    for s in (1, 2, 4, 8, 30):
        bound = V.segment_features(x, s) @ V.segment_features(y, s).T
        assert (bound >= x @ y.T - 1e-9).all()
        last = bound
    assert np.allclose(last, x @ y.T)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
