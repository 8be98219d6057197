"""The threshold algorithm against brute force."""

import math

import numpy as np
import pytest

from veilspark.llm.topk import SortedLists, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k, scale=1024.0):
    ok = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (qi, q) in enumerate(ok):
        if qi % every == 0:
            hits = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), i) for b, (i, v) in enumerate(ok) if b != a)
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(hits[:k], 1)]
    return sorted(out)


def some(n, d, seed):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) / 8).astype(np.float32)
    x[n // 2 : n // 2 + n // 10] = x[0]
    return [(i, [float(y) for y in v]) for i, v in enumerate(x)]


def got(df, **kw):
    return sorted(map(tuple, top_k(df, **kw).collect()))


@pytest.mark.parametrize("block_rows", [10_000, 60])
def test_equals_brute_force(spark, block_rows):
    rows = some(600, 6, 1)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), every=20, block_rows=block_rows) == brute(rows, 20, 10)


def test_stops_before_the_end():
    """With few dimensions the bound is met long before the lists end."""
    rng = np.random.default_rng(2)
    values = rng.integers(-1000, 1000, (5000, 3))
    lists = SortedLists(np.arange(5000), np.arange(5000), values)
    for _ in range(20):
        q = rng.integers(-1000, 1000, 3)
        rows, scores, depth = lists.best(-1, q, 10)
        want = sorted((-int(s), i) for i, s in enumerate(values @ q))[:10]
        assert [(-int(s), int(i)) for i, s in zip(rows, scores, strict=True)] == want
        assert depth < 5000


def test_ties_at_the_bound():
    """An unseen row that equals the kth score and has a smaller id must still come in."""
    values = np.zeros((500, 2), np.int64)
    values[:, 0] = 5
    lists = SortedLists(np.arange(500), np.arange(500)[::-1].copy(), values)
    rows, scores, _ = lists.best(-1, np.array([1, 0]), 10)
    assert lists.ids[rows].tolist() == list(range(10)) and set(scores.tolist()) == {5}


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (0, [0.5, -0.25]), (100, [0.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (None, [1.0, 1.0]), (5, []), (200, []), (6, [1.0]), (7, [1.0, 1.0, 1.0]), (-100, [-0.0004, 0.9]), (8, [0.5, -0.25]), (8, [0.5, -0.25]),
    ]
    assert got(spark.createDataFrame(rows, SCHEMA), k=5) == brute(rows, 100, 5)
    assert got(spark.createDataFrame(rows, SCHEMA), k=50, block_rows=3) == brute(rows, 100, 50)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0])], SCHEMA)) == []


def test_large_components_and_other_columns(spark):
    rows = [(0, [1e9, -1.0, 3.0]), (1, [2e9, 5.0, 1.0]), (2, [-2e9, 1.0, 1.0]), (3, [1e6, 2.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rid int, score int")
    big = [(q, r, i, min(max(s, -(2**63)), 2**63 - 1)) for q, r, i, s in brute(rows, 100, 10)]
    assert got(df) == big
