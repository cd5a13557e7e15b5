"""Mined rows against plain enumeration: planted clusters, ties, copies, odd values; early stops keep results exact."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import hard_negatives as H


def slow(rows, every=50, positives=5, negatives=3):
    ok = {(i, lab, tuple(math.floor(256 * x) for x in e)) for i, lab, e in rows
          if i is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for i, lab, e in ok:
        if i % every:
            continue
        others = [(-sum(a * b for a, b in zip(e, f)), j, m) for j, m, f in ok if j != i and len(f) == len(e)]
        for s, j, _ in sorted(x for x in others if x[2] == lab)[:positives]:
            good = sorted(x[:2] for x in others if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n) in enumerate(good)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("rank", F.lit("x"))
    return sorted(tuple(r) for r in H.mine(df, **more).collect())


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = (centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)
    x[n // 2:n // 2 + 60] = x[0]  # a large group of copies, ties everywhere
    return [(i, int(rng.integers(0, 4)), [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("dim,shard_rows", [(8, 200), (5, 50_000), (1, 100)])
def test_rows_are_those_of_plain_enumeration(spark, dim, shard_rows):
    rows = clustered(700, dim, dim)
    assert mined(spark, rows, every=20, shard_rows=shard_rows) == slow(rows, every=20)


def test_early_stops_are_certified():
    rng = np.random.default_rng(1)
    centres = 40 * rng.normal(size=(30, 6))
    x = np.floor(256 * (centres[rng.integers(0, 30, 5000)] + rng.normal(size=(5000, 6))))
    books = H.codebooks(x[:2000], 16)
    index = H.Index(np.arange(5000), rng.integers(0, 3, 5000), x, books)
    size = np.sqrt((x * x).sum(1))
    visited = []
    scored = index._scored
    index._scored = lambda lists, q, s: visited.append(sum(hi - lo for lo, hi in lists)) or scored(lists, q, s)
    for a in range(0, 5000, 500):
        first, second = index.half_bounds(x[a:a + 1])
        ids, scores = H.positives_in(index, a, x[a], size[a], (first[0], second[0]), 5)
        exact = (x @ x[a]).astype(int)
        best = sorted((-exact[j], j) for j in range(5000) if j != a)[:5]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == best
        bounds = [b for b, _, _ in index.cells(first[0], second[0])]
        assert bounds == sorted(bounds, reverse=True)
    assert sum(visited) < 0.4 * 50_000  # most lists are never read


def test_cells_cover_every_row_once():
    x = np.floor(np.random.default_rng(2).normal(size=(300, 4)) * 50)
    index = H.Index(np.arange(300), np.zeros(300), x, H.codebooks(x, 7))
    first, second = index.half_bounds(x[:1])
    spans = [(lo, hi) for _, lo, hi in index.cells(first[0], second[0])]
    assert sorted(i for lo, hi in spans for i in range(lo, hi)) == list(range(300))
    for bound, lo, hi in index.cells(first[0], second[0]):
        assert (index.x[lo:hi] @ x[0]).max() <= bound


def test_scores_are_exact_beyond_double_precision(spark):
    big = float(1 << 22)  # 256 times this, squared, is beyond 2^53
    rng = random.Random(3)
    rows = [(i, i % 2, [big + rng.randrange(3), big - rng.randrange(2)]) for i in range(40)]
    assert mined(spark, rows, every=10) == slow(rows, every=10)
    with pytest.raises(OverflowError):
        H.scores_of(np.array([[2.0 ** 40]]), np.array([2.0 ** 40]), np.array([2.0 ** 40]), 2.0 ** 40)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (50, 1, [1.0, 2.0]), (50, 1, [1.0, 2.0]), (1, None, [1.0, 2.0]), (2, 2, None), (3, 2, [nan, 1.0]),
            (4, 2, [inf, 1.0]), (5, 2, [None, 1.0]), (None, 2, [1.0, 1.5]), (6, 2, [0.9, 1.7]), (8, 2, [0.9, 1.7]), (9, 3, [0.5, 1.0]),
            (100, 4, [1.0, 1.0, 1.0]), (101, 4, [1.0, 1.0, 0.9]), (102, 5, [0.8, 0.9, 1.0]), (150, 9, [5.0]), (200, 7, []), (201, 7, []), (202, 8, []),
            (250, 3, [-1.0, -2.0]), (300, 3, [0.0, 0.0])]
    got = mined(spark, rows)
    assert got == slow(rows)
    assert (200, 201, 1, 202, 0, 0) in got and (0, 50, 1, 6, 327680, 281600 - (281600 - 256 * 230 - 512 * 435)) in got
    assert mined(spark, []) == []
    assert mined(spark, [(50, 1, [1.0]), (1, 2, [0.8])]) == []
