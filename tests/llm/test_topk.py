"""Top-k search against whole scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphload.llm import topk


def plain(rows, k, scale=256):
    fine = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in fine:
        if i % 5 == 0:
            asked[i] = max(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k=3, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(frame, F.col("vec_id") % 5 == 0, k, **options)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("dims", [1, 8, 21])
def test_random(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(int(i), rng.normal(size=dims).astype(np.float32).tolist()) for i in range(300)]
    # few distinct values, so that scores tie
    rows += [(1000 + i, [random.Random(i % 3).choice([0.5, -0.25])] * dims) for i in range(60)]
    assert search(spark, rows, query_block=7) == plain(rows, 3)


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [1.0]), (5, [3.0]), (1, None), (2, [nan, 1.0]),
            (3, [inf]), (4, [None, 1.0]), (None, [1.0, 1.0]), (6, []), (10, [3e38, -3e38]),
            (7, [0.0, 0.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0])]
    small = [r for r in rows if r[0] != 10]
    assert search(spark, small) == plain(small, 3)
    assert len(search(spark, rows)) == 9
    assert search(spark, [(5, [1.0])]) == []
    assert search(spark, []) == []


def test_huge_scores(spark):
    """What does not fit 64 bits is at the end of their range, on the right side."""
    rows = [(0, [1e10, 1e10]), (1, [1e10, 1e10]), (2, [1e10, -1e10]), (3, [1.0, 2.0]),
            (4, [-1e10, -1e10]), (6, [1e9, 1e9]), *[(i, [float(i), 1.0]) for i in range(11, 40)]]
    clip = lambda x: max(1 - 2 ** 63, min(2 ** 63 - 1, x))
    expected = {(q, i): clip(s) for q, _, i, s in plain(rows, 99)}
    found = search(spark, rows, k=99)
    assert {(q, i): s for q, _, i, s in found} == expected
    for q in {q for q, _ in expected}:
        mine = [(-s, i) for a, _, i, s in sorted(found) if a == q]
        assert mine == sorted(mine) and [r for a, r, _, _ in sorted(found) if a == q] == list(
            range(1, len(mine) + 1))
    assert [i for q, _, i, _ in search(spark, rows, k=2) if q == 0] == [1, 6]


def test_pruning():
    """Most candidates are dropped before their last dimensions."""
    rng = np.random.default_rng(0)
    columns = np.floor(256 * rng.normal(size=(64, 4096)) / 8).astype(np.int64)
    columns[:, :8] = columns[:, 8:9] + rng.integers(-2, 3, (64, 8))
    s = topk.Searcher(np.array([9]), columns[:, 8:9], 5)
    s.add(np.arange(4096), columns)
    whole = columns[:, 8] @ columns
    whole[9] = -10 ** 12
    assert s.best[0][1].tolist() == np.lexsort((np.arange(4096), -whole))[:5].tolist()
    assert s.scored < 200
