"""Near-duplicate vectors against all cosines, and the recall of the hashing."""

import numpy as np
import pytest

from graphload.llm import crosspolytope as cp
from graphload.llm.common import local_components


def plain(rows, threshold=cp.COSINE):
    """{(id, links, component)} over the distinct (id, vector) rows."""
    distinct = {(i, None if v is None else tuple(v)) for i, v in rows}
    fine = sorted((i, v) for i, v in distinct if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v))
    width = max(len(v) for _, v in fine)
    m = np.array([list(v) + [0] * (width - len(v)) for _, v in fine], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    close = m @ m.T >= threshold
    np.fill_diagonal(close, False)
    ids = [i for i, _ in fine]
    label = local_components(len(ids), *np.nonzero(close))
    out = {(i, 0, i) for i, v in distinct if (i, v) not in set(fine)}
    return out | {(i, int(n), ids[c]) for i, n, c in zip(ids, close.sum(axis=1), label)}


def near(spark, rows, **options):
    frame = spark.createDataFrame([r + (1,) for r in rows],
                                  "vec_id long, embedding array<float>, rep int")
    found = cp.near_vectors(frame, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return [(r.vec_id, r.n_links, r.component_id) for r in found]


@pytest.mark.parametrize("bucket", [cp.BUCKET, 5])
def test_groups(spark, bucket):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 20))
    rows = []
    for i in range(240):
        v = centres[i % 25] + rng.normal(size=20) * rng.choice([0.0, 0.05, 0.3])
        rows.append((int(rng.permutation(10000)[0]) * 1000 + i, v.astype(np.float32).tolist()))
    # the groups have near copies at all distances, so recall is that of single pairs
    got, expected = near(spark, rows, bucket=bucket), plain(rows)
    links = sum(n for _, n, _ in got)
    whole = sum(n for _, n, _ in expected)
    assert links <= whole and links >= 0.99 * whole
    by_id = {i: n for i, n, _ in expected}
    assert all(n <= by_id[i] for i, n, _ in got)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * off
    a, b = cp.bucket_codes(x), cp.bucket_codes(y)
    met = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=(1, 2))
    assert met.mean() >= 0.99


def test_transform():
    x = np.eye(8)
    h = cp._hadamard(x)
    assert np.allclose(h @ h.T, np.eye(8))
    assert np.allclose(np.abs(h), 8 ** -0.5)


def test_hot_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(5000, [1.0, 2.0, 3.0, 4.1]),
                                                               (6000, [-1.0, 0.0, 0.0, 0.0])]
    got = {i: (n, c) for i, n, c in near(spark, rows)}
    assert got[0] == (3000, 0) and got[2999] == (3000, 0)
    assert got[5000] == (3000, 0) and got[6000] == (0, 6000)


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1e30, 1e25]), (4, [1e-30, 0.0]), (5, None),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [0.0, 0.0]), (10, []),
            (11, [1.0]), (1, [1.0, 0.0]), (12, [-1.0, 0.0])]
    got = near(spark, rows)
    assert len(got) == len(rows)
    assert set(got) == plain(rows)
    assert near(spark, [(None, [1.0])]) == [(None, 0, None)]
    assert near(spark, []) == []


def test_lengths_apart_in_batches(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(30):
        short = rng.normal(size=3).tolist()
        rows += [(2 * i, short), (2 * i + 1, short + [0.0] * 61)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        assert set(near(spark, rows)) == plain(rows)
    finally:
        spark.conf.set(name, before)
