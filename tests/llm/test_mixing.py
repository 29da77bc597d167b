"""Mixing: targets against a plain refill, copies against the rate."""

import random

import pytest
from pyspark.sql import functions as F

from graphload.llm import mixing
from helpers import AWKWARD, documents


def plain_targets(sizes):
    """Deal by weight, cut at twice the size, deal the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 7, 100, 5000]) for s in ["b", "a", "Z", "é", None, "", "c1"]}
    rows = [(s, n) for s, n in sizes.items()]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, size long"))
    got = {r.source: r.target for r in found.collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 40), "en", rng.choice(["big"] * 6 + ["small", None]))
            for i in range(3000)]
    docs = documents(spark, rows)
    judged = mixing.with_copies(docs).cache()
    by_source = judged.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    for r in by_source.collect():
        assert abs(r.taken - r.target) <= 0.1 * r.target
    assert judged.filter("copies > 2 or copies < 0").isEmpty()
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert sorted(out.groupBy("doc_id").count().collect()) == sorted(
        judged.filter("copies > 0").select("doc_id", F.col("copies").cast("long")).collect())
    # reruns and another layout agree
    again = mixing.with_copies(docs.repartition(7))
    assert sorted(again.select("doc_id", "copies").collect()) == sorted(
        judged.select("doc_id", "copies").collect())


def test_awkward(spark):
    docs = documents(spark, AWKWARD, extra=True)
    judged = mixing.with_copies(docs).collect()
    assert len(judged) == len(AWKWARD)
    assert {r["size"] for r in judged if r.doc_id in (1, 2, 3)} == {0}
    assert len({r.copies for r in judged if r.doc_id == 4}) == 1
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(documents(spark, [])).count() == 0
