import random

import pytest

from graphload.operators.propagation import NotConverged, cluster_count, peer_pressure


def brute(vertices, edges, rounds):
    labels = {v: v for v in vertices}
    for _ in range(rounds):
        votes = {v: {labels[v]: 1} for v in vertices}
        for a, b in edges:
            if a in labels and b in labels:
                votes[b][labels[a]] = votes[b].get(labels[a], 0) + 1
        after = {v: min(t, key=lambda k: (-t[k], k)) for v, t in votes.items()}
        if after == labels:
            break
        labels = after
    return labels


def frames(spark, vertices, edges):
    return (spark.createDataFrame([(v,) for v in vertices], "id bigint"),
            spark.createDataFrame(edges, "src bigint, dst bigint"))


@pytest.mark.parametrize("seed, rounds", [(1, 1), (2, 3), (3, 5)])
def test_matches_brute_force_with_a_hot_source(spark, seed, rounds):
    rnd = random.Random(seed)
    vertices = list(range(60))
    edges = [(rnd.randrange(60), rnd.randrange(62)) for _ in range(300)]
    # vertex 0 has a third of all edges
    edges += [(0, rnd.randrange(60)) for _ in range(150)]
    got = peer_pressure(*frames(spark, vertices, edges), max_iter=rounds, partial=True)
    assert dict(map(tuple, got.collect())) == brute(vertices, edges, rounds)


def test_stops_when_nothing_moves(spark):
    vertices = [1, 2, 3, 11, 12, 13, 20]
    edges = [(a, b) for group in ([1, 2, 3], [11, 12, 13]) for a in group for b in group if a != b]
    got = peer_pressure(*frames(spark, vertices, edges), max_iter=30)
    assert dict(map(tuple, got.collect())) == {1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11, 20: 20}
    assert cluster_count(got).first()[0] == 3


def test_labels_that_do_not_settle(spark):
    # two vertices that give each other their labels
    edges = [(1, 2), (2, 1), (1, 2), (2, 1)]
    assert peer_pressure(*frames(spark, [1, 2], edges), max_iter=4, partial=True).count() == 2
    with pytest.raises(NotConverged):
        peer_pressure(*frames(spark, [1, 2], edges), max_iter=4)


def test_rounds_do_not_move_the_edges(spark):
    from graphload.operators.propagation import _laid_out, _round
    vertices, edges = frames(spark, list(range(50)), [(i, j) for i in range(50) for j in range(9)])
    laid, hot = _laid_out(edges.union(edges), 16)
    assert laid.count() == 450 and {r.weight for r in laid.collect()} == {2}
    labels = vertices.withColumn("label", vertices["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _round(labels, laid, hot, 16)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the votes of (vertex, label), the vertices, and the labels: not the edges
    assert plan.count("Exchange hashpartitioning(src") == 1


def test_many_rounds(spark):
    """A label that travels along a path takes a round for each step."""
    n = 14
    edges = [(i, i + 1) for i in range(n) for _ in range(3)]
    got = peer_pressure(*frames(spark, list(range(n + 1)), edges), max_iter=30)
    assert {r.label for r in got.collect()} == {0}


def test_tasks_grow_in_number(spark, monkeypatch):
    """The edges are dealt out by their number, and the session's settings come back."""
    from graphload.operators import propagation
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    seen = []
    laid_out = propagation._laid_out

    def noted(edges, salts):
        laid, hot = laid_out(edges, salts)
        seen.append(laid.rdd.getNumPartitions())
        return laid, hot

    monkeypatch.setattr(propagation, "_laid_out", noted)
    monkeypatch.setattr(propagation, "EDGES_PER_TASK", 20)
    vertices, edges = list(range(40)), [(i, (i * 7 + j) % 40) for i in range(40) for j in range(9)]
    got = peer_pressure(*frames(spark, vertices, edges), max_iter=2, partial=True)
    assert dict(map(tuple, got.collect())) == brute(vertices, edges, 2)
    assert seen == [18] and [spark.conf.get(n) for n in names] == before
