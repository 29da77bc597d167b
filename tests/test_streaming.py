import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from executors import Recorder, recorded
from graphload.operators.delivery import DeliveryOptions
from graphload.operators.stats import load_stats
from graphload.sources import read_statements, read_stream
from graphload.spec import EdgeSpec, GraphTarget, Label, VertexSpec
from graphload.streaming import (
    StreamCounters, load, stream_load, stream_statements, stream_stats,
)

GRAPH = GraphTarget(4, "INT", 8, {"person": Label.of("vertex", {"name": "STRING"}, 1),
                                  "knows": Label.of("edge", {}, 2)})
SPEC = VertexSpec("person", "id", ("name",))
SCHEMA = "id string, name string"


@pytest.fixture
def folders(tmp_path):
    names = {n: str(tmp_path / n) for n in ("in", "log", "results", "dead", "state")}
    os.mkdir(names["log"])
    return names


def add(spark, folders, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(folders["in"])


def run(spark, folders, refuse=(), **options):
    rows = read_stream(spark, {"type": "file_stream", "format": "json", "path": folders["in"],
                               "schema": SCHEMA, "max_files_per_trigger": 1})
    log = folders["log"]
    query = stream_load(rows, SPEC, GRAPH, lambda: Recorder(log, refuse), folders["results"],
                        folders["dead"], DeliveryOptions(batch=2, retry=0, **options),
                        folders["state"], available_now=True)
    query.awaitTermination()


def test_stream_drops_bad_rows_and_does_not_send_twice(spark, folders):
    add(spark, folders, [("1", "a"), ("x", "b"), (None, "c"), ("2", "d")])
    run(spark, folders)
    first = recorded(folders["log"])
    assert first == ['INSERT VERTEX `person`(`name`) VALUES 1: ("a"), 2: ("d")']
    add(spark, folders, [("3", "e")])
    run(spark, folders)
    run(spark, folders)
    assert sorted(set(recorded(folders["log"])) - set(first)) == [
        'INSERT VERTEX `person`(`name`) VALUES 3: ("e")']
    assert len(recorded(folders["log"])) == 2
    results = spark.read.parquet(folders["results"])
    assert sorted(r.epoch for r in results.collect()) == [0, 1]
    stats = load_stats(results).filter("entity = 'person'").first()
    assert (stats.batch_success, stats.record_success) == (2, 3)


def test_dead_letters_of_every_micro_batch_are_kept(spark, folders):
    add(spark, folders, [("1", "a"), ("2", "b")])
    run(spark, folders, refuse=['"b"'])
    add(spark, folders, [("3", "b")])
    run(spark, folders, refuse=['"b"'])
    lines = sorted(r.statement for r in read_statements(spark, folders["dead"]).collect())
    head = "INSERT VERTEX `person`(`name`) VALUES "
    assert lines == [head + '2: ("b")', head + '3: ("b")']


def test_a_replayed_micro_batch_replaces_its_results(spark, folders):
    add(spark, folders, [("1", "a"), ("2", "b")])
    run(spark, folders, refuse=['"b"'])
    # the end of the micro-batch was not recorded, so it runs again under its number
    commits = os.path.join(folders["state"], "commits")
    for name in os.listdir(commits):
        if name.strip(".").split(".")[0] == "0":
            os.remove(os.path.join(commits, name))
    run(spark, folders, refuse=['"b"'])
    results = spark.read.parquet(folders["results"])
    assert results.agg(F.sum("records")).first()[0] == 2
    assert read_statements(spark, folders["dead"]).count() == 1


def test_a_stream_that_starts_anew_keeps_the_dead_letters_of_the_first(spark, folders):
    add(spark, folders, [("1", "a"), ("2", "b")])
    run(spark, folders, refuse=['"b"'])
    folders["state"] += "2"
    run(spark, folders, refuse=['"b"'])
    assert spark.read.parquet(folders["results"]).select("query").distinct().count() == 2
    assert read_statements(spark, folders["dead"]).count() == 2


def test_intake_is_capped_per_micro_batch(spark, folders):
    for i in range(3):
        add(spark, folders, [(str(i), "a")])
    run(spark, folders)
    assert spark.read.parquet(folders["results"]).select("epoch").distinct().count() == 3


def test_stream_stops_at_the_failure_budget(spark, folders):
    add(spark, folders, [("1", "a")])
    with pytest.raises(StreamingQueryException, match="failed batches"):
        run(spark, folders, refuse=["a"], max_failed_batches=1)
    assert read_statements(spark, folders["dead"]).count() == 1


def test_edges_with_bad_ranks_are_dropped(spark):
    rows = spark.createDataFrame([("1", "2", "3"), ("1", "2", None), ("1", "2", "x")],
                                 "s string, d string, r string")
    items = stream_statements(rows, EdgeSpec("knows", "s", "d", "r"), GRAPH)
    assert [r.item for r in items.collect()] == ["1->2@3: ()"]


def test_counters_of_running_streams(spark, folders):
    """Rows and dropped rows of every micro-batch, beside what its results say."""
    counters = StreamCounters()
    spark.streams.addListener(counters)
    try:
        add(spark, folders, [("1", "a"), ("x", "b"), (None, "c"), ("2", "d")])
        run(spark, folders, refuse=['"d"'])
        add(spark, folders, [("3", "e")])
        run(spark, folders)
        for _ in range(100):
            if sum(t["batches"] for t in counters.totals.values()) == 2 and counters.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    (query, total), = counters.totals.items()
    assert (total["batches"], total["rows"], total["dropped"]) == (2, 5, 2)
    assert [(b["rows"], b["dropped"]) for _, b in sorted(counters.batches[query].items())] == [
        (4, 2), (1, 0)]
    assert counters.ended == {query: None} and total["seconds"] > 0
    found = {(r.query, r.epoch): (r.batch_success, r.batch_failure, r.record_success,
                                  r.record_failure)
             for r in stream_stats(spark, folders["results"]).collect()}
    assert found == {(query, 0): (0, 1, 1, 1), (query, 1): (1, 0, 1, 0)}


def test_a_micro_batch_that_is_told_twice_counts_once(monkeypatch):
    monkeypatch.setattr(load, "KEPT", 2)
    counters = StreamCounters()
    for epoch in (0, 1, 1, 2, 3):
        counters.take("q", epoch, {"graphload.person": Row(rows=10, dropped=epoch)}, 500)
    counters.take("q", 4, {"other": Row(rows=1, dropped=1)}, 500)
    assert counters.totals["q"] == {"batches": 4, "rows": 40, "dropped": 6, "seconds": 2.0}
    assert sorted(counters.batches["q"]) == [2, 3]
