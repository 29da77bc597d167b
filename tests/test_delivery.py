import os
import time

import pytest
from pyspark.sql import functions as F

from executors import Flaky, Raising, Recorder, Turning, connections, recorded
from graphload.operators.delivery import (
    DeliveryOptions, FatalDeliveryError, TooManyFailures, check_budget, check_fatal,
    clear_failures, failures_exist, reload, running_tasks, save_failures, write_batches,
    write_statements,
)
from graphload.operators.statements import Frame
from graphload.operators.stats import load_stats
from graphload.sources import read_statements

FRAME = Frame("PUT ", ",", "!")


def items(spark, n, parts=2):
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("r"), "id", F.lit("_")).alias("item"))


def send(spark, n, factory, parts=2, **options):
    return write_batches(items(spark, n, parts), "person", FRAME, factory,
                         DeliveryOptions(**{"batch": 10, **options}))


def test_batches_and_one_connection_per_task(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 45, lambda: Recorder(folder), parts=2)
    lines = recorded(folder)
    assert connections(folder) == 2
    assert sorted(len(line.split(",")) for line in lines) == [2, 3, 10, 10, 10, 10]
    assert all(line.startswith("PUT r") and line.endswith("_!") for line in lines)
    assert results.agg(F.sum("records"), F.sum("failed")).first() == (45, 0)
    assert sorted(r.batch for r in results.collect()) == [0, 0, 1, 1, 2, 2]
    # looking at the results again sends nothing
    results.count()
    assert len(recorded(folder)) == 6


def test_only_the_refused_rows_fail(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 40, lambda: Recorder(folder, ["r7_", "r33_"]))
    failed = results.select(F.explode("failed_stmts")).collect()
    assert sorted(r[0] for r in failed) == ["PUT r33_!", "PUT r7_!"]
    # two batches went again row by row
    assert len(recorded(folder)) == 4 + 20
    stats = {r.entity: r for r in load_stats(results, 2.0).collect()}
    assert stats["person"].batch_success == 2 and stats["person"].batch_failure == 2
    assert stats["(total)"].record_success == 38 and stats["(total)"].record_failure == 2
    assert stats["person"].records_per_second == 19.0


@pytest.mark.parametrize("times, lost", [(3, 0), (4, 0), (5, 1)])
def test_transient_errors_are_tried_again(spark, tmp_path, times, lost):
    folder = str(tmp_path)
    error = "x The leader has changed, y"
    # one refusal is spent on the batch, one on the row, and up to three on retries
    results = send(spark, 10, lambda: Flaky(folder, "r4_", error, times), parts=1, retry=3,
                   interval_s=0.01)
    assert results.agg(F.sum("failed")).first()[0] == lost


def test_other_errors_are_not_tried_again(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 10, lambda: Flaky(folder, "r4_", "bad value", 2), parts=1)
    assert results.agg(F.sum("failed")).first()[0] == 1
    assert len(recorded(folder)) == 11


def test_permission_errors_stop_the_load(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 100, lambda: Recorder(folder, ["r0_"], "E_BAD_PERMISSION: no"), parts=1)
    assert len(recorded(folder)) == 1
    with pytest.raises(FatalDeliveryError, match="E_BAD_PERMISSION"):
        check_fatal(results)
    # every row is kept
    assert results.agg(F.sum("failed")).first()[0] == 100
    check_fatal(send(spark, 10, lambda: Recorder(folder)))


def test_a_raising_executor_fails_its_rows_only(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 40, lambda: Raising(folder, "r7_"))
    failed = results.select(F.explode("failed_stmts"), "error").collect()
    assert [tuple(r) for r in failed] == [("PUT r7_!", "ConnectionError: gone")]
    assert results.filter("fatal").isEmpty()
    # an executor that cannot be made calls the load off, and keeps its rows
    results = send(spark, 40, lambda: Raising("/nowhere/at/all", "r7_"))
    assert results.agg(F.sum("failed")).first()[0] == 40
    with pytest.raises(FatalDeliveryError):
        check_fatal(results)


def test_dead_letters_of_a_load_that_is_called_off_late(spark, tmp_path):
    log, dead = str(tmp_path / "log"), str(tmp_path / "dead")
    os.mkdir(log)
    results = send(spark, 100, lambda: Turning(log, "r95_"), parts=1, retry=0)
    save_failures(results, dead, "run")
    with pytest.raises(FatalDeliveryError):
        check_fatal(results)
    lines = sorted(r.statement for r in read_statements(spark, dead).collect())
    # the refused rows of the first nine batches, and the whole last batch
    assert len(lines) == 9 + 10 and "PUT r5_!" in lines and "PUT r95_!" in lines


def test_results_are_handed_on_by_size(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    rows = spark.range(0, 40, 1, 1).select(F.concat(F.lit("_"), F.repeat(F.lit("x"), 1 << 20))
                                           .alias("item"))
    results = write_batches(rows, "person", FRAME, lambda: Recorder(folder, ["_"]),
                            DeliveryOptions(batch=2, retry=0))
    assert results.agg(F.sum("failed")).first()[0] == 40


def test_failure_budget_keeps_unsent_rows(spark, tmp_path):
    folder = str(tmp_path / "log")
    os.mkdir(folder)
    results = send(spark, 100, lambda: Recorder(folder, ["_"]), parts=1, max_failed_batches=3,
                   retry=0)
    # three batches were tried (and again row by row), the other seven were not sent
    assert len(recorded(folder)) == 3 * 11
    assert results.filter("NOT sent").count() == 7
    assert results.agg(F.sum("failed")).first()[0] == 100
    check_budget(results, 11)
    with pytest.raises(TooManyFailures):
        check_budget(results, 10)
    save_failures(results, str(tmp_path / "dead"), "a")
    assert read_statements(spark, str(tmp_path / "dead")).count() == 100


def test_rate(spark, tmp_path):
    folder = str(tmp_path)
    started = time.monotonic()
    results = send(spark, 60, lambda: Recorder(folder), parts=1, rate_per_partition=10.0,
                   rate_timeout_s=1.0)
    assert time.monotonic() - started >= 0.5
    assert results.agg(F.sum("failed")).first()[0] == 0


def test_a_rate_limit_loses_nothing(spark, tmp_path):
    folder = str(tmp_path)
    started = time.monotonic()
    results = send(spark, 50, lambda: Recorder(folder), parts=1, rate_per_partition=4.0)
    assert time.monotonic() - started >= 1.0
    assert results.agg(F.sum("failed")).first()[0] == 0 and len(recorded(folder)) == 5


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_one_rate_whatever_the_number_of_tasks(spark, tmp_path, parts):
    """80 statements at 20 a second take 4 seconds and a little, by one task or by many."""
    folder = str(tmp_path)
    started = time.monotonic()
    results = send(spark, 80, lambda: Recorder(folder), parts, batch=1, rate=20.0)
    took = time.monotonic() - started
    assert len(recorded(folder)) == 80 and results.agg(F.sum("failed")).first()[0] == 0
    assert 4.0 <= took < 10.0


def test_tasks_that_run_at_a_time(spark):
    four = spark.sparkContext.defaultParallelism
    assert running_tasks(spark.range(0, 9, 1, 2)) == 2
    assert running_tasks(spark.range(0, 99, 1, 33)) == four
    shuffled = spark.range(9).repartition(2)
    assert running_tasks(shuffled) == four and running_tasks(shuffled, 2) == 2
    with pytest.raises(ValueError):
        send(spark, 1, object, parts=1, rate=0)


def test_giving_up_on_a_permit_is_asked_for_and_is_a_failure(spark, tmp_path):
    folder = str(tmp_path)
    results = send(spark, 30, lambda: Recorder(folder), parts=1, rate_per_partition=0.5,
                   rate_timeout_s=0.01)
    assert len(recorded(folder)) == 1
    assert results.agg(F.sum("failed")).first()[0] == 20


def test_dead_letters_and_reload(spark, tmp_path):
    log, dead = str(tmp_path / "log"), str(tmp_path / "dead")
    again = str(tmp_path / "again")
    for folder in (log, again):
        os.mkdir(folder)
    assert not failures_exist(spark, dead)
    results = send(spark, 40, lambda: Recorder(log, ["r7_", "r8_", "r33_"]))
    save_failures(results, dead, "run1")
    save_failures(results, dead, "run1")
    assert read_statements(spark, dead).count() == 6
    assert os.path.isdir(f"{dead}/run1/entity=person")
    replayed = reload(spark, f"{dead}/run1", lambda: Recorder(again, ["r7_"]),
                      DeliveryOptions(retry=0), dead, "1")
    assert replayed.agg(F.sum("records"), F.sum("failed")).first() == (6, 2)
    assert sorted(set(recorded(again))) == ["PUT r33_!", "PUT r7_!", "PUT r8_!"]
    clear_failures(spark, dead)
    assert sorted(os.listdir(dead)) == ["reload.1"]
    assert read_statements(spark, dead).count() == 2
    clear_failures(spark, dead, keep_reload=False)
    assert os.listdir(dead) == []
    clear_failures(spark, str(tmp_path / "nowhere"))


def test_statement_files(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("A;B",), ("C",)], "statement string")
    write_statements(rows, path)
    assert sorted(r.statement for r in read_statements(spark, path).collect()) == ["A;B", "C"]


def test_no_shuffle_before_sending(spark, tmp_path):
    from graphload.operators.delivery import deliver
    plan = deliver(items(spark, 10), "person", FRAME, lambda: Recorder(str(tmp_path)))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        send(spark, 1, lambda: Recorder(str(tmp_path)), batch=0)
