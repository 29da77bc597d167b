"""Plans of loads: what is left of a source that stayed, grew, changed or moved."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphload.operators import resume
from graphload.operators.resume import SourceChanged, fingerprint, mark_step, plan_load, with_digest
from graphload.operators.slices import save_checkpoint

ROW = "k int, v string, m map<string,int>"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(k, v, {"x": k or 0}) for k, v in rows], ROW).repartition(parts)


def rows_of(load, step=None):
    if load.rows is None:
        return Counter()
    rows = load.rows if step is None else load.rows.filter(F.col("__step") == step)
    return Counter((r.k, r.v) for r in rows.collect())


def planned(spark, rows, path, parallel=2, steps=3, **more):
    return plan_load(spark, rows, ["k"], parallel, str(path), "people", steps=steps, scan=False,
                     **more)


def run(spark, load, path, stop=None):
    """Send the steps of a load, all or up to ``stop``; returns what was sent."""
    sent = Counter()
    for step in load.steps:
        if stop is not None and step >= stop:
            break
        sent += rows_of(load, step)
        mark_step(spark, load, str(path), "people", step)
    return sent


def some(n=60, seed=1):
    rng = random.Random(seed)
    # a third of the rows has one key, and many rows are equal in everything
    return [(rng.choice([7, None, *[rng.randrange(40)] * 4]), rng.choice("abc")) for _ in range(n)]


def test_fingerprint_knows_rows_not_their_order(spark):
    rows = some()
    one = fingerprint(with_digest(frame(spark, rows)))
    assert one == fingerprint(with_digest(frame(spark, rows[::-1], 7))) and one.n == 60
    assert one != fingerprint(with_digest(frame(spark, rows[:-1])))
    assert one != fingerprint(with_digest(frame(spark, [*rows[:-1], (rows[-1][0], "z")])))
    # a pair of equal rows for another pair
    twice = fingerprint(with_digest(frame(spark, [(1, "a")] * 2 + [(2, "b")] * 2)))
    assert twice != fingerprint(with_digest(frame(spark, [(1, "a")] * 2 + [(3, "b")] * 2)))
    half = [fingerprint(with_digest(frame(spark, part))) for part in (rows[:20], rows[20:])]
    assert half[0] + half[1] == one
    assert fingerprint(with_digest(frame(spark, []))) == resume.Fingerprint()


@pytest.mark.parametrize("stop", [0, 1, 2, 3])
def test_the_same_source_goes_on(spark, tmp_path, stop):
    rows = some()
    first = run(spark, planned(spark, frame(spark, rows), tmp_path), tmp_path, stop)
    # in other files, with other settings: the plan decides
    load = planned(spark, frame(spark, rows[::-1], 5), tmp_path, parallel=9, steps=1)
    assert (load.plan.parallel, load.plan.steps) == (2, 3)
    assert first + run(spark, load, tmp_path) == Counter(rows)
    assert planned(spark, frame(spark, rows), tmp_path).steps == []


def test_a_plan_that_is_never_run_again_covers_all(spark, tmp_path):
    rows = some(200)
    load = planned(spark, frame(spark, rows), tmp_path, parallel=4, steps=5)
    assert rows_of(load) == Counter(rows)
    # no row is in two ranges, and equal rows are in one
    by_step = [rows_of(load, s) for s in load.steps]
    assert sum(by_step, Counter()) == Counter(rows)
    assert all(sum(r in s for s in by_step) == 1 for r in set(rows))


@pytest.mark.parametrize("change", ["smaller", "larger", "inside", "copies", "fewer", "edited"])
def test_another_source_is_refused_or_only_what_is_new_is_sent(spark, tmp_path, change):
    rows = some()
    first = run(spark, planned(spark, frame(spark, rows), tmp_path), tmp_path, 2)
    now = {"smaller": rows + [(-i, "n") for i in range(1, 11)],
           "larger": rows + [(100 + i, "n") for i in range(10)],
           "inside": rows + [(7, "n"), (20, "n"), (None, "n")],
           "copies": rows + [rows[0]] * 3 + [(7, "a")] * 5,
           "fewer": rows[5:], "edited": [*rows[:-1], (rows[-1][0], "z")]}[change]
    with pytest.raises(SourceChanged):
        planned(spark, frame(spark, now), tmp_path)
    load = planned(spark, frame(spark, now), tmp_path, on_change="new")
    assert load.plan.number == 1
    second = run(spark, load, tmp_path)
    # every row of the source now is sent as often as it is there, beside what had gone before
    assert second == Counter(now) - first
    assert planned(spark, frame(spark, now), tmp_path).steps == []


def test_a_source_that_grows_again_and_again(spark, tmp_path):
    rows, sent = [], Counter()
    for turn in range(4):
        rows = rows + [(k, f"{v}{turn}") for k, v in some(20, turn)] + [(7, "a")] * turn
        load = planned(spark, frame(spark, rows), tmp_path, on_change="new")
        sent += run(spark, load, tmp_path, None if turn == 3 else turn)
    assert sent == Counter(rows)
    # nothing new: the load is over, whatever the last plan held
    assert planned(spark, frame(spark, rows), tmp_path, on_change="new").steps == []


def test_many_copies_are_made_in_parts(spark, monkeypatch):
    monkeypatch.setattr(resume, "COPIES_AT_ONCE", 7)
    rows = with_digest(frame(spark, [(1, "a")] * 100 + [(2, "b")] * 3 + [(3, "c")]))
    sent = with_digest(frame(spark, [(1, "a")] * 20 + [(2, "b")] * 5)).select(*resume.DIGEST)
    left = resume.without_sent(rows, sent)
    assert Counter((r.k, r.v) for r in left.collect()) == {(1, "a"): 80, (3, "c"): 1}


def test_states_without_a_plan_and_other_columns_are_refused(spark, tmp_path):
    rows = frame(spark, some())
    save_checkpoint(spark, str(tmp_path / "old"), "people", [3, 9])
    with pytest.raises(SourceChanged, match="does not say"):
        planned(spark, rows, tmp_path / "old")
    planned(spark, rows, tmp_path / "new")
    with pytest.raises(SourceChanged, match="other columns"):
        planned(spark, rows.drop("v"), tmp_path / "new")
    with pytest.raises(SourceChanged, match="another order"):
        plan_load(spark, rows, ["v"], 2, str(tmp_path / "new"), "people", scan=False)
    for wrong in ({"parallel": 0}, {"steps": 0}, {"on_change": "maybe"}):
        with pytest.raises(ValueError):
            planned(spark, rows, tmp_path / "new", **wrong)
    with pytest.raises(ValueError, match="no rows"):
        planned(spark, frame(spark, []), tmp_path / "empty")


def test_a_plan_that_was_not_written_to_its_end_does_not_count(spark, tmp_path):
    os.makedirs(tmp_path / "people" / "plan=0" / "ledger")
    rows = some()
    load = planned(spark, frame(spark, rows), tmp_path)
    assert load.plan.number == 1
    assert run(spark, load, tmp_path) == Counter(rows)


def test_a_resumed_run_reads_without_a_sort(spark, tmp_path):
    """Only the key decides what is read, so nothing is dealt out or put in order again."""
    path = str(tmp_path / "table")
    frame(spark, some(100)).write.parquet(path)
    run(spark, planned(spark, spark.read.parquet(path), tmp_path), tmp_path, 1)
    load = planned(spark, spark.read.parquet(path), tmp_path)
    plan = load.rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "Sort" not in plan
    assert load.steps == [1, 2]
