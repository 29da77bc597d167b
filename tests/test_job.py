import copy
import json
import os
import re
import sys
import time
import types
from collections import Counter

import pytest
from pyspark.errors import PySparkException

from executors import Recorder, Slow, recorded
from graphload.__main__ import main
from graphload.operators.delivery import FatalDeliveryError, TooManyFailures
from graphload.operators.publish import current_set, read_kv, set_problems
from graphload.operators.resume import SourceChanged
from graphload.operators.slices import load_checkpoint
from graphload.plans import Job, edges_of, run_job, vertices_of
from graphload import storage
from graphload.plans import job as job_module
from graphload.plans.job import prepare_input, prepared_rows
from graphload.sources import read_statements, register_source


@pytest.fixture
def tables(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("people", "firms", "knows")}
    spark.createDataFrame([("1", "Ann", 30, "a", "x"), ("2", "Bob", 40, "b", None),
                           ("3", "Cem", 50, "c", "z")],
                          "id string, name string, age int, k1 string, k2 string"
                          ).write.parquet(paths["people"])
    spark.createDataFrame([("9", "Acme")], "id string, title string").write.json(paths["firms"])
    spark.createDataFrame([("1", "2", 5), ("2", "3", 6), ("2", "3", 6)],
                          "a string, b string, since int").write.parquet(paths["knows"])
    os.mkdir(tmp_path / "log")
    return {**paths, "log": str(tmp_path / "log"), "kv": str(tmp_path / "kv"),
            "dead": str(tmp_path / "dead")}


def describe(t, sink="statements"):
    return {
        "graph": {"parts": 4, "id_type": "INT", "id_len": 8, "labels": {
            "person": {"kind": "vertex", "number": 1,
                       "properties": {"name": "STRING", "age": "INT32"}},
            "firm": {"kind": "vertex", "number": 2, "properties": {"name": "STRING"}},
            "knows": {"kind": "edge", "number": 3, "properties": {"since": "INT32"}}}},
        "spark_conf": {"spark.sql.files.maxPartitionBytes": "64m"},
        "failures": t["dead"], "kv_path": t["kv"],
        "vertices": [
            {"label": "person", "id": "id", "fields": ["name", "age"], "filter": "age < 50",
             "sink": sink, "batch": 10, "source": {"type": "parquet", "path": t["people"]}},
            {"label": "firm", "id": "id", "fields": ["title"], "targets": ["name"], "sink": sink,
             "partition": 1, "source": {"type": "json", "path": t["firms"]}}],
        "edges": [
            {"label": "knows", "src": "a", "dst": "b", "rank": "since", "fields": ["since"],
             "sink": sink, "batch": 100, "partition": 1,
             "source": {"type": "parquet", "path": t["knows"]}}],
    }


def test_statement_job(spark, tables):
    job, log = Job.from_dict(describe(tables)), tables["log"]
    report = run_job(spark, job, lambda: Recorder(log))
    text = "\n".join(recorded(log))
    assert '1: ("Ann", 30)' in text and '2: ("Bob", 40)' in text and "Cem" not in text
    assert 'INSERT VERTEX `firm`(`name`) VALUES 9: ("Acme")' in text
    assert text.count("2->3@6: (6)") == 2
    stats = {r.entity: r for r in report.stats.collect()}
    assert {k: v.record_success for k, v in stats.items()} == {
        "person": 2, "firm": 1, "knows": 3, "(total)": 6}
    assert stats["(total)"].records_per_second > 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_failures_of_a_job(spark, tables):
    d = describe(tables)
    d["delivery"] = {"max_failed_batches": 1, "retry": 0}
    log = tables["log"]
    with pytest.raises(TooManyFailures):
        run_job(spark, Job.from_dict(d), lambda: Recorder(log, ["Acme"]))
    lines = [r.statement for r in read_statements(spark, tables["dead"]).collect()]
    assert lines == ['INSERT VERTEX `firm`(`name`) VALUES 9: ("Acme")']


def test_key_value_job(spark, tables):
    report = run_job(spark, Job.from_dict({**describe(tables, "kv"), "existence": True}))
    assert report.stats is None and len(report.kv_paths) == 3
    counts = {name.split("-")[0]: spark.read.parquet(p).count()
              for name, p in report.kv_paths.items()}
    # vertices have two rows each, the doubled edge counts once in two directions
    assert counts == {"person": 4, "firm": 2, "knows": 4}


def test_dry_run_sends_nothing(spark, tables):
    log = tables["log"]
    report = run_job(spark, Job.from_dict(describe(tables)), lambda: Recorder(log), dry=True)
    assert sorted(n.split("-")[0] for n in report.previews) == ["firm", "knows", "person"]
    assert report.previews["firm-1"].columns == ["id", "title"]
    assert recorded(log) == [] and report.stats is None


def test_only_needed_columns_are_read(spark, tables):
    rows = prepared_rows(spark, Job.from_dict(describe(tables)).entities[0])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,name:string,age:int>" in plan
    assert "LessThan(age,50)" in plan


def test_composite_keys_and_path_variables(spark, tables):
    d = describe(tables)
    d["graph"]["id_type"] = "STRING"
    d["vertices"] = [{"label": "person", "id": "key", "prefix": "p", "fields": ["name", "age"],
                      "composite_keys": [{"sep": "-", "cols": ["k1", "k2"], "new_col": "key"}],
                      "source": {"type": "parquet", "path": "where"}}]
    d["edges"] = []
    job, log = Job.from_dict(d), tables["log"]
    run_job(spark, job, lambda: Recorder(log), params=f"where={tables['people']}")
    text = "\n".join(recorded(log))
    for part in ('"p_a-x": ("Ann", 30)', '"p_b": ("Bob", 40)', '"p_c-z": ("Cem", 50)'):
        assert part in text


def test_invalid_rows_stop_a_batch_load(spark, tables):
    d = describe(tables)
    d["edges"] = []
    d["vertices"] = [{**d["vertices"][0], "id": "name"}]
    log = tables["log"]
    with pytest.raises(PySparkException, match="id: not an integer"):
        run_job(spark, Job.from_dict(d), lambda: Recorder(log))
    assert recorded(log) == []


def test_sources_that_give_nothing_are_skipped(spark, tables):
    register_source("nothing", lambda session, spec, fields: None)
    d = describe(tables)
    d["vertices"][1]["source"] = {"type": "nothing"}
    log = tables["log"]
    report = run_job(spark, Job.from_dict(d), lambda: Recorder(log))
    assert "firm" not in {r.entity for r in report.stats.collect()}
    labels = {r.label for r in vertices_of(spark, Job.from_dict(d)).collect()}
    assert labels == {"person"}


def test_entities_of_one_label_become_one_frame(spark, tables):
    d = describe(tables)
    again = copy.deepcopy(d["edges"][0])
    again.update(src="b", dst="a")
    d["edges"].append(again)
    job = Job.from_dict(d)
    edges = edges_of(spark, job)
    assert edges.columns == ["label", "src", "dst", "rank", "item", "part"]
    assert edges.count() == 6
    assert sorted({r.vid for r in vertices_of(spark, job).collect()}) == [1, 2, 9]


@pytest.mark.parametrize("change", [
    lambda d: d.update(vertices=[], edges=[]),
    lambda d: d["vertices"][0].update(batch=0),
    lambda d: d["vertices"][0].update(id=" "),
    lambda d: d["vertices"][0].update(label="ghost"),
    lambda d: d["vertices"][0].update(mode="merge"),
    lambda d: d["vertices"][0].update(colour="red"),
    lambda d: d["vertices"][0].update(sink="rocket"),
    lambda d: d["vertices"][0].update(targets=["name"]),
    lambda d: d["vertices"][0].update(fields=["zz", "age"]),
    lambda d: d["vertices"][0].pop("source"),
    lambda d: d["vertices"][0].update(source={"path": "x"}),
    lambda d: d["edges"][0].update(dst=""),
    lambda d: d["edges"][0].update(label="person"),
    lambda d: (d.pop("kv_path"), d["edges"][0].update(sink="kv")),
    lambda d: d["edges"][0].update(sink="kv", source={"type": "kafka"}),
    lambda d: d["edges"][0].update(source={"type": "kafka"}),
    lambda d: d["graph"]["labels"].update({"a`b": {"kind": "vertex", "properties": {}}})
    or d["vertices"][0].update(label="a`b", fields=[]),
])
def test_bad_jobs_are_refused_before_anything_runs(tables, change):
    d = describe(tables)
    change(d)
    with pytest.raises((ValueError, KeyError)):
        Job.from_dict(d)


def test_defaults(tables):
    entity = Job.from_dict(describe(tables)).entities[1]
    assert (entity.batch, entity.spec.mode, entity.interval_s, entity.checkpoint) == (
        500, "insert", 30, None)
    d = describe(tables)
    d["vertices"][0]["mode"] = "UPSERT"
    assert Job.from_dict(d).entities[0].spec.mode == "upsert"
    assert Job.from_dict(d).entities[0].partition == -1


def test_streams_are_started_together(spark, tables, tmp_path):
    d = describe(tables)
    for number, entity in enumerate(d["vertices"][:1] + d["edges"]):
        entity.update(source={"type": "file_stream", "path": entity["source"]["path"],
                              "schema": spark.read.parquet(entity["source"]["path"]).schema},
                      checkpoint=str(tmp_path / f"state{number}"), interval_s=1)
    d["vertices"] = d["vertices"][:1]
    log = tables["log"]
    report = run_job(spark, Job.from_dict(d), lambda: Recorder(log))
    assert sorted(q.name for q in report.streams) == ["knows-1", "person-0"]
    for query in report.streams:
        query.processAllAvailable()
        query.stop()
    for _ in range(100):
        if len(report.counters.ended) == 2:
            break
        time.sleep(0.1)
    spark.streams.removeListener(report.counters)
    # after the filter of the entity
    assert sorted(t["rows"] for t in report.counters.totals.values()) == [2, 3]
    text = "\n".join(recorded(log))
    assert '1: ("Ann", 30)' in text and "1->2@5: (5)" in text


def test_a_sliced_entity_resumes(spark, tables, tmp_path):
    d = describe(tables)
    d["edges"] = []
    d["vertices"] = [{"label": "person", "id": "id", "fields": ["name", "age"], "source": {
        "type": "sliced", "of": {"type": "parquet", "path": "people"},
        "order_by": ["id"], "parallel": 2, "checkpoint": str(tmp_path / "cp"), "name": "people"}}]
    log = tables["log"]
    job, where = Job.from_dict(d), f"people={tables['people']}"
    with pytest.raises(FatalDeliveryError, match="E_BAD_PERMISSION"):
        run_job(spark, job, lambda: Recorder(log, ["Ann"], "E_BAD_PERMISSION"), params=where)
    # Ann's step is over and Ann a dead letter; the next run goes on from there
    reached = load_checkpoint(spark, str(tmp_path / "cp"), "people")
    assert reached is not None and reached < [2, 3]
    run_job(spark, job, lambda: Recorder(log, ["Bob"]), params=where)
    assert load_checkpoint(spark, str(tmp_path / "cp"), "people") == [2, 3]
    assert sum("Ann" in line for line in recorded(log)) == 1
    assert sorted(
        r.statement for r in read_statements(spark, tables["dead"]).collect()) == [
        'INSERT VERTEX `person`(`name`,`age`) VALUES 1: ("Ann", 30)',
        'INSERT VERTEX `person`(`name`,`age`) VALUES 2: ("Bob", 40)']
    sent = len(recorded(log))
    report = run_job(spark, job, lambda: Recorder(log), params=where)
    assert len(recorded(log)) == sent
    assert report.stats.filter("entity = 'person'").count() == 0


def test_command_line(spark, tables, tmp_path, monkeypatch, capsys):
    log = tables["log"]
    module = types.ModuleType("my_client")
    module.make = lambda: Recorder(log, ["Acme"])
    module.accept = lambda: Recorder(log)
    monkeypatch.setitem(sys.modules, "my_client", module)
    config = tmp_path / "job.json"
    config.write_text(json.dumps(describe(tables)))
    main(["-c", str(config), "-D"])
    assert "Ann" in capsys.readouterr().out and recorded(log) == []
    main(["-c", str(config), "--executor", "my_client:make"])
    assert "(total)" in capsys.readouterr().out
    main(["-c", str(config), "-r", tables["dead"], "--executor", "my_client:accept"])
    assert "1" in capsys.readouterr().out
    assert recorded(log).count('INSERT VERTEX `firm`(`name`) VALUES 9: ("Acme")') == 3


def test_a_job_with_results_runs_again(spark, tables, tmp_path):
    job = Job.from_dict({**describe(tables), "results": str(tmp_path / "results")})
    log = tables["log"]
    runs = {run_job(spark, job, lambda: Recorder(log)).run for _ in range(2)}
    assert len(runs) == 2 and set(os.listdir(tmp_path / "results")) == runs


def test_a_sliced_entity_stores_needed_columns_only(spark, tables, tmp_path):
    d = describe(tables)
    d["edges"] = []
    d["vertices"] = [{"label": "person", "id": "id", "fields": ["name"], "targets": ["name"],
                      "filter": "age < 50 AND k1 <> 'z'", "source": {
                          "type": "sliced", "of": {"type": "parquet", "path": tables["people"]},
                          "order_by": ["id"], "parallel": 2}}]
    entity = Job.from_dict(d).entities[0]
    found = prepare_input(spark, entity)
    stored = spark.read.parquet(found.indexed).columns
    assert sorted(c for c in stored if not c.startswith("__")) == ["age", "id", "k1", "name"]
    assert sorted(r.id for r in found.rows.collect()) == ["1", "2"]
    folder = os.path.dirname(storage.scratch_path(spark, "x"))
    before = len(os.listdir(os.path.dirname(folder)))
    report = run_job(spark, Job.from_dict(d), dry=True)
    assert sorted(r.id for r in report.previews["person-0"].collect()) == ["1", "2"]
    assert len(os.listdir(os.path.dirname(folder))) == before


def test_bad_ids_outside_of_a_sentence_do_not_stop_it(spark, tables):
    rows = spark.createDataFrame([("1", "x"), ("1", "y"), ("bad", "z")], "k string, v string")
    rows.createOrReplaceTempView("spoilt")
    spark.createDataFrame([("1",)], "k string").createOrReplaceTempView("fine")
    d, log = describe(tables), tables["log"]
    d["edges"] = []
    for number, sentence in enumerate((
            "SELECT k, count(*) AS age FROM spoilt GROUP BY k HAVING count(*) > 1",
            "SELECT s.k, 1 AS age FROM spoilt s JOIN fine f ON s.k = f.k",
            "SELECT k, 1 AS age FROM spoilt WHERE k IN (SELECT k FROM fine)")):
        for sink in ("statements", "kv"):
            d["vertices"] = [{"label": "person", "id": "k", "fields": ["age"], "sink": sink,
                              "source": {"type": "sql", "sentence": sentence}}]
            d["kv_path"] = f"{tables['kv']}{number}"
            run_job(spark, Job.from_dict(d), lambda: Recorder(log))
        assert vertices_of(spark, Job.from_dict(d)).filter("vid = 1").count() >= 1
    d["vertices"][0]["source"]["sentence"] = "SELECT k, 1 AS age FROM spoilt"
    with pytest.raises(PySparkException, match="id: not an integer"):
        vertices_of(spark, Job.from_dict(d)).collect()


def test_one_failing_entity_leaves_the_counters_of_the_others(spark, tables):
    log = tables["log"]
    d = describe(tables)
    d["delivery"] = {"max_failed_batches": 1, "retry": 0}
    with pytest.raises(TooManyFailures) as caught:
        run_job(spark, Job.from_dict(d), lambda: Recorder(log, ["Acme"]))
    done = {r.entity for r in caught.value.report.stats.collect()}
    assert done == {"person", "knows", "(total)"}


def sliced(t, tmp_path, **more):
    """A job of one entity whose source is read in steps with a checkpoint."""
    d = describe(t)
    d["edges"] = []
    d["vertices"] = [{"label": "person", "id": "id", "fields": ["name", "age"], "source": {
        "type": "sliced", "of": {"type": "parquet", "path": t["people"]}, "order_by": ["id"],
        "parallel": 2, "checkpoint": str(tmp_path / "cp"), "name": "people", "steps": 2, **more}}]
    return d


def people(spark, ids):
    return spark.createDataFrame([(i, f"n{i}", int(i), "a", "x") for i in ids],
                                 "id string, name string, age int, k1 string, k2 string")


def sent_names(log):
    """How often each row was sent; the log is emptied."""
    found = re.findall(r'"(n\d+)"', "\n".join(recorded(log)))
    for name in os.listdir(log):
        os.remove(os.path.join(log, name))
    return Counter(found)


def test_rows_that_come_between_two_runs_are_sent_once(spark, tables, tmp_path):
    """100 rows and 10 smaller ones: none is lost, none is sent twice."""
    log, folder = tables["log"], str(tmp_path / "many")
    t = {**tables, "people": folder}
    people(spark, [f"{i}" for i in range(100, 200)]).write.parquet(folder)
    with pytest.raises(FatalDeliveryError):
        run_job(spark, Job.from_dict(sliced(t, tmp_path)), lambda: Recorder(
            log, ["n"], "E_BAD_PERMISSION"))
    sent_names(log)
    dead = Counter(r.statement for r in read_statements(spark, tables["dead"]).collect())
    assert 0 < len(dead) < 100 and set(dead.values()) == {1}
    people(spark, [f"{i}" for i in range(10, 20)]).write.mode("append").parquet(folder)
    with pytest.raises(SourceChanged, match="had 100 rows, it has 110"):
        run_job(spark, Job.from_dict(sliced(t, tmp_path)), lambda: Recorder(log))
    assert not sent_names(log)
    job = Job.from_dict(sliced(t, tmp_path, on_change="new"))
    run_job(spark, job, lambda: Recorder(log))
    second = sent_names(log)
    assert set(second.values()) == {1} and len(second) + len(dead) == 110
    assert not any(f'"{name}"' in statement for name in second for statement in dead)
    run_job(spark, job, lambda: Recorder(log))
    assert not sent_names(log)


def test_a_checkpoint_needs_a_place_for_failures(tables, tmp_path):
    d = sliced(tables, tmp_path)
    Job.from_dict(d)
    for change in (lambda d: d.pop("failures"), lambda d: d["vertices"][0]["source"].pop("name"),
                   lambda d: d["vertices"][0].update(sink="kv")):
        spoilt = copy.deepcopy(d)
        change(spoilt)
        with pytest.raises(ValueError):
            Job.from_dict(spoilt)


def test_dead_letters_lie_where_the_report_says(spark, tables):
    d, log = describe(tables), tables["log"]
    del d["failures"]
    report = run_job(spark, Job.from_dict(d), lambda: Recorder(log, ["Acme"]))
    lines = [r.statement for r in read_statements(spark, report.failures).collect()]
    assert lines == ['INSERT VERTEX `firm`(`name`) VALUES 9: ("Acme")']


def test_old_sets_go_when_a_job_says_how_many_stay(spark, tables):
    d = {**describe(tables, "kv"), "kv_keep": 2}
    d["vertices"], d["edges"] = d["vertices"][1:], []
    runs = [run_job(spark, Job.from_dict(d)).run for _ in range(3)]
    folders = [n for n in os.listdir(f"{tables['kv']}/firm-0") if n.startswith("run=")]
    assert sorted(folders) == sorted(f"run={r}" for r in runs[1:])
    with pytest.raises(ValueError):
        Job.from_dict({**d, "kv_keep": 0})


def test_a_key_value_job_runs_again(spark, tables):
    d = describe(tables, "kv")
    first = run_job(spark, Job.from_dict(d))
    people(spark, ["7"]).write.mode("append").parquet(tables["people"])
    second = run_job(spark, Job.from_dict(d))
    assert first.run != second.run
    for name, path in second.kv_paths.items():
        now = current_set(spark, f"{tables['kv']}/{name}")
        assert (now.run, now.data) == (second.run, path)
        assert set_problems(spark, now).isEmpty()
    counts = {n: (spark.read.parquet(first.kv_paths[n]).count(),
                  read_kv(spark, f"{tables['kv']}/{n}").count()) for n in second.kv_paths}
    assert counts == {"person-0": (2, 3), "firm-1": (1, 1), "knows-2": (4, 4)}


@pytest.mark.parametrize("concurrent", [3, 2])
def test_a_fatal_entity_ends_the_others(spark, tables, concurrent):
    """Running entities are called off, waiting ones do not start."""
    started = time.monotonic()
    with pytest.raises(FatalDeliveryError, match="E_BAD_PERMISSION") as caught:
        run_job(spark, Job.from_dict(describe(tables)), Slow, concurrent=concurrent,
                on_error="cancel")
    assert time.monotonic() - started < 25
    assert sorted(caught.value.report.called_off) == ["knows-2", "person-0"]
    with pytest.raises(ValueError):
        run_job(spark, Job.from_dict(describe(tables)), Slow, on_error="hope")


def test_every_entity_has_its_pool_and_tag(spark, tables, monkeypatch):
    seen = {}
    deliver = job_module._deliver

    def watched(session, job, entity, rows, name, *more):
        sc = session.sparkContext
        seen[name.split(".")[-1]] = (sc.getLocalProperty("spark.scheduler.pool"),
                                     {t.split(".")[-1] for t in sc.getJobTags()})
        return deliver(session, job, entity, rows, name, *more)

    monkeypatch.setattr(job_module, "_deliver", watched)
    log = tables["log"]
    run_job(spark, Job.from_dict(describe(tables)), lambda: Recorder(log))
    assert seen == {n: (n, {n}) for n in ("person-0", "firm-1", "knows-2")}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_slices_in_the_order_of_the_files(spark, tables):
    d, log = describe(tables), tables["log"]
    d["edges"] = []
    d["vertices"] = [{"label": "person", "id": "id", "fields": ["name"], "targets": ["name"],
                      "filter": "age < 50", "source": {
                          "type": "sliced", "of": {"type": "parquet", "path": tables["people"]},
                          "parallel": 2, "steps": 2}}]
    run_job(spark, Job.from_dict(d), lambda: Recorder(log))
    text = "\n".join(recorded(log))
    assert text.count("Ann") == text.count("Bob") == 1 and "Cem" not in text
    d["vertices"][0]["source"]["of"] = {"type": "json", "path": tables["firms"]}
    with pytest.raises(ValueError, match="order_by"):
        Job.from_dict(d)
