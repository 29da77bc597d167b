"""Whole loads: the graph of all tables, delivery, counters, a stream, clustering."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from graphload.operators.delivery import (
    DeliveryOptions, FatalDeliveryError, TooManyFailures, check_budget, check_fatal,
    clear_failures, failures_exist, reload, save_failures, write_batches, write_statements,
)
from graphload.operators.propagation import cluster_count, peer_pressure
from graphload.operators.resume import SourceChanged
from graphload.operators.statements import render_items, statement_frame
from graphload.operators.stats import load_stats
from graphload.plans import Job, edges_of, run_job, vertices_of
from graphload.plans.job import prepare_input, prepared_rows
from graphload.sources import read_statements, read_stream, register_source
from graphload.spec import VertexSpec
from graphload.storage import scratch_path
from graphload.streaming import StreamCounters, stream_load, stream_stats

from .base import INT_GRAPH, query, sql_part_int, table

# Ids of different tables are kept apart by a power of ten per table.
_OFFSETS = {"customer": 0, "orders": 1, "part": 2, "supplier": 3, "nation": 4, "region": 5}


def _shift(name: str, key: str) -> str:
    return f"({key}) * 10 + {_OFFSETS[name]}"


def graph_job(sf_dir: str) -> Job:
    """Six vertex labels and five edge types from seven tables."""
    def source(name: str, **ids: str) -> dict:
        columns = ", ".join(["*"] + [f"{expr} AS {alias}" for alias, expr in ids.items()])
        return {"type": "sql",
                "sentence": f"SELECT {columns} FROM parquet.`{sf_dir}/{name}.parquet`"}

    def vertex(name, key, fields=(), targets=()):
        return {"label": name, "id": "vid", "fields": list(fields), "targets": list(targets),
                "source": source(name, vid=_shift(name, key))}

    def edge(label, name, a, b, **more):
        return {"label": label, "src": "src", "dst": "dst",
                "source": source(name, src=_shift(*a), dst=_shift(*b)), **more}

    labels = {name: {"kind": label.kind, "properties": label.properties, "number": label.number}
              for name, label in INT_GRAPH.labels.items()}
    return Job.from_dict({
        "graph": {"parts": INT_GRAPH.parts, "id_type": "INT", "id_len": 8, "labels": labels},
        "vertices": [
            vertex("customer", "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"],
                   ["name", "nation", "segment"]),
            vertex("orders", "o_orderkey", ["o_orderstatus", "o_orderdate", "o_orderpriority"],
                   ["status", "day", "priority"]),
            vertex("part", "p_partkey", ["p_name", "p_brand", "p_size"],
                   ["name", "brand", "size"]),
            vertex("supplier", "s_suppkey", ["s_name"], ["name"]),
            vertex("nation", "n_nationkey", ["n_name"], ["name"]),
            vertex("region", "r_regionkey", ["r_name"], ["name"]),
        ],
        "edges": [
            edge("placed", "orders", ("customer", "o_custkey"), ("orders", "o_orderkey"),
                 fields=["o_orderpriority"], targets=["priority"]),
            edge("contains", "lineitem", ("orders", "l_orderkey"), ("part", "l_partkey"),
                 rank="l_linenumber",
                 fields=["l_quantity", "l_returnflag", "l_shipdate"],
                 targets=["quantity", "flag", "shipped"]),
            edge("supplied_by", "lineitem", ("part", "l_partkey"), ("supplier", "l_suppkey")),
            edge("in_nation", "customer", ("customer", "c_custkey"), ("nation", "c_nationkey")),
            edge("in_nation", "supplier", ("supplier", "s_suppkey"), ("nation", "s_nationkey")),
            edge("in_region", "nation", ("nation", "n_nationkey"), ("region", "n_regionkey")),
        ],
    })


def _sql_vertex(name, key, *values):
    row = " || ', ' || ".join(values)
    return (f"SELECT '{name}' AS label, ({_shift(name, key)})::BIGINT AS vid, "
            f"({_shift(name, key)}) || ': (' || {row} || ')' AS item FROM {name}")


def _quoted(column):
    return f"'\"' || {column} || '\"'"


_VERTICES = " UNION ALL ".join([
    _sql_vertex("customer", "c_custkey", _quoted("c_name"), "c_nationkey", _quoted("c_mktsegment")),
    _sql_vertex("orders", "o_orderkey", _quoted("o_orderstatus"),
                "'datetime(\"' || o_orderdate || '\")'", _quoted("o_orderpriority")),
    _sql_vertex("part", "p_partkey", _quoted("p_name"), _quoted("p_brand"), "p_size"),
    _sql_vertex("supplier", "s_suppkey", _quoted("s_name")),
    _sql_vertex("nation", "n_nationkey", _quoted("n_name")),
    _sql_vertex("region", "r_regionkey", _quoted("r_name")),
])


@query(f"WITH v AS ({_VERTICES}) SELECT *, {sql_part_int('vid')} AS part FROM v")
def graph_vertices(spark, sf_dir):
    return vertices_of(spark, graph_job(sf_dir))


def _sql_edge(label, table_name, a, b, rank="NULL", row="''", where="TRUE"):
    src, dst = _shift(*a), _shift(*b)
    mark = "" if rank == "NULL" else f" || '@' || {rank}"
    return (f"SELECT '{label}' AS label, ({src})::BIGINT AS src, ({dst})::BIGINT AS dst, "
            f"coalesce({rank}, 0)::BIGINT AS rank, ({src}) || '->' || ({dst}){mark} || ': (' || "
            f"{row} || ')' AS item FROM {table_name} WHERE {where}")


_EDGES = " UNION ALL ".join([
    _sql_edge("placed", "orders", ("customer", "o_custkey"), ("orders", "o_orderkey"),
              row=_quoted("o_orderpriority")),
    _sql_edge("contains", "lineitem", ("orders", "l_orderkey"), ("part", "l_partkey"),
              "l_linenumber", "l_quantity || ', ' || " + _quoted("l_returnflag")
              + " || ', datetime(\"' || l_shipdate || '\")'"),
    _sql_edge("supplied_by", "lineitem", ("part", "l_partkey"), ("supplier", "l_suppkey")),
    _sql_edge("in_nation", "customer", ("customer", "c_custkey"), ("nation", "c_nationkey")),
    _sql_edge("in_nation", "supplier", ("supplier", "s_suppkey"), ("nation", "s_nationkey")),
    _sql_edge("in_region", "nation", ("nation", "n_nationkey"), ("region", "n_regionkey")),
])


@query(f"WITH e AS ({_EDGES}) SELECT *, {sql_part_int('src')} AS part FROM e")
def graph_edges(spark, sf_dir):
    return edges_of(spark, graph_job(sf_dir))


class SegmentRefuser:
    """An executor that refuses statements naming one market segment."""

    def execute(self, statement: str) -> str | None:
        return "refused" if '"HOUSEHOLD"' in statement else None


class Accepter:
    def execute(self, statement: str) -> str | None:
        return None


_CUSTOMER = VertexSpec("customer", "c_custkey", ("c_name", "c_nationkey", "c_mktsegment"),
                       ("name", "nation", "segment"))


def _deliver(spark, sf_dir):
    items = render_items(table(spark, sf_dir, "customer"), _CUSTOMER, INT_GRAPH)
    return write_batches(items, "customer", statement_frame(_CUSTOMER), SegmentRefuser,
                         DeliveryOptions(batch=200))


@query("SELECT 'customer' AS entity, count(*) FILTER (c_mktsegment <> 'HOUSEHOLD') AS delivered, "
       "count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS refused FROM customer")
def deliver_batches(spark, sf_dir):
    """Failing batches are sent row by row, so only the refused rows are lost."""
    stats = load_stats(_deliver(spark, sf_dir)).filter("entity = 'customer'")
    return stats.select("entity", F.col("record_success").alias("delivered"),
                        F.col("record_failure").alias("refused"))


@query("SELECT count(*) AS replayed FROM customer WHERE c_mktsegment = 'HOUSEHOLD'")
def reload_failures(spark, sf_dir):
    """What was refused is saved, read back and accepted."""
    path = scratch_path(spark, "failures")
    save_failures(_deliver(spark, sf_dir), path, "first")
    done = reload(spark, path, Accepter)
    return done.agg(F.sum(F.col("records") - F.col("failed")).alias("replayed"))


class Shaky:
    """Refuses a statement with a transient text the first two times it is asked."""

    def __init__(self):
        self.asked = {}

    def execute(self, statement: str) -> str | None:
        if statement.count(": (") > 1:
            return "one by one, please"
        self.asked[statement] = self.asked.get(statement, 0) + 1
        return "x The leader has changed, y" if self.asked[statement] < 3 else None


class Dropper:
    """Loses its connection at statements that name one market segment."""

    def execute(self, statement: str) -> str | None:
        if '"HOUSEHOLD"' in statement:
            raise ConnectionError("gone")


class NoPermission:
    def execute(self, statement: str) -> str | None:
        return "E_BAD_PERMISSION: no"


def _customer_items(spark, sf_dir, tasks=None):
    rows = table(spark, sf_dir, "customer")
    return render_items(rows if tasks is None else rows.repartition(tasks, "c_custkey"), _CUSTOMER,
                        INT_GRAPH)


def _totals(results):
    return results.agg(F.sum(F.col("records") - F.col("failed")).alias("delivered"),
                       F.sum("failed").alias("refused"))


@query("SELECT count(*) AS delivered, 0::BIGINT AS refused FROM customer")
def deliver_retried(spark, sf_dir):
    """Rows refused twice with a transient error arrive in the end."""
    return _totals(write_batches(_customer_items(spark, sf_dir), "customer",
                                 statement_frame(_CUSTOMER), Shaky, DeliveryOptions(batch=50)))


@query("SELECT count(*) AS delivered, 0::BIGINT AS refused FROM customer")
def deliver_paced(spark, sf_dir):
    """A rate limit delays batches and loses none."""
    return _totals(write_batches(
        _customer_items(spark, sf_dir, 4), "customer", statement_frame(_CUSTOMER), Accepter,
        DeliveryOptions(batch=100, rate_per_partition=20.0)))


@query("SELECT count(*) AS delivered, 0::BIGINT AS refused, TRUE AS held FROM customer")
def deliver_one_rate(spark, sf_dir):
    """A limit for the whole load holds with one task and with four, and loses nothing."""
    rows, held, results = table(spark, sf_dir, "customer").count(), True, None
    for tasks in (1, 4):
        started = time.monotonic()
        results = write_batches(_customer_items(spark, sf_dir, tasks), "customer",
                                statement_frame(_CUSTOMER), Accepter,
                                DeliveryOptions(batch=10, rate=rows / 30, tasks=tasks))
        # a tenth of the rows are statements, at a thirtieth of them a second
        held = held and time.monotonic() - started >= 2.9
    return _totals(results).withColumn("held", F.lit(held))


@query("SELECT count(*) FILTER (c_mktsegment <> 'HOUSEHOLD') AS delivered, "
       "count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS refused FROM customer")
def deliver_dropped(spark, sf_dir):
    """An executor that raises loses the rows it raised at, not the load."""
    return _totals(write_batches(_customer_items(spark, sf_dir), "customer",
                                 statement_frame(_CUSTOMER), Dropper, DeliveryOptions(batch=200)))


@query("SELECT 'INSERT VERTEX `customer`(`name`,`nation`,`segment`) VALUES ' || c_custkey || "
       "': (\"' || c_name || '\", ' || c_nationkey || ', \"' || c_mktsegment || '\")' AS statement "
       "FROM customer")
def dead_letters(spark, sf_dir):
    """A load that is called off at its first statement leaves every row as a dead letter."""
    path = scratch_path(spark, "failures")
    results = write_batches(_customer_items(spark, sf_dir, 3), "customer",
                            statement_frame(_CUSTOMER), NoPermission, DeliveryOptions(batch=200))
    save_failures(results, path, "first")
    try:
        check_fatal(results)
    except FatalDeliveryError:
        return read_statements(spark, path)
    raise AssertionError("the load was not called off")


@query("SELECT count(*) AS rows, count(*) AS refused, TRUE AS stopped FROM customer")
def failure_budget(spark, sf_dir):
    """Past the budget nothing more is sent, the rest is kept, and the load stops."""
    results = write_batches(_customer_items(spark, sf_dir, 2), "customer",
                            statement_frame(_CUSTOMER), NoPermission,
                            DeliveryOptions(batch=50, fatal=(), max_failed_batches=2))
    try:
        check_budget(results, 2)
        stopped = False
    except TooManyFailures:
        stopped = True
    return results.agg(F.sum("records").alias("rows"), F.sum("failed").alias("refused"),
                       F.lit(stopped).alias("stopped"))


@query("SELECT count(*) AS kept FROM customer WHERE c_mktsegment = 'HOUSEHOLD'")
def failures_cleared(spark, sf_dir):
    """Clearing removes the failures of loads and keeps those of a replay."""
    path = scratch_path(spark, "failures")
    save_failures(_deliver(spark, sf_dir), path, "first")
    reload(spark, path, SegmentRefuser, failures=path, run="again")
    clear_failures(spark, path)
    return read_statements(spark, path).agg(F.count(F.lit(1)).alias("kept"))


@query("SELECT c_custkey || ': (\"' || c_name || '\", ' || c_nationkey || ', \"' || c_mktsegment || "
       "'\")' AS statement FROM customer")
def statement_files(spark, sf_dir):
    """Statement texts written as lines and read back."""
    path = scratch_path(spark, "statements")
    write_statements(_customer_items(spark, sf_dir), path, "item")
    return read_statements(spark, path)


def _small_job(sf_dir: str, source: dict, **more) -> Job:
    return Job.from_dict({
        "graph": {"parts": INT_GRAPH.parts, "id_type": "INT", "id_len": 8, "labels": {
            "customer": {"kind": "vertex", "number": 1,
                         "properties": {"name": "STRING", "segment": "STRING"}}}},
        "vertices": [{"label": "customer", "id": "c_custkey", "fields": ["c_name", "c_mktsegment"],
                      "targets": ["name", "segment"], "batch": 200, "source": source}], **more})


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def plug_in_source(spark, sf_dir):
    """A registered reader whose path comes from a run parameter; only needed columns are read."""
    register_source("tables_of_a_folder",
                    lambda session, spec, fields: table(session, spec["path"], spec["name"]))
    job = _small_job(sf_dir, {"type": "tables_of_a_folder", "path": "where", "name": "customer"})
    return prepared_rows(spark, job.entities[0], f"where={sf_dir}")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def dry_run(spark, sf_dir):
    """What a dry run of a sliced source shows (all of it here): nothing is indexed or sent."""
    source = {"type": "sliced", "of": {"type": "parquet", "path": f"{sf_dir}/customer.parquet"},
              "order_by": ["c_custkey"], "parallel": 3}
    return prepare_input(spark, _small_job(sf_dir, source).entities[0], plain=True).rows


@query("SELECT count(*) AS customers, 0::BIGINT AS twice FROM customer")
def resumed_job(spark, sf_dir):
    """A load that is called off in its first step and run again: every customer is accepted by
    the second run or a dead letter of the first, none both."""
    source = {"type": "sliced", "of": {"type": "parquet", "path": f"{sf_dir}/customer.parquet"},
              "order_by": ["c_custkey"], "parallel": 2, "steps": 4, "name": "customers",
              "checkpoint": scratch_path(spark, "progress")}
    results, dead = scratch_path(spark, "results"), scratch_path(spark, "failures")
    job = _small_job(sf_dir, source, results=results, failures=dead)
    for factory in (NoPermission, Accepter):
        try:
            run_job(spark, job, factory)
        except FatalDeliveryError:
            pass
    sent = spark.read.option("recursiveFileLookup", True).parquet(results)
    refused = read_statements(spark, dead)
    again = refused.groupBy("statement").count().filter("count > 1").count()
    return sent.agg(F.sum("records").alias("customers"), F.lit(again).cast("bigint").alias("twice"))


class Refuser:
    """Takes nothing, row by row."""

    def execute(self, statement: str) -> str | None:
        return "refused"


_STATEMENT = ("'INSERT VERTEX `customer`(`name`,`segment`) VALUES ' || c_custkey || ': (\"' || c_name "
              "|| '\", \"' || {segment} || '\")' AS statement")


@query(f"SELECT {_STATEMENT.format(segment='c_mktsegment')}, 1::BIGINT AS copies, TRUE AS noticed "
       "FROM customer")
def resumed_grown(spark, sf_dir):
    """A load that is called off after its first step; before the next run two thirds of the
    rows are added, above, below and between the keys of the first. The next run notices, and
    sends each row that no step has sent. No executor takes any, so every row that is sent is
    a dead letter."""
    folder, dead = scratch_path(spark, "in"), scratch_path(spark, "failures")
    source = {"type": "sliced", "of": {"type": "parquet", "path": folder}, "order_by": ["c_custkey"],
              "parallel": 3, "steps": 4, "name": "customers",
              "checkpoint": scratch_path(spark, "progress")}
    customers, noticed = table(spark, sf_dir, "customer"), False
    customers.filter("c_custkey % 3 = 1").write.parquet(folder)
    try:
        run_job(spark, _small_job(sf_dir, source, failures=dead), NoPermission)
    except FatalDeliveryError:
        pass
    customers.filter("c_custkey % 3 <> 1").write.mode("append").parquet(folder)
    try:
        run_job(spark, _small_job(sf_dir, source, failures=dead), Refuser)
    except SourceChanged:
        noticed = True
    job = _small_job(sf_dir, {**source, "on_change": "new"}, failures=dead)
    run_job(spark, job, Refuser)
    # everything has been sent
    run_job(spark, job, Refuser)
    return read_statements(spark, dead).groupBy("statement").agg(
        F.count(F.lit(1)).alias("copies")).withColumn("noticed", F.lit(noticed))


@query(f"SELECT {_STATEMENT.format(segment='c_mktsegment')}, 1::BIGINT AS copies FROM customer")
def files_job(spark, sf_dir):
    """A load in steps over the positions that the files give."""
    dead = scratch_path(spark, "failures")
    source = {"type": "sliced", "of": {"type": "parquet", "path": f"{sf_dir}/customer.parquet"},
              "parallel": 3, "steps": 2}
    run_job(spark, _small_job(sf_dir, source, failures=dead), Refuser)
    return read_statements(spark, dead).groupBy("statement").agg(F.count(F.lit(1)).alias("copies"))


_ZONE = "'Asia/Tokyo'"


@query(f"SELECT {_STATEMENT.format(segment=_ZONE)} FROM customer")
def job_settings(spark, sf_dir):
    """The settings of a job hold while it runs: here the time zone, which its source asks for."""
    source = {"type": "sql", "sentence": "SELECT c_custkey, c_name, current_timezone() AS "
              f"c_mktsegment FROM parquet.`{sf_dir}/customer.parquet`"}
    dead, before = scratch_path(spark, "failures"), spark.conf.get("spark.sql.session.timeZone")
    job = _small_job(sf_dir, source, failures=dead,
                     spark_conf={"spark.sql.session.timeZone": "Asia/Tokyo"})
    try:
        run_job(spark, job, Refuser)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    return read_statements(spark, dead)


@query("SELECT least(20, count(*))::BIGINT AS shown, least(20, count(*))::BIGINT AS known, "
       "0::BIGINT AS sent FROM customer")
def dry_run_job(spark, sf_dir):
    """A dry run of a whole job shows the first rows of its input and sends nothing."""
    dead = scratch_path(spark, "failures")
    source = {"type": "sliced", "of": {"type": "parquet", "path": f"{sf_dir}/customer.parquet"},
              "order_by": ["c_custkey"], "parallel": 3, "checkpoint": scratch_path(spark, "none"),
              "name": "customers"}
    report = run_job(spark, _small_job(sf_dir, source, failures=dead), Refuser, dry=True)
    shown = report.previews["customer-0"]
    known = shown.join(table(spark, sf_dir, "customer"), shown.columns, "left_semi").count()
    sent = read_statements(spark, dead).count() if failures_exist(spark, dead) else 0
    return shown.agg(F.count(F.lit(1)).alias("shown"), F.lit(known).cast("bigint").alias("known"),
                     F.lit(sent).cast("bigint").alias("sent"))


@query("SELECT c_mktsegment AS entity, count(*) AS delivered FROM customer GROUP BY 1")
def concurrent_entities(spark, sf_dir):
    """A job of one entity per market segment, several at a time, each with its own counters."""
    segments = [r[0] for r in table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
                .orderBy("c_mktsegment").collect()]
    labels = {s: {"kind": "vertex", "number": n + 1, "properties": {"name": "STRING"}}
              for n, s in enumerate(segments)}
    job = Job.from_dict({
        "graph": {"parts": 4, "id_type": "INT", "id_len": 8, "labels": labels},
        "spark_conf": {"spark.sql.files.maxPartitionBytes": "64m"},
        "vertices": [{"label": s, "id": "c_custkey", "fields": ["c_name"], "targets": ["name"],
                      "filter": f"c_mktsegment = '{s}'", "batch": 100, "partition": 2,
                      "source": {"type": "parquet", "path": f"{sf_dir}/customer.parquet"}}
                     for s in segments]})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        report = run_job(spark, job, Accepter, concurrent=3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return report.stats.filter("entity <> '(total)'").select(
        "entity", F.col("record_success").alias("delivered"))


_RESULTS = ("SELECT o_orderpriority AS entity, (o_custkey % 500 + 1)::INTEGER AS records, "
            "(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END)::INTEGER AS failed FROM orders")


@query(f"WITH r AS ({_RESULTS}) SELECT CASE WHEN grouping(entity) = 1 THEN '(total)' ELSE entity "
       "END AS entity, sum(CASE WHEN failed > 0 THEN 0 ELSE 1 END)::BIGINT AS batch_success, "
       "sum(CASE WHEN failed > 0 THEN 1 ELSE 0 END)::BIGINT AS batch_failure, "
       "sum(records - failed)::BIGINT AS record_success, sum(failed)::BIGINT AS record_failure, "
       "sum(records - failed) / 2.0 AS records_per_second FROM r GROUP BY ROLLUP (entity)", name="load_stats")
def load_counters(spark, sf_dir):
    """Counters over one result row per order."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity"),
        (F.col("o_custkey") % 500 + 1).cast("int").alias("records"),
        F.when(F.col("o_orderkey") % 9 == 0, 1).otherwise(0).alias("failed"))
    return load_stats(rows, seconds=2.0)


@query("SELECT 'event' AS entity, count(*) FILTER (event_type <> 'click') AS delivered FROM events")
def stream_vertices(spark, sf_dir):
    """Events as a stream of vertices. Clicks are given no id, so they are dropped."""
    rows = read_stream(spark, {
        "type": "file_stream", "path": sf_dir, "options": {"pathGlobFilter": "events.parquet"},
        "schema": table(spark, sf_dir, "events").schema})
    rows = rows.withColumn("vid", F.when(F.col("event_type") != "click", F.col("event_id")))
    spec = VertexSpec("event", "vid", ("event_type", "ts"), ("kind", "at"))
    results, failures = scratch_path(spark, "results"), scratch_path(spark, "failures")
    stream = stream_load(rows, spec, INT_GRAPH, Accepter, results, failures,
                         checkpoint=scratch_path(spark, "stream"), available_now=True)
    stream.awaitTermination()
    stats = load_stats(spark.read.parquet(results)).filter("entity = 'event'")
    return stats.select("entity", F.col("record_success").alias("delivered"))


def _event_stream(spark, folder, results, failures, state, factory=Accepter):
    """Load the files of a folder as a stream, one file a micro-batch, to its end."""
    rows = read_stream(spark, {
        "type": "file_stream", "path": folder, "max_files_per_trigger": 1,
        "schema": "event_id bigint, event_type string, ts timestamp_ntz"})
    spec = VertexSpec("event", "event_id", ("event_type", "ts"), ("kind", "at"))
    stream_load(rows, spec, INT_GRAPH, factory, results, failures, DeliveryOptions(batch=1000),
                checkpoint=state, available_now=True).awaitTermination()


@query("SELECT count(*) AS rows, count(*) FILTER (event_type = 'click') AS dropped, "
       "2::BIGINT AS batches, count(*) FILTER (event_type <> 'click') AS record_success, "
       "0::BIGINT AS record_failure FROM events")
def stream_counters(spark, sf_dir):
    """Counters of a stream while it runs (rows, dropped ones, micro-batches) and of its results."""
    folder, results = scratch_path(spark, "in"), scratch_path(spark, "results")
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "click", F.col("event_id")).alias("event_id"), "event_type", "ts")
    events.repartition(2, "ts").write.parquet(folder)
    counters = StreamCounters()
    spark.streams.addListener(counters)
    try:
        _event_stream(spark, folder, results, scratch_path(spark, "failures"),
                      scratch_path(spark, "state"))
        # progress is told after the micro-batch
        for _ in range(100):
            if sum(t["batches"] for t in counters.totals.values()) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    total = next(iter(counters.totals.values()))
    return stream_stats(spark, results).agg(
        *[F.lit(total[n]).cast("bigint").alias(n) for n in ("rows", "dropped", "batches")],
        F.sum("record_success").alias("record_success"),
        F.sum("record_failure").alias("record_failure"))


class ClickRefuser:
    def execute(self, statement: str) -> str | None:
        return "refused" if '"click"' in statement else None


def _event_files(spark, sf_dir, folder, half):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    events.filter(F.col("event_id") % 2 == half).repartition(2, "event_id").write.mode(
        "append").parquet(folder)


@query("SELECT count(*) AS records, 2::BIGINT AS runs, 4::BIGINT AS batches FROM events")
def stream_restart(spark, sf_dir):
    """A stream that stops and starts again from its checkpoint sends every event once.

    Each micro-batch takes one of the four files.
    """
    folder, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    results, failures = scratch_path(spark, "results"), scratch_path(spark, "failures")
    for half in (0, 1):
        _event_files(spark, sf_dir, folder, half)
        _event_stream(spark, folder, results, failures, state)
    sent = spark.read.parquet(results)
    return sent.agg(F.sum("records").alias("records"), F.lit(2).cast("bigint").alias("runs"),
                    F.count_distinct("query", "epoch").alias("batches"))


@query("SELECT 'INSERT VERTEX `event`(`kind`,`at`) VALUES ' || event_id || ': (\"click\", "
       "datetime(\"' || ts::VARCHAR || '\"))' AS statement, "
       "2::BIGINT AS copies FROM events WHERE event_type = 'click'", name="stream_dead_letters")
def dead_letters_of_streams(spark, sf_dir):
    """Dead letters of a stream, and of another that starts anew on the same paths."""
    folder, failures = scratch_path(spark, "in"), scratch_path(spark, "failures")
    for half in (0, 1):
        _event_files(spark, sf_dir, folder, half)
    results = scratch_path(spark, "results")
    for state in ("one", "two"):
        _event_stream(spark, folder, results, failures, scratch_path(spark, state), ClickRefuser)
    return read_statements(spark, failures).groupBy("statement").agg(
        F.count(F.lit(1)).alias("copies"))


_VOTES = """
WITH e AS (SELECT l_partkey * 2 AS a, l_suppkey * 2 + 1 AS b FROM lineitem),
edges AS (SELECT a AS src, b AS dst FROM e UNION ALL SELECT b, a FROM e),
l0 AS (SELECT DISTINCT src AS id, src AS label FROM edges)
"""


def _vote(n: int) -> str:
    return f""",
t{n} AS (SELECT id, label, sum(n) AS n FROM (
    SELECT dst AS id, label, count(*) AS n FROM edges JOIN l{n - 1} ON src = id GROUP BY ALL
    UNION ALL SELECT id, label, 1 FROM l{n - 1}) GROUP BY id, label),
l{n} AS (SELECT id, label FROM (SELECT *, row_number() OVER
    (PARTITION BY id ORDER BY n DESC, label) AS place FROM t{n}) WHERE place = 1)"""


def _part_supplier(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    a, b = F.col("l_partkey") * 2, F.col("l_suppkey") * 2 + 1
    edges = lines.select(F.inline(F.array(F.struct(a.alias("src"), b.alias("dst")),
                                          F.struct(b.alias("src"), a.alias("dst")))))
    return edges.select(F.col("src").alias("id")).distinct(), edges


@query(_VOTES + _vote(1) + " SELECT id, label FROM l1")
def label_round1(spark, sf_dir):
    """One vote among parts and suppliers; every line is a vote in both directions."""
    return peer_pressure(*_part_supplier(spark, sf_dir), max_iter=1, partial=True)


@query(_VOTES + _vote(1) + _vote(2) + _vote(3)
       + " SELECT count(DISTINCT label) AS clusters FROM l3")
def label_clusters(spark, sf_dir):
    """Clusters after three votes."""
    return cluster_count(peer_pressure(*_part_supplier(spark, sf_dir), max_iter=3, partial=True))


@query("SELECT c_custkey AS id, c_custkey AS label FROM customer UNION ALL "
       "SELECT 1000000000 + o_orderkey, o_custkey FROM orders")
def label_converged(spark, sf_dir):
    """Customers and their orders, voted on until no label changes: a cluster per customer."""
    orders = table(spark, sf_dir, "orders")
    a, b = F.col("o_custkey"), F.col("o_orderkey") + 1000000000
    edges = orders.select(F.inline(F.array(F.struct(a.alias("src"), b.alias("dst")),
                                           F.struct(b.alias("src"), a.alias("dst")))))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return peer_pressure(customers.unionByName(orders.select(b.alias("id"))), edges)
