"""A load described as data: entities, their sources, and where they go."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import graph_part
from ..functions.text import _col
from ..operators.delivery import (
    DeliveryOptions, check_budget, check_fatal, save_failures, write_batches,
)
from ..operators.kv import edge_kv, vertex_kv
from ..operators.positions import file_offsets, read_file_slices
from ..operators.prepare import (
    apply_filter, enforce, preview, problem_of, required_fields, with_composite_key,
)
from ..operators.rows import repartition_to
from ..operators.publish import new_run, publish_kv, retire
from ..operators.resume import Load, mark_step, plan_load
from ..operators.slices import (
    Slice, offset_splits, read_slices, rows_of_step, source_count, step_of,
)
from ..operators.statements import (
    id_value, item_of, rank_value, render_items, statement_frame,
)
from ..operators.stats import load_stats
from ..sources import read_source, resolve_paths
from ..spec import EdgeSpec, GraphTarget, Label, VertexSpec, bind_schema
from ..storage import remove, scratch_path
from ..streaming import StreamCounters, stream_load

SINKS = ("statements", "kv")
# Parts that a resumable read is delivered in.
STEPS = 8
STREAMS = ("kafka", "pulsar", "file_stream", "stream")

_VERTEX_KEYS = ("label", "id", "policy", "prefix", "mode", "ignore_index", "delete_edge")
_EDGE_KEYS = ("label", "src", "dst", "rank", "src_policy", "dst_policy", "src_prefix",
              "dst_prefix", "mode", "ignore_index")
_COMMON_KEYS = ("source", "fields", "targets", "filter", "composite_keys", "sink", "batch",
                "partition", "checkpoint", "interval_s")


@dataclass(frozen=True)
class Entity:
    """One source feeding one label. Labels may be fed by several entities."""

    spec: VertexSpec | EdgeSpec
    source: dict
    filter: str | None = None
    composite_keys: tuple[dict, ...] = ()
    sink: str = "statements"
    batch: int = 500
    partition: int = -1
    checkpoint: str | None = None
    interval_s: int = 30

    def __post_init__(self):
        if self.sink not in SINKS:
            raise ValueError(f"unknown sink {self.sink!r}; use one of {SINKS}")
        if self.batch <= 0:
            raise ValueError(f"{self.spec.label}: batch must be positive")
        if "type" not in self.source:
            raise ValueError(f"{self.spec.label}: the source needs a type")
        if self.streaming and self.sink == "kv":
            raise ValueError(f"{self.spec.label}: streams are delivered as statements")
        if self.resumable and self.sink == "kv":
            raise ValueError(f"{self.spec.label}: key/value files are written whole; "
                             "leave out the checkpoint of the source")
        if (self.sliced and not self.source.get("order_by") and not self.resumable
                and self.source["of"]["type"].lower() != "parquet"):
            raise ValueError(f"{self.spec.label}: only Parquet files give an order; name order_by")
        if self.resumable and "name" not in self.source:
            raise ValueError(f"{self.spec.label}: a checkpoint needs a name")
        if self.streaming and self.checkpoint is None:
            raise ValueError(f"{self.spec.label}: a stream needs a checkpoint folder")

    @property
    def streaming(self) -> bool:
        return self.source["type"].lower() in STREAMS

    @property
    def sliced(self) -> bool:
        return self.source["type"].lower() == "sliced"

    @property
    def resumable(self) -> bool:
        return self.sliced and bool(self.source.get("checkpoint"))

    @staticmethod
    def from_dict(kind: str, d: dict) -> "Entity":
        keys = _VERTEX_KEYS if kind == "vertex" else _EDGE_KEYS
        unknown = set(d) - set(keys) - set(_COMMON_KEYS)
        if unknown:
            raise ValueError(f"unknown entity settings: {sorted(unknown)}")
        if "label" not in d or "source" not in d:
            raise ValueError("an entity needs a label and a source")
        args = {k: d[k] for k in keys if k in d}
        args["mode"] = args.get("mode", "insert").lower()
        args["fields"] = tuple(d.get("fields", ()))
        if d.get("targets") is not None:
            args["targets"] = tuple(d["targets"])
        spec = VertexSpec(**args) if kind == "vertex" else EdgeSpec(**args)
        rest = {k: d[k] for k in ("filter", "sink", "batch", "partition", "checkpoint",
                                  "interval_s") if k in d}
        return Entity(spec, dict(d["source"]), composite_keys=tuple(d.get("composite_keys", ())),
                      **rest)


@dataclass(frozen=True)
class Job:
    target: GraphTarget
    entities: tuple[Entity, ...]
    spark_conf: dict[str, str] = field(default_factory=dict)
    delivery: DeliveryOptions = DeliveryOptions()
    existence: bool = False
    failures: str | None = None
    results: str | None = None
    kv_path: str | None = None
    kv_keep: int | None = None

    @staticmethod
    def from_dict(d: dict) -> "Job":
        """Build and check a job; every label and property is checked here."""
        graph = d["graph"]
        labels = {name: Label.of(spec["kind"], spec.get("properties", {}), spec.get("number", 0))
                  for name, spec in graph["labels"].items()}
        target = GraphTarget(graph["parts"], graph.get("id_type", "STRING"),
                             graph.get("id_len", 8), labels, graph.get("empty_marker"))
        entities = tuple([Entity.from_dict("vertex", e) for e in d.get("vertices", ())]
                         + [Entity.from_dict("edge", e) for e in d.get("edges", ())])
        if not entities:
            raise ValueError("a job needs at least one vertex or edge entity")
        for entity in entities:
            bind_schema(entity.spec, target)
        options = dict(d.get("delivery", {}))
        for key in ("transient", "fatal"):
            if key in options:
                options[key] = tuple(options[key])
        job = Job(target, entities, dict(d.get("spark_conf", {})), DeliveryOptions(**options),
                  d.get("existence", False), d.get("failures"), d.get("results"), d.get("kv_path"),
                  d.get("kv_keep"))
        if job.kv_keep is not None and job.kv_keep < 1:
            raise ValueError("kv_keep is the number of published sets that stay, 1 or more")
        if job.kv_path is None and any(e.sink == "kv" for e in entities):
            raise ValueError("kv entities need kv_path")
        if job.failures is None and any(e.resumable for e in entities):
            raise ValueError("a step that is over is not sent again, so a job with a checkpoint "
                             "needs failures, the folder of the rows that were not accepted")
        return job


@dataclass
class JobReport:
    """What a run did. ``stats`` has the counters of all delivered entities.

    ``run`` names the folders of this run below ``results`` and ``failures``, the folder of
    the dead letters (one in the shared folder when the job names none). ``kv_paths`` has
    the files of this run; ``kv_path``/<entity> is where readers find the current set.
    ``counters`` follow the streams while they run; ``called_off`` names entities that were
    ended by another's error.
    """

    run: str = ""
    failures: str = ""
    stats: DataFrame | None = None
    previews: dict[str, DataFrame] = field(default_factory=dict)
    kv_paths: dict[str, str] = field(default_factory=dict)
    streams: list = field(default_factory=list)
    called_off: list[str] = field(default_factory=list)
    counters: StreamCounters | None = None
    seconds: float = 0.0


@dataclass(frozen=True)
class Input:
    """Rows of an entity.

    Those of a sliced read have ``row_index`` and their slices, those of one with a
    checkpoint ``__step`` and the load they belong to. ``indexed`` is the copy that was made.
    """

    rows: DataFrame
    slices: list[Slice] | None = None
    load: Load | None = None
    indexed: str | None = None

    @property
    def index(self) -> list[str]:
        return ["row_index"] if self.slices is not None else ["__step"] if self.load else []


def _named_columns(rows: DataFrame, condition: str | None, needed: list[str]) -> list[str]:
    """``needed`` and the columns that a condition names."""
    def enough(columns: list[str]) -> bool:
        # an empty table: a projection would quietly get the missing columns from below
        schema = StructType([rows.schema[c] for c in columns])
        try:
            rows.sparkSession.createDataFrame([], schema).filter(condition)
        except AnalysisException:
            return False
        return True

    if condition is None or enough(needed):
        return needed
    kept = list(rows.columns)
    for name in rows.columns:
        if name not in needed and enough([c for c in kept if c != name]):
            kept.remove(name)
    return kept


def _read(spark: SparkSession, entity: Entity, fields: list[str], params: str | None,
          plain: bool) -> Input | None:
    """A source, or what earlier runs have left of one.

    ``{"type": "sliced", "of": source, "order_by": [...], "parallel": n, "steps": n,
    "checkpoint": folder, "name": name, "on_change": "refuse"}`` cuts another source into
    slices and delivers them in steps. With a checkpoint each step that is over is marked
    there, and later runs send the others only; ``on_change`` says what they do when the
    source has other rows by then (``plan_load``). Without ``order_by`` and checkpoint the
    rows of a Parquet source keep the order of its files, and nothing is sorted or copied.
    ``plain`` gives the rows of the other source as they are and writes nothing.
    """
    source, sliced = entity.source, entity.sliced
    rows = read_source(spark, resolve_paths(source["of"] if sliced else source, params), fields)
    if rows is None or not sliced or plain:
        return None if rows is None else Input(rows)
    kind, order_by = source["of"]["type"].lower(), list(source.get("order_by", ()))
    scan = kind in ("parquet", "orc", "json", "csv")
    wanted = list(dict.fromkeys([*fields, *order_by]))
    columns = _named_columns(rows, entity.filter, wanted)
    rows = rows.select(*map(_col, columns))
    if entity.resumable:
        load = plan_load(spark, rows, order_by, source["parallel"], source["checkpoint"],
                         source["name"], source.get("steps", STEPS),
                         source.get("on_change", "refuse"), scan)
        left = rows.withColumn("__step", F.lit(0)).limit(0) if load.rows is None else load.rows
        return Input(left, load=load, indexed=load.path)
    if not order_by:
        files = file_offsets(rows)
        return Input(read_file_slices(rows, source["parallel"], files=files),
                     offset_splits(files.total, source["parallel"]))
    slices = offset_splits(source_count(rows).first()["n"], source["parallel"])
    path = scratch_path(spark, "indexed")
    return Input(read_slices(rows, order_by, slices, scan, path), slices, indexed=path)


def prepare_input(spark: SparkSession, entity: Entity, params: str | None = None,
                  plain: bool = False) -> Input | None:
    """Source rows after filter and composite keys, cut down to the needed columns."""
    keys = [k["new_col"] for k in entity.composite_keys]
    parts = [c for k in entity.composite_keys for c in k["cols"]]
    needed = [f for f in required_fields(entity.spec) if f not in keys]
    found = _read(spark, entity, list(dict.fromkeys(needed + parts)), params, plain)
    if found is None:
        return None
    rows = apply_filter(found.rows, entity.filter)
    for key in entity.composite_keys:
        rows = with_composite_key(rows, key["sep"], key["cols"], key["new_col"])
    return replace(found, rows=rows.select(*map(_col, required_fields(entity.spec)), *found.index))


def prepared_rows(spark: SparkSession, entity: Entity, params: str | None = None
                  ) -> DataFrame | None:
    found = prepare_input(spark, entity, params)
    return None if found is None else found.rows.drop(*found.index)


def _parts(entity: Entity, found: Input, rows: DataFrame) -> list[tuple[int, DataFrame]]:
    """(number, rows) of the parts that an entity is delivered in, one after the other."""
    if found.load is not None:
        # a load that is over has no rows
        return [(k, rows.filter(F.col("__step") == k).drop("__step"))
                for k in found.load.steps or [0]]
    if found.slices is None:
        return [(0, repartition_to(rows, entity.partition))]
    steps = step_of(found.slices, entity.source.get("steps", STEPS))
    return [(k, rows_of_step(rows, step).drop("row_index")) for k, step in enumerate(steps)
            if any(s.size for s in step)]


def _deliver(spark: SparkSession, job: Job, entity: Entity, rows: DataFrame, name: str, factory,
             stored: str, failures: str) -> DataFrame:
    """Send rows once; what failed is saved before anything calls the load off."""
    items = render_items(rows, entity.spec, job.target)
    options = replace(job.delivery, batch=entity.batch)
    if entity.partition > 0 and not entity.sliced:
        options = replace(options, tasks=options.tasks or entity.partition)
    results = write_batches(items, entity.spec.label, statement_frame(entity.spec), factory,
                            options, stored)
    save_failures(results, failures, name)
    return results


def _run_entity(spark: SparkSession, job: Job, number: int, entity: Entity, found: Input,
                factory, run: str, report: JobReport) -> DataFrame | None:
    spec, name, rows = entity.spec, f"{entity.spec.label}-{number}", found.rows
    failures = report.failures
    stored = f"{job.results}/{report.run}" if job.results else f"{run}/results"
    dead = f"{report.run}.{name}"
    if rows.isStreaming:
        options = replace(job.delivery, batch=entity.batch)
        report.streams.append(stream_load(
            rows, spec, job.target, factory, f"{stored}/{name}", f"{failures}/{name}",
            options, entity.checkpoint, entity.interval_s, name=name))
        return None
    rows = enforce(rows, problem_of(spec, job.target.id_type, rows.schema), "fail",
                   spec.key_fields[0])
    if entity.sink == "kv":
        rows = rows.drop(*found.index)
        kv = (vertex_kv(rows, spec, job.target, job.existence) if spec.kind == "vertex"
              else edge_kv(rows, spec, job.target))
        path = f"{job.kv_path}/{name}"
        report.kv_paths[name] = publish_kv(
            kv, path, report.run, entity.partition if entity.partition > 0 else None).data
        if job.kv_keep is not None:
            retire(spark, path, job.kv_keep)
        return None
    results = None
    for part, rows in _parts(entity, found, rows):
        folder = f"{stored}/{name}/{part}" if found.index else f"{stored}/{name}"
        sent = _deliver(spark, job, entity, rows, dead, factory, folder, failures)
        if found.load is not None and found.load.steps:
            # what failed is in the dead letters, so the step is over
            source = entity.source
            mark_step(spark, found.load, source["checkpoint"], source["name"], part)
        check_fatal(sent)
        results = sent if results is None else results.unionByName(sent)
        check_budget(results, job.delivery.max_failed_batches)
    return results


def _run_all(spark: SparkSession, report: JobReport, inputs: list[tuple[int, Entity, Input]],
             work: Callable, concurrent: int, cancel: bool) -> tuple[list, list[Exception]]:
    """(results, errors) of all entities, first error first.

    Each entity runs in its own thread, job group, tag and scheduler pool, so that one
    with many tasks does not hold up the others where the session shares fairly
    (``spark.scheduler.mode`` FAIR) and its jobs can be told apart. With ``cancel`` the
    first error ends what runs of the others and keeps the rest from starting.
    """
    sc = spark.sparkContext

    def run(number: int, entity: Entity, found: Input):
        name = f"{entity.spec.label}-{number}"
        sc.setJobGroup(name, f"{entity.spec.kind} {entity.spec.label}")
        sc.setLocalProperty("spark.scheduler.pool", name)
        if not entity.streaming:
            # streams outlive this thread and are stopped by their query; besides, Python
            # listeners of Spark 4.1 cannot read the start of a stream that has tags
            sc.addJobTag(f"{report.run}.{name}")
        return work(number, entity, found)

    tables, errors = [], []
    with ThreadPoolExecutor(max_workers=max(1, concurrent)) as pool:
        # one wrapper per task: each keeps its own copy of the local properties
        running = {pool.submit(inheritable_thread_target(spark)(run), n, e, found):
                   f"{e.spec.label}-{n}" for n, e, found in inputs}
        left = set(running)
        while left:
            ending = cancel and errors
            if ending:
                # again and again: one may just be between two jobs
                for future in left:
                    if not future.cancel():
                        sc.cancelJobsWithTag(f"{report.run}.{running[future]}")
            done, left = wait(left, 0.5 if ending else None, FIRST_COMPLETED)
            for future in done:
                error = None if future.cancelled() else future.exception()
                if future.cancelled() or (ending and error is not None):
                    report.called_off.append(running[future])
                if error is not None:
                    errors.append(error)
                elif not future.cancelled() and future.result() is not None:
                    tables.append(future.result())
    return tables, errors


def run_job(spark: SparkSession, job: Job, factory: Callable[[], object] | None = None,
            params: str | None = None, dry: bool = False, concurrent: int = 4,
            on_error: str = "finish") -> JobReport:
    """Run all entities, several at a time.

    Streams are started and returned running; wait with
    ``spark.streams.awaitAnyTermination()``. When an entity fails, the others run to
    their end, or are called off at once with ``on_error="cancel"`` (what a step that was
    called off had sent is sent again by a later run: at least once); streams are stopped,
    and the error carries the ``report`` of the rest.
    """
    if on_error not in ("finish", "cancel"):
        raise ValueError(f"unknown on_error {on_error!r}; use finish or cancel")
    for key, value in job.spark_conf.items():
        spark.conf.set(key, value)
    report, started = JobReport(new_run()), time.monotonic()
    inputs = [(n, e, prepare_input(spark, e, params, plain=dry))
              for n, e in enumerate(job.entities)]
    inputs = [(n, e, found) for n, e, found in inputs if found is not None]
    if dry:
        report.previews = {f"{e.spec.label}-{n}": preview(found.rows)
                           for n, e, found in inputs if not found.rows.isStreaming}
        return report
    if factory is None and any(e.sink == "statements" for _, e, _ in inputs):
        raise ValueError("statement entities need an executor factory")
    run = scratch_path(spark, report.run)
    report.failures = job.failures or f"{run}/failures"
    if job.delivery.rate is not None:
        # one rate for all entities that deliver at a time; streams all do
        sending = [e for _, e, _ in inputs if e.sink == "statements"]
        streams = sum(e.streaming for e in sending)
        at_once = max(1, streams + min(max(1, concurrent), len(sending) - streams))
        job = replace(job, delivery=replace(job.delivery, rate=job.delivery.rate / at_once))

    def work(number: int, entity: Entity, found: Input):
        try:
            return _run_entity(spark, job, number, entity, found, factory, run, report)
        finally:
            if found.indexed is not None:
                remove(spark, found.indexed)

    if any(e.streaming for _, e, _ in inputs):
        report.counters = StreamCounters()
        spark.streams.addListener(report.counters)
    tables, errors = _run_all(spark, report, inputs, work, concurrent, on_error == "cancel")
    report.seconds = time.monotonic() - started
    if tables:
        results = reduce(DataFrame.unionByName, tables)
        report.stats = load_stats(results, report.seconds)
    if errors:
        for query in report.streams:
            query.stop()
        if report.counters is not None:
            spark.streams.removeListener(report.counters)
        errors[0].report = report
        raise errors[0]
    return report


def _canonical(job: Job, spec: VertexSpec | EdgeSpec, rows: DataFrame) -> DataFrame:
    target, schema = job.target, rows.schema
    rows = enforce(rows, problem_of(spec, target.id_type, schema), "fail", spec.key_fields[0])
    label, item = F.lit(spec.label).alias("label"), item_of(rows, spec, target).alias("item")
    if spec.kind == "vertex":
        vid = id_value(schema, spec.id, target, spec.policy, spec.prefix)
        out = rows.select(label, vid.alias("vid"), item)
        return out.withColumn("part", graph_part("vid", target.parts, target.id_type))
    rank = rank_value(schema, spec.rank) if spec.rank else F.lit(0).cast("bigint")
    out = rows.select(
        label, id_value(schema, spec.src, target, spec.src_policy, spec.src_prefix).alias("src"),
        id_value(schema, spec.dst, target, spec.dst_policy, spec.dst_prefix).alias("dst"),
        rank.alias("rank"), item)
    return out.withColumn("part", graph_part("src", target.parts, target.id_type))


def _all_of(spark: SparkSession, job: Job, kind: str) -> DataFrame:
    sources = [(e.spec, prepared_rows(spark, e)) for e in job.entities if e.spec.kind == kind]
    frames = [_canonical(job, spec, rows) for spec, rows in sources if rows is not None]
    if not frames:
        raise ValueError(f"the job has no {kind} rows")
    return reduce(DataFrame.unionByName, frames)


def vertices_of(spark: SparkSession, job: Job) -> DataFrame:
    """All vertices of a job: label, vid, item, part."""
    return _all_of(spark, job, "vertex")


def edges_of(spark: SparkSession, job: Job) -> DataFrame:
    """All edges of a job: label, src, dst, rank, item, part."""
    return _all_of(spark, job, "edge")
