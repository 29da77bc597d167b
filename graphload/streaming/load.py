"""Streams of rows delivered micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.delivery import (
    DeliveryOptions, check_budget, check_fatal, deliver, save_failures,
)
from ..operators.prepare import enforce, problem_of
from ..operators.statements import render_items, statement_frame
from ..spec import EdgeSpec, GraphTarget, VertexSpec

DEFAULT_INTERVAL_S = 30


# Name of the counters that a load observes; the label of the entity follows.
OBSERVED = "graphload."
# Micro-batches that a listener keeps of every query, besides the totals.
KEPT = 1000


class StreamCounters(StreamingQueryListener):
    """Live counters of the loads of a session: ``spark.streams.addListener(counters)``.

    For every micro-batch the rows that came and those that were dropped as invalid, counted
    while they pass, without another job. What was sent and refused is in the results of the
    load (``stream_stats``). A micro-batch that is made again counts once, under its number.
    """

    def __init__(self):
        self.batches: dict[str, dict[int, dict]] = {}
        self.totals: dict[str, dict] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:
        self.take(str(event.progress.id), event.progress.batchId, event.progress.observedMetrics,
                  event.progress.batchDuration)

    def take(self, query: str, epoch: int, observed: dict, milliseconds: int) -> None:
        """Count a micro-batch."""
        found = [row for name, row in observed.items() if name.startswith(OBSERVED)]
        kept = self.batches.setdefault(query, {})
        if not found or epoch in kept:
            return
        kept[epoch] = {"rows": found[0].rows, "dropped": found[0].dropped,
                       "seconds": milliseconds / 1000}
        total = self.totals.setdefault(query, {"batches": 0, "rows": 0, "dropped": 0,
                                               "seconds": 0.0})
        total["batches"] += 1
        for name, value in kept[epoch].items():
            total[name] += value
        for old in sorted(kept)[:-KEPT]:
            del kept[old]

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception


def stream_stats(spark: SparkSession, results_path: str) -> DataFrame:
    """Counters of every micro-batch of the streams that write results there, as
    ``load_stats`` gives them for a batch load: query, epoch, batches and records that were
    accepted and refused. Only results that were written to their end count."""
    results = spark.read.parquet(results_path)
    bad = F.col("failed") > 0
    return results.groupBy("query", "epoch", "entity").agg(
        F.count_if(~bad).alias("batch_success"), F.count_if(bad).alias("batch_failure"),
        F.sum(F.col("records") - F.col("failed")).alias("record_success"),
        F.sum("failed").alias("record_failure"))


def stream_statements(rows: DataFrame, spec: VertexSpec | EdgeSpec, target: GraphTarget
                      ) -> DataFrame:
    """Fragments of the valid rows; invalid rows are dropped, not fatal, and counted."""
    problem = problem_of(spec, target.id_type, rows.schema)
    seen = rows.observe(OBSERVED + spec.label, F.count(F.lit(1)).alias("rows"),
                        F.count_if(problem.isNotNull()).alias("dropped"))
    return render_items(enforce(seen, problem, "drop"), spec, target)


def stream_load(rows: DataFrame, spec: VertexSpec | EdgeSpec, target: GraphTarget,
                factory: Callable[[], object], results_path: str, failures_path: str,
                options: DeliveryOptions = DeliveryOptions(), checkpoint: str | None = None,
                interval_s: int = DEFAULT_INTERVAL_S, available_now: bool = False,
                name: str | None = None) -> StreamingQuery:
    """Start loading a stream under a query name (the label by default).

    Results and dead letters go to folders named by the id of the query and the
    number of the micro-batch. The id lives in the checkpoint: a micro-batch that runs
    again replaces what its earlier try left, and a stream that starts anew, without
    its checkpoint, has another id and leaves the folders of earlier streams alone.
    Without ``checkpoint`` a restart reads the source from its start.
    """
    items = stream_statements(rows, spec, target)
    frame = statement_frame(spec)

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query_id is None:
            raise RuntimeError("a micro-batch without the id of its query")
        path = f"{results_path}/query={query_id}/epoch={epoch}"
        sent = deliver(batch, spec.label, frame, factory, options)
        sent.write.mode("overwrite").parquet(path)
        results = spark.read.schema(sent.schema).parquet(path)
        save_failures(results, failures_path, f"query={query_id}/epoch={epoch}", "overwrite")
        check_fatal(results)
        check_budget(results, options.max_failed_batches)

    writer = items.writeStream.queryName(name or spec.label).foreachBatch(load)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_s} seconds")
    return writer.start()
