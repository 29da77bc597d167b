"""Delivering statements through a user's executor, with retry and dead letters.

An executor is made in the task by ``factory()`` and has
``execute(statement) -> error text or None`` and optionally ``close()``.
Delivery is at least once: a task that is lost sends its batches again. Nothing an
executor does or raises fails a task: what was not accepted is in the results, so
that it can be saved before a load is called off.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _col
from ..sources.files import read_statements
from ..storage import file_system, write_once
from .statements import Frame

RESULT = ("entity string, part int, batch bigint, records int, failed int, "
          "sent boolean, failed_stmts array<string>, error string, fatal boolean")
_RESULT_ARROW = pa.schema([
    ("entity", pa.string()), ("part", pa.int32()), ("batch", pa.int64()),
    ("records", pa.int32()), ("failed", pa.int32()), ("sent", pa.bool_()),
    ("failed_stmts", pa.list_(pa.string())), ("error", pa.string()), ("fatal", pa.bool_()),
])
# Results are handed on after so many batches, or so many characters of failed statements.
RESULT_ROWS = 64
RESULT_CHARS = 8 << 20

# Error texts after which a row is worth sending again, and those
# after which nothing more should be sent.
TRANSIENT = (
    "Storage Error: RPC failure, probably timeout",
    "raft buffer is full. Please retry later",
    "The leader has changed",
)
FATAL = ("E_BAD_PERMISSION",)


class FatalDeliveryError(RuntimeError):
    pass


class TooManyFailures(RuntimeError):
    pass


@dataclass(frozen=True)
class DeliveryOptions:
    """How to send.

    ``rate`` is statements a second of the whole load: its permits are dealt to the tasks
    that run at a time (``running_tasks``; ``tasks`` is their number where the caller knows
    it), so the rate is the same with few tasks and with many, and lower only while the last
    ones end.
    ``rate_per_partition`` is statements a second and task. A batch waits for its permit;
    with ``rate_timeout_s`` a batch whose permit is further away is given up and kept as
    failed. ``max_failed_batches`` is counted in each task; the load as a whole is checked
    against it afterwards.
    """

    batch: int = 500
    retry: int = 3
    interval_s: float = 0.0
    transient: tuple[str, ...] = TRANSIENT
    fatal: tuple[str, ...] = FATAL
    max_failed_batches: int | None = None
    rate_per_partition: float | None = None
    rate_timeout_s: float | None = None
    rate: float | None = None
    tasks: int | None = None


class _Pace:
    """Permits at a fixed rate; with a timeout, one that is further away is refused.

    The first is free at once, or after one step where many short tasks share a rate.
    """

    def __init__(self, rate: float | None, timeout: float | None, shared: bool = False):
        self.step = 0.0 if rate is None else 1.0 / rate
        self.timeout = timeout
        self.free_at = time.monotonic() + (self.step if shared else 0.0)

    def take(self) -> bool:
        now = time.monotonic()
        wait = self.free_at - now
        if self.timeout is not None and wait > self.timeout:
            # wait the timeout out, as a caller blocked on the permit would
            time.sleep(self.timeout)
            return False
        if wait > 0:
            time.sleep(wait)
        self.free_at = max(now, self.free_at) + self.step
        return True


class _Sender:
    """Sends the batches of one task. After a fatal error nothing more is sent."""

    def __init__(self, factory: Callable[[], object], frame: Frame, options: DeliveryOptions):
        self.frame, self.options = frame, options
        self.pace = _Pace(options.rate_per_partition, options.rate_timeout_s,
                          options.rate is not None)
        self.failed_batches = 0
        self.fatal = self.error = self.executor = None
        try:
            self.executor = factory()
        except Exception as raised:
            self.fatal = self.error = _text_of(raised)

    def close(self) -> None:
        if hasattr(self.executor, "close"):
            self.executor.close()

    def _try(self, statement: str) -> str | None:
        try:
            error = self.executor.execute(statement)
        except Exception as raised:
            # a dropped connection and the like: one more error of this statement
            error = _text_of(raised)
        if error is not None:
            self.error = error
            if any(p in error for p in self.options.fatal):
                self.fatal = error
        return error

    def _one(self, statement: str) -> bool:
        if self.fatal is not None:
            return False
        error = self._try(statement)
        left = self.options.retry
        while (error is not None and self.fatal is None and left > 0
               and any(p in error for p in self.options.transient)):
            time.sleep(self.options.interval_s)
            left -= 1
            error = self._try(statement)
        return error is None

    def send(self, items: pa.Array) -> tuple[bool, list[str]]:
        """(was it sent, statements that failed, one per row)."""
        if self.fatal is not None:
            return False, self._alone(items)
        budget = self.options.max_failed_batches
        if budget is not None and self.failed_batches >= budget:
            self.error = "over the failure budget"
            return False, self._alone(items)
        if not self.pace.take():
            self.error = "no permit in time"
            self.failed_batches += 1
            return False, self._alone(items)
        self.error = None
        if self._try(self._together(items)) is None:
            return True, []
        failed = [statement for statement in self._alone(items) if not self._one(statement)]
        self.failed_batches += bool(failed)
        return True, failed

    def _together(self, items: pa.Array) -> str:
        one_list = pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)
        return self.frame.head + pc.binary_join(one_list, self.frame.sep)[0].as_py() + (
            self.frame.tail)

    def _alone(self, items: pa.Array) -> list[str]:
        return [self.frame.join([item]) for item in items.to_pylist()]


def _text_of(raised: Exception) -> str:
    return f"{type(raised).__name__}: {raised}"


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Array]:
    """The items of a task, ``size`` at a time, whatever the sizes they arrive in."""
    waiting = pa.array([], pa.string())
    for record_batch in batches:
        waiting = pa.concat_arrays([waiting, record_batch.column(0).cast(pa.string())])
        full = len(waiting) - len(waiting) % size
        for start in range(0, full, size):
            yield waiting.slice(start, size)
        waiting = waiting.slice(full)
    if len(waiting):
        yield waiting


def running_tasks(items: DataFrame, tasks: int | None = None) -> int:
    """How many tasks of ``items`` run at a time: as many as it has, or as the cluster takes.

    Adaptive execution settles the number of ``tasks`` when a plan runs, so for plans that
    it steers the cluster's is taken, as it is when the load begins, unless the caller knows.
    """
    sc = items.sparkSession.sparkContext._jsc.sc()
    most = sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile())
    plan = items._jdf.queryExecution().executedPlan()
    if tasks is None:
        steered = plan.nodeName().startswith("AdaptiveSparkPlan")
        tasks = most if steered else plan.execute().getNumPartitions()
    return max(1, min(most, tasks))


def _task_rate(items: DataFrame, options: DeliveryOptions) -> DeliveryOptions:
    """``options`` with the rate of one task."""
    if options.rate is None:
        return options
    own = options.rate / running_tasks(items, options.tasks)
    if options.rate_per_partition is not None:
        own = min(own, options.rate_per_partition)
    return replace(options, rate_per_partition=own)


def deliver(items: DataFrame, entity: str, frame: Frame, factory: Callable[[], object],
            options: DeliveryOptions = DeliveryOptions()) -> DataFrame:
    """Lazy result rows, one per batch of consecutive rows of a task; no shuffle.

    Evaluating the frame sends the statements: use ``write_batches`` to send
    exactly once and look at the results as often as needed.
    """
    if options.batch <= 0:
        raise ValueError("batch must be positive")
    if options.rate is not None and options.rate <= 0:
        raise ValueError("the rate must be positive")
    options = _task_rate(items, options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        sender = _Sender(factory, frame, options)
        try:
            done, chars = [], 0
            for number, chunk in enumerate(_chunks(batches, options.batch)):
                sent, failed = sender.send(chunk)
                done.append({"entity": entity, "part": part, "batch": number,
                             "records": len(chunk), "failed": len(failed), "sent": sent,
                             "failed_stmts": failed, "error": sender.error if failed else None,
                             "fatal": bool(failed) and sender.fatal is not None})
                chars += sum(map(len, failed))
                if len(done) == RESULT_ROWS or chars >= RESULT_CHARS:
                    yield pa.RecordBatch.from_pylist(done, schema=_RESULT_ARROW)
                    done, chars = [], 0
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_RESULT_ARROW)
        finally:
            sender.close()

    return items.select("item").mapInArrow(run, RESULT)


def write_batches(items: DataFrame, entity: str, frame: Frame, factory: Callable[[], object],
                  options: DeliveryOptions = DeliveryOptions(), path: str | None = None
                  ) -> DataFrame:
    """Send everything once and return the stored result rows."""
    return write_once(deliver(items, entity, frame, factory, options), path, "results")


def check_budget(results: DataFrame, limit: int | None) -> None:
    """Raise when the failed batches of a load reach the limit."""
    if limit is None:
        return
    failed = results.filter("failed > 0").count()
    if failed >= limit:
        raise TooManyFailures(f"{failed} failed batches, the limit is {limit}")


def check_fatal(results: DataFrame) -> None:
    """Raise when an error called the load off. Save the failures first."""
    worst = results.filter("fatal").select("entity", "error").first()
    if worst is not None:
        raise FatalDeliveryError(f"{worst.entity}: {worst.error}")


def save_failures(results: DataFrame, path: str, run: str, mode: str = "append") -> None:
    """Dead letters as text lines under ``path/<run>/entity=<name>/``."""
    lines = results.select("entity", F.explode("failed_stmts").alias("value"))
    lines.write.mode(mode).partitionBy("entity").text(f"{path}/{run}", lineSep="\n")


def reload(spark: SparkSession, path: str, factory: Callable[[], object],
           options: DeliveryOptions = DeliveryOptions(), failures: str | None = None,
           run: str = "1") -> DataFrame:
    """Replay saved statements one by one; what fails again is saved as reload files."""
    items = read_statements(spark, path).withColumnRenamed("statement", "item")
    results = write_batches(items, "reload", Frame(), factory, replace(options, batch=1))
    if failures is not None:
        save_failures(results, failures, f"reload.{run}")
    check_fatal(results)
    return results


def failures_exist(spark: SparkSession, path: str) -> bool:
    files, folder = file_system(spark, path)
    return files.exists(folder)


def clear_failures(spark: SparkSession, path: str, keep_reload: bool = True) -> None:
    """Remove the runs saved under ``path``, except reload runs."""
    files, folder = file_system(spark, path)
    if not files.exists(folder):
        return
    for entry in files.listStatus(folder):
        if not (keep_reload and entry.getPath().getName().startswith("reload.")):
            files.delete(entry.getPath(), True)


def write_statements(df: DataFrame, path: str, column: str = "statement",
                     mode: str = "errorifexists") -> None:
    """Statements as text lines."""
    df.select(_col(column).alias("value")).write.mode(mode).text(path, lineSep="\n")
