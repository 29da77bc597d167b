"""Counting a source, cutting it into ordered slices, resuming."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import _col
from ..storage import cut_lineage, file_system, scratch_path, write_once
from .rows import can_sort


def source_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Slice:
    split: int
    start: int
    size: int


def offset_splits(total: int, parallel: int, checkpoint: list[int] | None = None) -> list[Slice]:
    """Cut rows 0..total-1 into ``parallel`` slices, the first ones a row longer.

    ``checkpoint`` holds the row each slice has reached; slices shrink by what
    is done. A checkpoint outside its own slice belongs to another plan.
    """
    if total <= 0:
        raise ValueError("the source has no rows")
    if parallel <= 0:
        raise ValueError("the number of slices must be positive")
    base, longer = divmod(total, parallel)
    starts = [i * base + min(i, longer) for i in range(parallel)]
    ends = starts[1:] + [total]
    reached = starts if checkpoint is None else sorted(checkpoint)
    if len(reached) != parallel:
        raise ValueError("the checkpoint has another number of slices")
    if any(r < s for r, s in zip(reached, starts)):
        raise ValueError("the checkpoint is older than this plan; delete it")
    if any(r > e for r, e in zip(reached, ends)):
        raise ValueError("the checkpoint is broken; delete it")
    return [Slice(i, r, e - r) for i, (r, e) in enumerate(zip(reached, ends))]


def with_row_index(df: DataFrame, order_by: list[str], partitions: int | None = None,
                   scan: bool = True, path: str | None = None) -> DataFrame:
    """Exact 0-based position in ``order_by`` order, as ``row_index``.

    Rows are range-partitioned and sorted, written once to ``path`` (a scratch folder
    by default) so that the layout cannot change under a lost executor, and numbered
    by task offset plus position in the task. A hash of the other columns and the read
    position break ties, so equal order keys do not gather in one task and the bounds
    of the ranges stay small. The read position of a row must be the same if its
    task runs again: true of a scan; say ``scan=False`` of rows that come out of a
    shuffle, and they are written first.
    """
    if not scan:
        df = cut_lineage(df)
    others = [c for c in df.columns if c not in order_by and can_sort(df.schema, c)]
    order = [_col(c) for c in [*order_by, "__rest", "__read"]]
    rest = F.xxhash64(*map(_col, others)) if others else F.lit(0).cast("bigint")
    salted = df.withColumn("__rest", rest).withColumn("__read", F.monotonically_increasing_id())
    ranged = (salted.repartitionByRange(partitions, *order) if partitions
              else salted.repartitionByRange(*order))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = write_once(ranged.sortWithinPartitions(*order).drop("__rest", "__read")
                        .withColumn("__task", F.spark_partition_id())
                        .withColumn("__pos", in_task),
                        path or scratch_path(df.sparkSession, "indexed"))
    # one row per task, so this single-task window is as small as the task list
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__task").agg(F.count(F.lit(1)).alias("__n")).select(
        "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    return (placed.join(F.broadcast(offsets), "__task")
            .withColumn("row_index", F.col("__first") + F.col("__pos"))
            .drop("__task", "__first", "__pos"))


def slice_of(index: Column, total: int, parallel: int) -> tuple[Column, Column, Column]:
    """(number of the slice a row position is in, 0-based place there, rows of that slice)."""
    base, longer = divmod(total, parallel)
    head = longer * (base + 1)
    in_longer = F.call_function("div", index, F.lit(base + 1))
    in_rest = F.call_function("div", index - head, F.lit(max(base, 1))) + longer
    split = F.when(index < head, in_longer).otherwise(in_rest).cast("int")
    start = split.cast("bigint") * base + F.least(split, F.lit(longer))
    return split, index - start, F.when(index < head, base + 1).otherwise(base)


def read_slices(df: DataFrame, order_by: list[str], slices: list[Slice], scan: bool = True,
                path: str | None = None) -> DataFrame:
    """Rows of every slice: ``split``, the columns of ``df``, ``row_index``.

    Slices follow each other, so a slice number is arithmetic on the row
    position; the plan table has one row per slice.
    """
    if all(s.size == 0 for s in slices):
        return df.select(F.lit(0).alias("split"), "*",
                         F.lit(0).cast("bigint").alias("row_index")).limit(0)
    total, parallel = slices[-1].start + slices[-1].size, len(slices)
    index = F.col("row_index")
    split, _, _ = slice_of(index, total, parallel)
    plan = df.sparkSession.createDataFrame(
        [(s.split, s.start) for s in slices], "split int, __start bigint")
    return (with_row_index(df, order_by, scan=scan, path=path).withColumn("split", split)
            .join(F.broadcast(plan), "split").filter(index >= F.col("__start"))
            .select("split", *map(_col, df.columns), "row_index"))


def step_of(slices: list[Slice], steps: int) -> list[list[Slice]]:
    """The slices cut into ``steps`` parts each: the rows of one step of a resumable read."""
    def part(s: Slice, k: int) -> Slice:
        first, last = s.size * k // steps, s.size * (k + 1) // steps
        return Slice(s.split, s.start + first, last - first)
    return [[part(s, k) for s in slices] for k in range(steps)]


def rows_of_step(indexed: DataFrame, step: list[Slice]) -> DataFrame:
    """Rows of ``read_slices`` that lie in the ranges of a step; one condition per slice."""
    index, wanted = F.col("row_index"), F.lit(False)
    for s in step:
        if s.size:
            wanted = wanted | ((index >= s.start) & (index < s.start + s.size))
    return indexed.filter(wanted)


_STATE = "split int, reached bigint, plan int"


def save_checkpoint(spark: SparkSession, path: str, name: str, reached: list[int],
                    plan: int | None = None) -> None:
    """Store how far each slice got, of the plan with a number if there is one.

    The older state goes after the new one is written.
    """
    rows = [(i, r, plan) for i, r in enumerate(reached)]
    older = _states(spark, path, name)
    at = max([time.time_ns(), *(n + 1 for n, _ in older)])
    spark.createDataFrame(rows, _STATE).coalesce(1).write.json(
        f"{path}/{name}/state={at}")
    files, _ = file_system(spark, path)
    for _, folder in older:
        files.delete(folder, True)


def _states(spark: SparkSession, path: str, name: str) -> list[tuple[int, object]]:
    """(time, folder) of the states that were written to their end, oldest first."""
    files, folder = file_system(spark, f"{path}/{name}")
    if not files.exists(folder):
        return []
    found = [entry.getPath() for entry in files.listStatus(folder)]
    whole = [p for p in found if p.getName().startswith("state=")
             and files.exists(file_system(spark, f"{p.toString()}/_SUCCESS")[1])]
    return sorted(((int(p.getName()[6:]), p) for p in whole), key=lambda s: s[0])


def load_progress(spark: SparkSession, path: str, name: str
                  ) -> tuple[int | None, list[int]] | None:
    """(number of the plan, stored positions in slice order), or None if nothing was stored."""
    states = _states(spark, path, name)
    if not states:
        return None
    # one row per slice
    stored = spark.read.schema(_STATE).json(states[-1][1].toString()).orderBy("split").collect()
    return stored[0].plan, [row.reached for row in stored]


def load_checkpoint(spark: SparkSession, path: str, name: str) -> list[int] | None:
    """Stored positions in slice order, or None if nothing was stored."""
    found = load_progress(spark, path, name)
    return None if found is None else found[1]
