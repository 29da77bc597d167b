"""Loads that go on where they stopped, and notice that their source is another one.

A plan puts the rows of a source in the order of a key, cuts them into ranges and
writes down, before anything is sent, the last key of every range and what lies in it:
the number of rows, an order-free fingerprint, and a ledger with 128 bits of every row.
Runs mark the steps (one range of every slice) that are over. A later run compares the
source with the plan first:

* same rows: only the ranges that are still open are read, found by their keys, whatever
  files the rows lie in by now;
* other rows: it is refused, or (``on_change="new"``) what the ledger says was sent is
  taken off the source, copy for copy, and the rest gets a plan of its own.

A plan is a folder ``plan=<n>`` that counts once its last file is written; it never
changes. Progress lies beside it in the states of ``save_checkpoint``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import _col
from ..storage import file_system, scratch_path, write_once
from .slices import (
    Slice, load_progress, offset_splits, save_checkpoint, slice_of, step_of, with_row_index,
)

ON_CHANGE = ("refuse", "new")
DIGEST = ("__a", "__b")
# Copies of a row that were added later are made in groups of so many.
COPIES_AT_ONCE = 1000


class SourceChanged(RuntimeError):
    """The source is not the one that the checkpoint was made for."""


@dataclass(frozen=True)
class Fingerprint:
    """Number of rows, and sums and exclusive ors of their digests: no order decides it."""

    n: int = 0
    xor_a: int = 0
    xor_b: int = 0
    low: int = 0
    middle: int = 0
    high: int = 0

    def __add__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.n + other.n, self.xor_a ^ other.xor_a, self.xor_b ^ other.xor_b,
                           self.low + other.low, self.middle + other.middle,
                           self.high + other.high)


def with_digest(rows: DataFrame) -> DataFrame:
    """``rows`` with 128 bits over all their columns."""
    def part(name: str) -> Column:
        kind = rows.schema[name].dataType.typeName()
        # maps and variants cannot be hashed
        return F.to_json(_col(name)) if kind in ("map", "variant") else _col(name)

    columns = [part(c) for c in rows.columns]
    return rows.withColumns({"__a": F.xxhash64(*columns), "__b": F.xxhash64(F.lit(1), *columns)})


def _sums() -> list[Column]:
    """The fields of a fingerprint; 22 bits at a time, so that sums of 2^41 rows fit."""
    mask = F.lit((1 << 22) - 1)
    a = F.col("__a")
    return [F.count(F.lit(1)).alias("n"), F.bit_xor("__a").alias("xor_a"),
            F.bit_xor("__b").alias("xor_b"), F.sum(a.bitwiseAND(mask)).alias("low"),
            F.sum(F.shiftrightunsigned(a, 22).bitwiseAND(mask)).alias("middle"),
            F.sum(F.shiftrightunsigned(a, 44)).alias("high")]


_FIELDS = ("n", "xor_a", "xor_b", "low", "middle", "high")


def _of(row) -> Fingerprint:
    return Fingerprint(*(row[f] or 0 for f in _FIELDS))


def fingerprint(rows: DataFrame) -> Fingerprint:
    """Fingerprint of rows with their digest: one aggregate, one row for each task."""
    return _of(rows.agg(*_sums()).first())


@dataclass(frozen=True)
class Plan:
    """What a plan says of itself. ``source`` is the whole source when it was made; ``sent``
    has, for earlier plans of this load, the positions their slices had reached by then."""

    number: int
    order_by: list[str]
    columns: list[list[str]]
    rows: int
    parallel: int
    steps: int
    source: Fingerprint
    sent: list[list] = field(default_factory=list)

    def slices(self, reached: list[int] | None = None) -> list[Slice]:
        return offset_splits(self.rows, self.parallel, reached) if self.rows else []

    def ranges(self) -> list[tuple[int, Slice]]:
        """(step, range) in the order of the keys; the number of a range is its place here."""
        steps = step_of(self.slices(), self.steps)
        return [(k, steps[k][s]) for s in range(self.parallel) for k in range(self.steps)]

    def open_ranges(self, reached: list[int]) -> list[int]:
        return [i for i, (_, r) in enumerate(self.ranges()) if r.start + r.size > reached[r.split]]


@dataclass(frozen=True)
class Load:
    """What is left of a load: its rows with ``__step``, and the steps in their order."""

    plan: Plan
    rows: DataFrame | None
    steps: list[int]
    path: str | None = None


def _folder(path: str, name: str, number: int) -> str:
    return f"{path}/{name}/plan={number}"


def _plans(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of all plans, those included that were not written to their end."""
    files, folder = file_system(spark, f"{path}/{name}")
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return sorted(int(n[5:]) for n in names if n.startswith("plan="))


def load_plan(spark: SparkSession, path: str, name: str, number: int) -> Plan:
    said = spark.read.text(f"{_folder(path, name, number)}/about", wholetext=True).first()
    about = json.loads(said.value)
    return Plan(**{**about, "source": Fingerprint(**about["source"])})


def _range_table(spark: SparkSession, path: str, name: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{_folder(path, name, number)}/ranges")


def _ledger(spark: SparkSession, path: str, name: str, number: int) -> DataFrame:
    return spark.read.schema("__a bigint, __b bigint, __range int").parquet(
        f"{_folder(path, name, number)}/ledger")


def _key(order_by: list[str]) -> Column:
    return F.struct(*[_col(c).alias(f"k{i}") for i, c in enumerate([*order_by, *DIGEST])])


def _sent_rows(spark: SparkSession, path: str, name: str, plan: Plan, reached: list[int]
               ) -> DataFrame:
    """Digest of every row that the steps which are over have sent, copies included."""
    frames = []
    for number, places in [*plan.sent, [plan.number, reached]]:
        older = plan if number == plan.number else load_plan(spark, path, name, number)
        open_ = set(older.open_ranges(places)) if older.rows else set()
        over = [(i,) for i in range(len(older.ranges()) if older.rows else 0) if i not in open_]
        # one row for each range
        frames.append(_ledger(spark, path, name, number).join(
            F.broadcast(spark.createDataFrame(over, "__range int")), "__range", "left_semi"))
    return reduce(DataFrame.unionByName, frames).select(*DIGEST)


def without_sent(rows: DataFrame, sent: DataFrame) -> DataFrame:
    """``rows`` (with their digest) without the ``sent`` ones, copy for copy.

    Rows that no sent one equals pass by an anti-join. Of a row that was sent less often
    than it is there, the copies that are missing are made anew in two steps, so that not
    even a very frequent row becomes one large array.
    """
    spark = rows.sparkSession
    counted = write_once(sent.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("__sent")),
                         name="sent")
    fresh = rows.join(counted, [*DIGEST], "left_anti")
    more = write_once(
        rows.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("__there")).join(counted, [*DIGEST])
        .filter("__there > __sent").select(*DIGEST, (F.col("__there") - F.col("__sent")).alias(
            "__more")), name="more")
    if more.isEmpty():
        return fresh
    one = rows.join(more, [*DIGEST], "left_semi").dropDuplicates([*DIGEST]).join(more, [*DIGEST])
    groups = one.withColumn("__group", F.explode(F.sequence(
        F.lit(0), F.call_function("div", F.col("__more") - 1, F.lit(COPIES_AT_ONCE)))))
    size = F.least(F.lit(COPIES_AT_ONCE), F.col("__more") - F.col("__group") * COPIES_AT_ONCE)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = groups.repartition(parts, *DIGEST, "__group").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), size.cast("int"))))
    return fresh.unionByName(copies.select(*fresh.columns))


def _new_plan(spark: SparkSession, rows: DataFrame, order_by: list[str], parallel: int, steps: int,
              path: str, name: str, scan: bool, source: Fingerprint | None, sent: list[list],
              columns: list[list[str]]) -> Load:
    """Order the rows, cut them into ranges, and write the plan before anything is sent."""
    number = max(_plans(spark, path, name), default=-1) + 1
    copy = scratch_path(spark, "indexed")
    indexed = with_row_index(rows, [*order_by, *DIGEST], scan=scan, path=copy)
    total = indexed.count()
    plan = Plan(number, list(order_by), columns, total, parallel, steps, Fingerprint(), sent)
    ranges = plan.ranges() if total else []
    ends = spark.createDataFrame(
        [(i, r.start + r.size - 1) for i, (_, r) in enumerate(ranges) if r.size],
        "__range int, row_index bigint")
    # one row for each range
    last = write_once(indexed.join(F.broadcast(ends), "row_index").select(
        "__range", *DIGEST, _key(order_by).alias("last")), name="ends")
    index = F.col("row_index")
    split, inside, size = slice_of(index, total, parallel)
    step = F.call_function("div", (inside + 1) * steps - 1, F.greatest(size, F.lit(1)))
    # copies of the row that ends a range belong to that range, however many there are
    ending = last.groupBy(*DIGEST).agg(F.min("__range").alias("__ending"))
    placed = indexed.join(F.broadcast(ending), [*DIGEST], "left").withColumn(
        "__range", F.coalesce("__ending", (split * steps + step).cast("int"))).drop(
        "__ending", "row_index")
    found = {r["__range"]: _of(r) for r in placed.groupBy("__range").agg(*_sums()).collect()}
    folder = _folder(path, name, number)
    told = [(i, *(getattr(found.get(i, Fingerprint()), f) for f in _FIELDS))
            for i in range(len(ranges))]
    kinds = ", ".join(f"{f} bigint" for f in _FIELDS)
    (spark.createDataFrame(told, f"__range int, {kinds}").join(
        last.select("__range", "last"), "__range", "left").coalesce(1)
     .write.mode("overwrite").parquet(f"{folder}/ranges"))
    placed.select(*DIGEST, "__range").write.mode("overwrite").parquet(f"{folder}/ledger")
    planned = sum(found.values(), Fingerprint())
    about = {"number": number, "order_by": list(order_by), "columns": columns, "rows": total,
             "parallel": parallel, "steps": steps, "sent": sent,
             "source": vars(planned if source is None else source)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{folder}/about")
    plan = load_plan(spark, path, name, number)
    save_checkpoint(spark, path, name, [s.start for s in plan.slices()] or [0] * parallel, number)
    # the step of a range is the rest of its number
    rows = placed.withColumn("__step", F.col("__range") % steps).drop("__range", *DIGEST)
    return Load(plan, rows, sorted({k for k, r in ranges if r.size}), copy)


def _rest_of_plan(spark: SparkSession, rows: DataFrame, plan: Plan, open_: list[int], path: str,
                  name: str) -> Load:
    """The rows of the ranges that are open, found by their keys and stored once."""
    if not open_:
        return Load(plan, None, [])
    ranges = _range_table(spark, path, name, plan.number)
    # one row for each range, so this single-task window and the broadcast are that small
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bounds = ranges.select("__range", "last", F.last("last", ignorenulls=True).over(before).alias(
        "after")).filter(F.col("__range").isin(open_) & F.col("last").isNotNull())
    key = _key(plan.order_by)
    inside = (F.col("after").isNull() | (key > F.col("after"))) & (key <= F.col("last"))
    found = rows.join(F.broadcast(bounds), inside).drop("after", "last")
    copy = scratch_path(spark, "open")
    (found.withColumn("__step", F.col("__range") % plan.steps).write.partitionBy("__step")
     .parquet(copy))
    kept = spark.read.schema(StructType([*found.schema, StructField("__step", IntegerType())])
                             ).parquet(copy)
    now = {r["__range"]: _of(r) for r in kept.groupBy("__range").agg(*_sums()).collect()}
    planned = {r["__range"]: _of(r) for r in ranges.drop("last").collect()}
    if any(now.get(i, Fingerprint()) != planned[i] for i in open_):
        raise SourceChanged(f"{name}: the source changed while it was read; run it again")
    return Load(plan, kept.drop("__range", *DIGEST), sorted({i % plan.steps for i in now}), copy)


def plan_load(spark: SparkSession, rows: DataFrame, order_by: list[str], parallel: int, path: str,
              name: str, steps: int = 8, on_change: str = "refuse", scan: bool = True) -> Load:
    """What is left to load of ``rows``; nothing is marked as sent.

    The checkpoint ``path``/``name`` is made by the first run. A source with the same rows
    in other files is the same source; rows that went away after they were sent are not
    undone. A changed row is another row. ``order_by`` and the columns must stay the same.
    Ranges are ``parallel`` x ``steps``; this table is what is broadcast.
    """
    if on_change not in ON_CHANGE:
        raise ValueError(f"unknown on_change {on_change!r}; use one of {ON_CHANGE}")
    if parallel <= 0 or steps <= 0:
        raise ValueError("the numbers of slices and steps must be positive")
    columns = [[f.name, f.dataType.simpleString()] for f in rows.schema]
    keyed = with_digest(rows)
    known = load_progress(spark, path, name)
    if known is None:
        load = _new_plan(spark, keyed, order_by, parallel, steps, path, name, scan, None, [],
                         columns)
        if not load.plan.rows:
            raise ValueError("the source has no rows")
        return load
    number, reached = known
    if number is None:
        raise SourceChanged(f"{name}: the checkpoint does not say of which rows it is; delete it")
    plan = load_plan(spark, path, name, number)
    if (plan.order_by, plan.columns) != (list(order_by), columns):
        raise SourceChanged(f"{name}: the checkpoint has other columns or another order; delete it")
    now = fingerprint(keyed)
    if now == plan.source:
        return _rest_of_plan(spark, keyed, plan, plan.open_ranges(reached) if plan.rows else [],
                             path, name)
    if on_change == "refuse":
        raise SourceChanged(f"{name}: the source had {plan.source.n} rows, it has {now.n}, "
                            'or others; delete the checkpoint or set on_change to "new"')
    left = without_sent(keyed, _sent_rows(spark, path, name, plan, reached))
    return _new_plan(spark, left, order_by, parallel, steps, path, name, False, now,
                     [*plan.sent, [number, reached]], columns)


def mark_step(spark: SparkSession, load: Load, path: str, name: str, step: int) -> None:
    """Say that a step, and so all steps before it, is over."""
    done = step_of(load.plan.slices(), load.plan.steps)[step]
    save_checkpoint(spark, path, name, [s.start + s.size for s in done], load.plan.number)
