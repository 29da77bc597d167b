"""What several operators share: columns of text, Arrow helpers, connected components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import write_once

# Fixed value: a word is a run of bytes other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def once_per_worker(name: str, make: Callable[[], object]) -> object:
    """``make()``, kept for later tasks of the same Python worker under ``name``.

    Functions travel to the tasks by value, so their own globals last one task only.
    """
    kept = sys.modules.setdefault("_graphload_worker", types.ModuleType("_graphload_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It survives lost executors like a checkpoint. Its plan forgets the constraints of the
    plan before it, which would double in every round of a loop, and Spark knows its
    size, so it broadcasts it where it is small, and only there.
    """
    return write_once(df, name="step")


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_unit(salt: str, *columns: Column) -> Column:
    """A double in [0, 1) that only the values decide: 32 bits of an MD5 digest."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws("\x1f", F.lit(salt), *texts)), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 32))


def binary_rows(rows: np.ndarray) -> pa.Array:
    """A two-dimensional array as one binary value per row."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows)])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts one after the other, offsets). A null text is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def small_slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """The batch in slices whose texts have about ``most_bytes`` bytes, one row at least."""
    sizes = batch.column(column).fill_null("")
    ends = np.cumsum(pc.binary_length(sizes).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` points over the links ``a`` - ``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over the links, for every linked id.

    Each round points every id at its smallest neighbour, follows the pointers to
    their ends and shrinks the links to those ends, until no link is left. All of
    it is aggregates with a map-side step and joins on single ids, which adaptive
    execution splits where an id is hot.
    """
    edges = settled(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                        .filter("a < b").distinct())
    steps = []
    while not edges.isEmpty():
        down = edges.select(F.col("b").alias("id"), F.col("a").alias("to"))
        ends = edges.select(F.col("a").alias("id"), F.col("a").alias("to"))
        point = settled(down.unionByName(ends).groupBy("id").agg(F.min("to").alias("to")))
        while True:
            onward = point.select(F.col("id").alias("to"), F.col("to").alias("next"))
            jumped = settled(point.join(onward, "to").select(
                "id", F.col("next").alias("to"), (F.col("next") < F.col("to")).alias("moved")))
            point = jumped.select("id", "to")
            if jumped.filter("moved").isEmpty():
                break
        steps.append(point)
        left = point.select(F.col("id").alias("a"), F.col("to").alias("to_a"))
        right = point.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        edges = settled(edges.join(left, "a").join(right, "b").filter("to_a <> to_b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))

    def follow(found: DataFrame, step: DataFrame) -> DataFrame:
        onward = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        return found.join(onward, "to", "left").select(
            "id", F.coalesce("next", "to").alias("to"))

    return reduce(follow, steps[1:], steps[0]).withColumnRenamed("to", "component")


def block_pairs(rows: DataFrame, key: list[str], row: str, n: str, size: int) -> DataFrame:
    """Deal large groups out as pairs of blocks of about ``size`` rows.

    ``rows`` has the ``key`` of its group, the ``row`` that decides the block and the
    number ``n`` of rows in the group. Every two rows of a group meet in exactly one
    (key, left, right); ``in_left`` and ``in_right`` say on which side a row stands.
    """
    blocks = F.ceil(F.col(n) / size).cast("int")
    block = F.pmod(F.xxhash64(row), blocks).cast("int")
    sides = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(
        F.least(block, o).alias("left"), F.greatest(block, o).alias("right"),
        (block <= o).alias("in_left"), (block >= o).alias("in_right")))
    kept = [c for c in rows.columns if c != n]
    return rows.select(*kept, F.explode(sides).alias("__s")).select(*kept, "__s.*")


def grouped_batches(batches, names: tuple[str, ...]):
    """(key, rows) of each group of equal ``names`` in batches that arrive sorted by them."""
    key, held = None, []

    def whole():
        return held[0] if len(held) == 1 else (
            pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for start, stop in zip([0, *cuts], [*cuts, len(keys)]):
            now = tuple(keys[start].tolist())
            if now != key:
                if held:
                    yield key, whole()
                key, held = now, []
            held.append(batch.slice(start, stop - start))
    if held:
        yield key, whole()


def grouped_chunks(batches, names: tuple[str, ...]):
    """(rows, first row of each group and the end): whole groups of equal ``names``, many at a
    time, from batches that arrive sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if held[1:] else batch
        starts = _group_starts(rows, names)
        if len(starts) > 1:
            yield rows.slice(0, starts[-1]), starts
            rows = rows.slice(starts[-1])
        held = [rows]
    if held:
        yield held[0], np.append(_group_starts(held[0], names), held[0].num_rows)


def _group_starts(rows: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    changed = np.ones(rows.num_rows, bool)
    keys = [rows.column(n).to_numpy(zero_copy_only=False) for n in names]
    changed[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(changed)

