"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

Equal vectors are first folded into one class with a count, so a group of copies is
one row from there on. Each table hashes a class to the nearest signed axes of
``AXES`` pseudo-random rotations (signs, Hadamard transform, three times) and
also probes the buckets of the second-best axes. A bucket compares its members in
double precision, counts the links that no earlier bucket has shown to both, and
keeps a spanning forest: neither pairs nor links are ever written out. Buckets
above ``BUCKET`` members are cut into blocks, and every pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import block_pairs, components, grouped_batches, local_components, settled, table
from .topk import usable

COSINE = 0.9
TABLES = 10
AXES = 2
PROBES = 3
BUCKET = 1024
SEED = 20240


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide), length kept."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(len(x), -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        x = x.reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def _rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and the transform."""
    signs = np.random.default_rng([SEED, seed, x.shape[1]]).integers(0, 2, (3, x.shape[1])) * 2 - 1
    for row in signs:
        x = _hadamard(x * row)
    return x


def bucket_codes(vectors: np.ndarray, tables: int = TABLES, axes: int = AXES,
                 probes: int = PROBES) -> np.ndarray:
    """Codes (n, tables, 1 + probes): the own bucket first, then those nearly as close.

    A code is the signed axis nearest to each rotation. A probe swaps one axis for
    the second or third nearest; the swaps that lose least come first.
    """
    width = 1 << max(1, int(vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), width))
    x[:, :vectors.shape[1]] = vectors
    codes = np.zeros((len(x), tables, 1 + probes), np.int64)
    rows = np.arange(len(x))
    for t in range(tables):
        near, loss = [], []
        for a in range(axes):
            turned = _rotated(x, t * axes + a)
            both = np.concatenate([turned, -turned], axis=1)
            order = np.argpartition(-both, 2, axis=1)[:, :3]
            order = np.take_along_axis(order, np.argsort(
                -np.take_along_axis(both, order, axis=1), axis=1, kind="stable"), axis=1)
            best = np.take_along_axis(both, order, axis=1)
            near.append(order)
            loss.append(best[:, :1] - best[:, 1:])
        base = [order[:, 0] for order in near]
        swaps = np.concatenate(loss, axis=1)
        chosen = np.argsort(swaps, axis=1, kind="stable")[:, :probes]
        for p in range(1 + probes):
            code = np.zeros(len(x), np.int64)
            for a in range(axes):
                axis = base[a]
                if p:
                    swap = chosen[:, p - 1]
                    hit = swap // 2 == a
                    axis = np.where(hit, near[a][rows, 1 + swap % 2], axis)
                code = code * (2 * width) + axis
            codes[:, t, p] = code
    return codes


def _matrix(lists: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of ``dims`` doubles or more; shorter vectors end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    dims = int(sizes.max(initial=dims))
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(
        zero_copy_only=False).astype(np.float64)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hash_rows(tables: int, axes: int, probes: int, dims: int):
    """``dims``: the longest vector of the table, as rotations depend on the width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("embedding"), dims))
            codes = bucket_codes(unit, tables, axes, probes)
            flat = codes.reshape(len(codes), -1)
            width = flat.shape[1]
            offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * width)
            vector = pa.ListArray.from_arrays(
                pa.array(np.arange(len(unit) + 1, dtype=np.int32) * unit.shape[1]),
                pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), vector,
                 pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))],
                names=["rep", "copies", "unit", "codes"])
    return run


class _Members:
    """The rows of one bucket or block pair."""

    def __init__(self, batch: pa.RecordBatch, tables: int):
        self.rep = batch.column("rep").to_numpy()
        self.copies = batch.column("copies").to_numpy()
        self.left = batch.column("in_left").to_numpy(zero_copy_only=False)
        self.right = batch.column("in_right").to_numpy(zero_copy_only=False)
        self.unit = _matrix(batch.column("unit"))
        codes = batch.column("codes").flatten().to_numpy()
        self.codes = codes.reshape(len(self.rep), tables, -1)

    def first_meeting(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(table, code) of the first bucket that both visit, one of them as its own."""
        x, y = self.codes[a], self.codes[b]
        # own bucket of a visited by b, then the other way round, table by table
        in_b = (x[:, :, :1] == y).any(axis=2)
        in_a = (y[:, :, :1] == x).any(axis=2)
        table_ = (in_a | in_b).argmax(axis=1)
        rows = np.arange(len(a))
        code = np.where(in_b[rows, table_], x[rows, table_, 0], y[rows, table_, 0])
        return table_, code


def _links(threshold: float, tables: int):
    """Links of each (table, code, left block, right block) that arrives sorted."""
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(batch: pa.RecordBatch, table_: int, code: int) -> pa.RecordBatch | None:
        m = _Members(batch, tables)
        left, right = np.flatnonzero(m.left), np.flatnonzero(m.right)
        own = m.codes[:, table_, 0] == code
        pairs_a, pairs_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(left), 512):
            part = left[start:start + 512]
            close = m.unit[part] @ m.unit[right].T >= threshold
            # each unordered pair once; probing rows meet only rows at home here
            close &= m.rep[part][:, None] != m.rep[right]
            close &= (own[part][:, None] | own[right])
            same = m.left[right] & m.right[part][:, None]
            close &= ~same | (m.rep[part][:, None] < m.rep[right])
            i, j = np.nonzero(close)
            i, j = part[i], right[j]
            low, high = np.where(m.rep[i] < m.rep[j], i, j), np.where(m.rep[i] < m.rep[j], j, i)
            t, c = m.first_meeting(low, high)
            here = (t == table_) & (c == code)
            pairs_a.append(low[here]), pairs_b.append(high[here])
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        if not len(a):
            return None
        links = np.bincount(a, m.copies[b], len(m.rep)) + np.bincount(b, m.copies[a], len(m.rep))
        order = np.argsort(m.rep, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = m.rep[order][local_components(len(order), place[a], place[b])[place]]
        hit = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(m.rep[hit]), pa.array(links[hit].astype(np.int64)), pa.array(root[hit])],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped_batches(batches, ("table", "code", "left", "right")):
            found = compare(rows, key[0], key[1])
            if found is not None:
                yield found
    return run


def near_vectors(vectors: DataFrame, threshold: float = COSINE, tables: int = TABLES,
                 axes: int = AXES, probes: int = PROBES, bucket: int = BUCKET) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding).

    Null, zero, non-finite and empty vectors, and those holding null, link with
    nothing and form a component each. Equal vectors always link. A shorter vector
    ends in zeros. Rows that repeat a vec_id and vector are one vector and come back
    once each; a null vec_id links with nothing. An empty table gives no rows.
    Recall against brute force depends on ``tables`` and ``probes``; precision is exact.
    """
    rows = vectors.select("vec_id", "embedding")
    fine = (usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
            & F.col("vec_id").isNotNull())
    # NULL stands for a vector that takes no part
    shape = F.when(F.coalesce(fine, F.lit(False)), F.col("embedding"))
    marked = rows.select("vec_id", shape.alias("embedding"))
    classes = (marked.filter("embedding is not null").groupBy("embedding")
               .agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies")))
    dims = marked.agg(F.max(F.size("embedding"))).first()[0] or 0
    hashed = settled(classes.select("rep", "copies", "embedding").mapInArrow(
        _hash_rows(tables, axes, probes, dims),
        "rep long, copies long, unit array<double>, codes array<long>"))
    visit = F.posexplode("codes").alias("place", "code")
    # a probed bucket that no row has as its own can show no link
    visits = hashed.select("rep", visit).select(
        "rep", "code", F.floor(F.col("place") / (1 + probes)).cast("int").alias("table"),
        (F.col("place") % (1 + probes) == 0).alias("own"))
    sizes = settled(visits.groupBy("table", "code").agg(
        F.count(F.lit(1)).alias("n"), F.max("own").alias("home")).filter("n > 1 and home")
        .select("table", "code", "n"))
    dealt = block_pairs(visits.select("rep", "table", "code").join(sizes, ["table", "code"]),
                        ["table", "code"], "rep", "n", bucket)
    keys = ["table", "code", "left", "right"]
    found = settled(
        dealt.join(hashed, "rep").repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_links(threshold, tables), "rep long, links long, root long"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    summary = (classes.join(counted, "rep", "left")
               .join(roots.withColumnRenamed("id", "rep"), "rep", "left")
               .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                       .alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = marked.join(summary, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
