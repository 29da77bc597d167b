"""Exact top-k search: columnar branch and bound over blocks of vectors.

Candidates lie in blocks in vertical layout (one run of values per dimension). A
task adds up inner products block of dimensions by block of dimensions and, after
each, keeps only the candidates whose partial score plus the most that the rest
can add (product of the lengths of both rests) still reaches the query's k-th best
score. Queries come in blocks too; every block of candidates meets every block of
queries through a join on a salt that every query block carries in all values and
every candidate block in one, so that neither side needs a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

K = 5
QUERY_BLOCK = 512
BLOCK = 16384
SALTS = 16
STEP = 8
SCALE = 256.0


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, infinite or undefined component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def quantised(vector: Column, scale: float = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


_BLOCK = "n int, ids binary, dims int, columns binary"
_BLOCK_NAMES = ("n", "ids", "dims", "columns")
_BLOCK_ARROW = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("dims", pa.int32()),
                          ("columns", pa.binary())])


def _pack(rows: int):
    """Blocks of up to ``rows`` vectors in vertical layout; short vectors end in zeros."""
    def pack(ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        dims = max((v.shape[1] for v in vectors), default=0)
        whole = np.concatenate([np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for v in vectors])
        keys = np.concatenate(ids)
        return pa.RecordBatch.from_pylist([{
            "n": len(keys), "ids": keys.tobytes(), "dims": dims,
            "columns": np.ascontiguousarray(whole.T).tobytes()}], schema=_BLOCK_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, held = [], [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            dims = int(sizes.max(initial=0))
            whole = np.zeros((len(keys), dims), np.int64)
            whole[np.arange(dims) < sizes[:, None]] = values
            start = 0
            while start < len(keys):
                stop = min(len(keys), start + rows - held)
                ids.append(keys[start:stop]), vectors.append(whole[start:stop])
                held += stop - start
                start = stop
                if held == rows:
                    yield pack(ids, vectors)
                    ids, vectors, held = [], [], 0
        if held:
            yield pack(ids, vectors)
    return run


def _lengths(columns: np.ndarray) -> np.ndarray:
    """Length of the rest of every vector from each block of dimensions on."""
    squares = columns.astype(np.float64) ** 2
    starts = range(0, len(columns) + STEP, STEP)
    return np.sqrt(np.stack([squares[s:].sum(axis=0) for s in starts]))


class Searcher:
    """Best k so far of each query of one block of queries."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int):
        self.ids, self.columns, self.k = ids, columns, k
        self.rests = _lengths(columns)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.scored = 0

    def add(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """Search a block of candidates, given as (ids, dims x n)."""
        dims = min(len(columns), len(self.columns))
        columns = columns[:dims]
        rests = _lengths(columns)
        # as floats: the smallest long has no positive one
        top = (max(float(np.abs(columns.astype(np.float64)).max(initial=0)), 1.0)
               * max(float(np.abs(self.columns.astype(np.float64)).max(initial=0)), 1.0))
        most = top * max(dims, 1)
        # sums of whole numbers below 2^53 are exact in doubles, and quicker; those that
        # may not fit 64 bits are added as Python's numbers
        kind = np.float64 if most < 2.0 ** 53 else np.int64 if most < 2.0 ** 62 else object
        columns = columns.astype(kind)
        for q, own in enumerate(self.ids):
            self._query(q, own, self.columns[:dims, q].astype(kind), ids, columns, rests)

    def _query(self, q, own, query, ids, columns, rests):
        known_scores, known_ids = self.best[q]
        partial = query[:STEP] @ columns[:STEP]
        alive = None
        floor = known_scores[-1] if len(known_scores) == self.k else None
        if floor is None and len(ids) > 4 * self.k:
            # whole scores of the best beginnings give the first floor
            begin = np.argpartition(-partial.astype(np.float64), 2 * self.k)[:2 * self.k + 1]
            begin = begin[ids[begin] != own]
            sums = np.sort(query @ columns[:, begin])[::-1]
            floor = sums[self.k - 1] if len(sums) >= self.k else None
        for s in range(1, len(rests)):
            if floor is not None:
                here = rests[s] if alive is None else rests[s][alive]
                most = (partial.astype(np.float64, copy=False)
                        + self.rests[min(s, len(self.rests) - 1)][q] * here)
                # room for rounding: a bound may be too high, never too low
                keep = most * (1 + 1e-9 * np.sign(most)) + 1e-6 >= floor
                if not keep.all():
                    alive = np.flatnonzero(keep) if alive is None else alive[keep]
                    partial = partial[keep]
            block = slice(s * STEP, (s + 1) * STEP)
            if s * STEP < len(columns) and len(partial):
                part = columns[block] if alive is None else columns[block][:, alive]
                partial = partial + query[block] @ part
        found = ids if alive is None else ids[alive]
        self.scored += len(found)
        other = found != own
        fresh = partial[other]
        if fresh.dtype == object:
            fresh = np.clip(fresh, 1 - (1 << 63), (1 << 63) - 1)
        scores = np.concatenate([known_scores, fresh.astype(np.int64)])
        found = np.concatenate([known_ids, found[other]])
        first = np.lexsort((found, -scores))[:self.k]
        self.best[q] = (scores[first], found[first])


_FOUND = "query_id long, vec_id long, score long"
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                          ("score", pa.int64())])


def _unpack(n, ids, dims, columns):
    return (np.frombuffer(ids.as_py(), np.int64),
            np.frombuffer(columns.as_py(), np.int64).reshape(dims.as_py(), n.as_py()))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers: dict[int, Searcher] = {}
        for batch in batches:
            for block, *row in zip(*batch.columns):
                if block.as_py() not in searchers:
                    searchers[block.as_py()] = Searcher(*_unpack(*row[:4]), k)
                searchers[block.as_py()].add(*_unpack(*row[4:]))
        for s in searchers.values():
            counts = [len(scores) for scores, _ in s.best]
            if sum(counts):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(s.ids, counts)),
                    pa.array(np.concatenate([ids for _, ids in s.best])),
                    pa.array(np.concatenate([scores for scores, _ in s.best]))],
                    schema=_FOUND_ARROW)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row.

    ``vectors`` has vec_id and embedding. Vectors that are null or hold null or
    non-finite components, and rows without an id, take no part. A shorter vector
    ends in zeros. Rows that repeat a vec_id are candidates each, but never for
    their own id, and ask once, with the vector that sorts last. Equal scores go to
    the smaller id; a query without other rows, like an empty table, gives no row.
    Scores are exact; one beyond 63 bits and a sign is cut to them, and so is a
    component; among such the smaller id comes first.
    """
    whole = (vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull())
             .filter(usable(F.col("embedding"))))
    ints = whole.select("vec_id", quantised(F.col("embedding"), scale).alias("v"))
    asked = ints.filter(is_query).groupBy("vec_id").agg(F.max("v").alias("v"))
    number = max(1, -(-whole.filter(is_query).count() // query_block))
    queries = (asked.repartition(number, "vec_id").mapInArrow(_pack(query_block), _BLOCK)
               .select(F.xxhash64("ids").alias("block"),
                       *[F.col(c).alias(f"q_{c}") for c in _BLOCK_NAMES],
                       F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int")
    candidates = ints.mapInArrow(_pack(BLOCK), _BLOCK).withColumn("salt", salt)
    pairs = queries.join(candidates, "salt").drop("salt")
    found = pairs.mapInArrow(_search(k), _FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", place).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, max(e) AS e FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
pairs AS (
  SELECT q.query_id, v.vec_id,
         list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q JOIN v ON q.query_id <> v.vec_id),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
