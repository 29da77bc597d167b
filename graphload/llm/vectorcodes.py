"""Vector code compression: product codes by equal-average nearest neighbour search.

A vector of whole numbers is cut into equal parts; each part position has a codebook, and
a part's code is the index of the nearest entry. The search for it sorts the entries of a
codebook by the sum of their components and expands outward from the part's own sum: for
parts of d components the squared distance is at least (gap of the sums)^2 / d, so a
direction ends when that bound strictly exceeds the best distance (strictly, as an entry
at the bound may tie and have a smaller index).

Tasks hold the codebooks (entries x components, whatever the data) and hand on one sum
and count for each entry; the sums are added up in Spark and no row travels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table
from .topk import usable

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0

# Components beyond it have no place in the 38 digits that sums are kept in.
LARGEST = 1 << 80


def small(d: int) -> int:
    """Squared distances and gaps of ``d`` components up to it fit 64 bits."""
    return (1 << 30) // d


def whole_numbers(values: np.ndarray, d: int, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit numbers where all are small and Python's otherwise."""
    floors = np.floor(values.astype(np.float64) * scale)
    if (np.abs(floors) <= small(d)).all():
        return floors.astype(np.int64)
    if not (np.abs(floors) <= LARGEST).all():
        raise ValueError(f"a component times {scale:g} is beyond 2^80")
    return np.array([int(x) for x in floors.ravel()], object).reshape(floors.shape)


class Codebooks:
    """entries[part][index][component], sorted by component sum for the search."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        numbers = np.array(entries, object)
        fits = (np.abs(numbers) <= small(numbers.shape[2])).all()
        self.numbers = numbers.astype(np.int64) if fits else numbers
        sums = self.numbers.sum(axis=2)
        # a stable sort: equal sums in index order
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, axis=1)
        self.sorted = np.take_along_axis(self.numbers, self.order[..., None], axis=1)
        self.visited = 0

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each (row, part)."""
        n, m, d = parts.shape
        count = self.sorted.shape[1]
        if parts.dtype != self.sorted.dtype:
            parts = parts.astype(object)
        numbers = self.sorted if parts.dtype == self.sorted.dtype else self.sorted.astype(object)
        books = self.sums if parts.dtype == self.sums.dtype else self.sums.astype(object)
        own = parts.sum(axis=2)
        place = np.stack([np.searchsorted(books[p], own[:, p]) for p in range(m)], axis=1).ravel()
        flat, own = parts.reshape(-1, d), own.ravel()
        part = np.tile(np.arange(m), n)
        # the first entry on either side is always looked at
        best = np.full(len(flat), -1, flat.dtype)
        index = np.full(len(flat), count, np.int64)

        def look(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Try the entries ``at`` for ``rows``; returns the rows that may go on there."""
            of = part[rows]
            gap = books[of, at] - own[rows]
            open_ = (index[rows] == count) | (gap * gap <= best[rows] * d)
            rows, at, of = rows[open_], at[open_], of[open_]
            if not len(rows):
                return rows
            self.visited += len(rows)
            away = numbers[of, at] - flat[rows]
            far = (away * away).sum(axis=1)
            name = self.order[of, at]
            better = ((index[rows] == count) | (far < best[rows])
                      | ((far == best[rows]) & (name < index[rows])))
            best[rows[better]], index[rows[better]] = far[better], name[better]
            return rows

        up = down = np.arange(len(flat))
        for step in range(count):
            up = up[place[up] + step < count]
            down = down[place[down] - step > 0]
            if not len(up) and not len(down):
                break
            up = look(up, place[up] + step)
            down = look(down, place[down] - step - 1)
        return index.reshape(n, m), best.reshape(n, m)

    def digest(self) -> str:
        """SHA-256 of all components in decimal by part, entry and place."""
        text = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def cut(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """(rows, parts, components) of the vectors; shorter ones end in zeros."""
    lists = column.cast(pa.large_list(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    whole = np.zeros((len(lists), width))
    whole[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(whole, width // parts).reshape(len(lists), parts, width // parts)


# Rows that a task works on at once.
ROWS_AT_ONCE = 4096


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def entry_sums(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """(part, entry, n, sums) of the parts nearest to each entry, added up over all tasks."""
    parts, d = len(books.entries), width // len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], int] = {}
        sums: dict[tuple[int, int], list[int]] = {}
        for piece in _pieces(batches):
            numbers = cut(piece.column(0), width, parts)
            index, _ = books.nearest(numbers)
            for p in range(parts):
                order = np.argsort(index[:, p], kind="stable")
                names, starts = np.unique(index[order, p], return_index=True)
                added = np.add.reduceat(numbers[order, p], starts, axis=0)
                sizes = np.diff([*starts, len(order)])
                for name, size, total in zip(names.tolist(), sizes.tolist(), added.tolist()):
                    key = p, name
                    counts[key] = counts.get(key, 0) + size
                    sums[key] = [a + b for a, b in zip(sums.get(key, [0] * d), total)]
        rows = [{"part": p, "entry": e, "n": counts[p, e], "sums": [str(x) for x in sums[p, e]]}
                for p, e in counts]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()),
            ("sums", pa.list_(pa.string()))]))

    found = vectors.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals)


def trained(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
            rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the vectors (id, vector): they start as the parts of the smallest ids.

    The driver holds entries x width numbers and, in each round, a sum for each of them.
    """
    # rows alike in id are taken in the order of their components
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    whole = [np.pad(np.array(r.vector, np.float64), (0, width - len(r.vector))) for r in first]
    start = [whole_numbers(v, width // parts).reshape(parts, -1).tolist() for v in whole]
    books = [[vector[p] for vector in start] for p in range(parts)]
    for _ in range(rounds):
        # parts x entries rows
        for row in entry_sums(vectors, Codebooks(books), width).collect():
            books[row.part][row.entry] = [int(row[f"s{i}"]) // row.n
                                          for i in range(width // parts)]
    return Codebooks(books)


def compressed(rows: DataFrame, id: str, vector: str, label: str, parts: int = PARTS,
               entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every usable vector.

    Vectors that are null or hold null or non-finite components take no part; an empty
    vector is all zeros. Shorter vectors, and those whose length the parts do not divide,
    end in zeros up to the common width, the next multiple of the longest length. Repeated
    rows count as often as they occur; among equal ids the smaller components come first.
    Numbers are exact at any size: an error that does not fit 64 bits is null, and so is the
    sum over its label; a component beyond 2^80 stops the job. Null labels are one label, a
    null id comes after all others. No usable row gives no rows. ``entries`` is 256 at most.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    vectors = rows.select(F.col(id).alias("id"), F.col(vector).alias("vector"),
                          F.col(label).alias("label")).filter(usable(F.col(vector)))
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return vectors.sparkSession.createDataFrame(
            [], f"id {kinds['id']}, label {kinds['label']}, code string, error long, "
                "label_error long, codebooks_sha256 string")
    width = max(1, -(-longest // parts)) * parts
    books = trained(vectors, width, parts, entries, rounds)
    digest = books.digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            index, far = books.nearest(cut(piece.column(1), width, parts))
            codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
            errors = [sum(row) for row in far.tolist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array(codes, pa.string()),
                 pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())],
                ["id", "label", "code", "error"])

    coded = settled(vectors.mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, code string, error long"))
    totals = coded.groupBy(F.col("label").alias("__label")).agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__label"))).select(
        "id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, and what they lose."""
    found = compressed(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                        "codebooks_sha256")


def _sql_assign(n: int) -> str:
    return f"""
a{n} AS (
  SELECT vec_id, p, any_value(q) AS q, arg_min(i, (far, i)) AS i, min(far) AS far
  FROM (SELECT v.vec_id, v.p, v.q, b.i, list_sum(list_transform(list_zip(v.q, b.q),
                 lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS far
        FROM parts v JOIN b{n} b ON v.p = b.p)
  GROUP BY vec_id, p)"""


def _sql_update(n: int) -> str:
    return f"""
means{n} AS (
  SELECT p, i, list(mean ORDER BY c) AS q FROM (
    SELECT p, i, c, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean
    FROM (SELECT p, i, unnest(q) AS x, generate_subscripts(q, 1) AS c FROM a{n})
    GROUP BY p, i, c)
  GROUP BY p, i),
b{n + 1} AS (
  SELECT b.p, b.i, coalesce(m.q, b.q) AS q FROM b{n} b LEFT JOIN means{n} m USING (p, i))"""


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q,
         row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL
                                                  AND isfinite(x))) = len(embedding)),
parts AS (
  SELECT vec_id, place, p, q[p * len(q) // 16 + 1:(p + 1) * len(q) // 16] AS q
  FROM kept, range(16) AS t(p)),
b0 AS (SELECT p, place AS i, q FROM parts WHERE place < 64),
{_sql_assign(0)},{_sql_update(0)},
{_sql_assign(1)},{_sql_update(1)},
{_sql_assign(2)},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(hex(i)), 2, '0'), '' ORDER BY p) AS code,
         sum(far)::BIGINT AS error
  FROM a2 GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(list_aggregate(q, 'string_agg', ','), ',' ORDER BY p, i)) AS digest
  FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       digest AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""
