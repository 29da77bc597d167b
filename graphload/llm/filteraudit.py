"""Filter interaction audit: contractions of contingency tensors.

Every document fails or passes each of n filters, so one row of counts for each of the
2^n outcomes says all there is to know about the filters in any order. Spark counts the
documents of each (part, outcome) with a map-side step, which leaves 2^n rows a part
whatever the data; a part's counts are a tensor with one axis of two (pass, fail) for
each filter, and every figure of every step of every order is that tensor contracted
with a selector on each axis: pass, fail or all.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table

MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
SYMBOLS = "#$%&*|"
BLANKS = r"[\x20\x09-\x0D]+"

# What is counted in each cell: documents, good ones, toxic ones.
MEASURES = ("n", "good", "toxic")
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_filters(text: Column) -> dict[str, Column]:
    """Whether a whole text fails each filter that looks at nothing else. Null: empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * CAPITALS_PERCENT,
        "D": reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in SYMBOLS]),
    }


def repeated(rows: DataFrame, id: str, keys: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: has a row with a smaller ``id`` the same ``keys``?

    Only the smallest id of keys with several ids goes into the join, whose hot keys
    adaptive execution splits. A null id is neither smaller nor larger than another,
    so such a row is no copy. ``rows`` are written once, as they are read twice.
    """
    rows = settled(rows)
    first = (rows.groupBy(*keys).agg(F.min(id).alias("__first"), F.max(id).alias("__last"))
             .filter("__first < __last").drop("__last"))
    found = rows.join(first, keys, "left")
    return found.withColumn(name, F.coalesce(F.col(id) > F.col("__first"), F.lit(False))).drop(
        "__first")


def outcome(fails: list[str]) -> Column:
    """The cell of a row: the first filter is the highest bit, set where it fails."""
    bits = [F.col(f).cast("int") * (1 << (len(fails) - 1 - i)) for i, f in enumerate(fails)]
    return reduce(Column.__add__, bits)


def selectors(letters: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The steps (order, place) and, for each figure, (steps, filters, 2) selectors.

    What a filter removes at a step: earlier ones pass, it fails, later ones are all.
    """
    n = len(letters)
    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = [(order, place) for order in orders for place in range(n)]

    def pick(choose) -> np.ndarray:
        return np.array([[choose(order.index(f), place) for f in letters]
                         for order, place in steps], np.int64)

    return steps, {
        "kept": pick(lambda at, place: PASS if at <= place else ALL),
        "removed": pick(lambda at, place: PASS if at < place else FAIL if at == place else ALL),
        "failing": pick(lambda at, place: FAIL if at == place else ALL),
        "unique_fails": pick(lambda at, place: FAIL if at == place else PASS),
    }


def contract(cells: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """(parts, steps, measures) of cells (parts, 2, ..., 2, measures) at selected outcomes."""
    n = picked.shape[1]
    axes = "abcdefgh"[:n]
    terms = ",".join([f"p{axes}m", *(f"s{a}" for a in axes)])
    return np.einsum(f"{terms}->psm", cells, *(picked[:, i] for i in range(n)), optimize="greedy")


def figures(cells: np.ndarray, letters: str, steps: list[tuple[str, int]],
            picked: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Every figure as (parts, steps); cells as for ``contract``."""
    found = {name: contract(cells, p) for name, p in picked.items()}
    removed = found["removed"]
    last = np.array([letters.index(order[place]) for order, place in steps])
    shapley = np.zeros((len(cells), len(letters)), np.int64)
    for i in range(len(letters)):
        shapley[:, i] = removed[:, last == i, 0].sum(axis=1)
    return {
        "kept": found["kept"][..., 0], "removed": removed[..., 0],
        "redundant": found["failing"][..., 0] - removed[..., 0],
        "unique_fails": found["unique_fails"][..., 0], "good_lost": removed[..., 1],
        "toxic_lost": removed[..., 2], "shapley": shapley[:, last],
    }


# Rows of cells that a task contracts at once.
PARTS_AT_ONCE = 16


def audit(rows: DataFrame, part: Column, fails: dict[str, Column], good: Column, toxic: Column
          ) -> DataFrame:
    """(part, filter_order, step, and the figures) for every order of the filters.

    ``fails`` has a letter and a boolean for each filter, 8 at most; ``good`` and ``toxic``
    mark the rows that a filter should keep or remove; nulls in any of them count as no.
    A null part is the empty string. A part has 2^n cells, so the tensor of a part is
    small whatever the data; parts without rows, and empty tables, give no rows.
    Five filters have 600 steps, six 4320; the steps, not the cells, set the limit.
    """
    letters = "".join(sorted(fails))
    width = 1 << len(letters)
    no = F.lit(False)
    marked = rows.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        *[F.coalesce(fails[f], no).alias(f) for f in letters],
        F.coalesce(good, no).alias("good"), F.coalesce(toxic, no).alias("toxic"))
    counts = marked.groupBy("part", outcome(list(letters)).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"))
    tensors = counts.groupBy("part").agg(
        F.collect_list(F.struct("cell", *MEASURES)).alias("cells"))
    steps, picked = selectors(letters)
    orders = [order for order, _ in steps]
    places = np.array([place + 1 for _, place in steps], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS_AT_ONCE):
                yield contracted(batch.slice(start, PARTS_AT_ONCE))

    def contracted(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        of = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten()
        found = {n: values.field(n).to_numpy(zero_copy_only=False) for n in ("cell", *MEASURES)}
        cells = np.zeros((batch.num_rows, width, len(MEASURES)), np.int64)
        for i, name in enumerate(MEASURES):
            cells[of, found["cell"], i] = found[name]
        shape = (batch.num_rows, *(2,) * len(letters), len(MEASURES))
        out = figures(cells.reshape(shape), letters, steps, picked)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(steps)))),
             pa.array(orders * batch.num_rows), pa.array(np.tile(places, batch.num_rows)),
             *(pa.array(out[f].ravel()) for f in FIGURES)],
            ["part", "filter_order", "step", *FIGURES])

    kinds = ", ".join(f"{f} long" for f in FIGURES)
    return tensors.mapInArrow(run, f"part string, filter_order string, step int, {kinds}")


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over documents, part by language.

    A document is good (toxic) when a row of ``labels`` with its doc_id says quality (toxic)
    1; without such rows it is neither. Repeated labels count once, repeated documents each
    for itself. Nulls: a text is empty, a language the empty string, a null doc_id has no
    label and is no copy. Texts are equal when 128 bits of hashes are. Other columns of both
    tables are not read.
    """
    text = F.coalesce("text", F.lit(""))
    marked = repeated(docs.select(
        "doc_id", "lang", F.xxhash64(text).alias("__a"), F.xxhash64(F.lit(1), text).alias("__b"),
        *[c.alias(f) for f, c in text_filters(F.col("text")).items()]),
        "doc_id", ["__a", "__b"], "E")
    said = labels.groupBy("doc_id").agg(
        F.bool_or(F.col("quality") == 1).alias("good"),
        F.bool_or(F.col("toxic") == 1).alias("toxic"))
    rows = marked.join(said.filter("good OR toxic"), "doc_id", "left")
    return audit(rows, F.col("lang"), {f: F.col(f) for f in "ABCDE"}, F.col("good"),
                 F.col("toxic"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders over whole documents."""
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
said AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good,
         coalesce(bool_or(toxic = 1), FALSE) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT w.part, coalesce(s.good, FALSE) AS good, coalesce(s.toxic, FALSE) AS toxic,
         (len(words) < 100)::INTEGER
         + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text))::INTEGER
         + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
         + 16 * coalesce(w.doc_id > first_id, FALSE)::INTEGER AS mask
  FROM words w LEFT JOIN said s ON w.doc_id = s.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good,
         count(*) FILTER (toxic) AS toxic
  FROM masks GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, s::INTEGER AS step, bits[s] AS bit,
         coalesce(list_sum(bits[1:s - 1]), 0)::INTEGER AS earlier
  FROM orders, range(1, 6) AS t(s)),
counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & earlier <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT
           AS good_lost,
         coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT
           AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""
