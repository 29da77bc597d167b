"""Mixing sources to target weights: whole copies plus one hash-seeded Bernoulli copy.

Native DataFrame functions only. Sizes are summed per source with a map-side step;
the sources table has one row per source and joins back on the source, which
Spark broadcasts only when it has seen that it is small (a hot source is split by
adaptive execution otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_unit, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, null last, take the weights in turn. ``share`` times all
    sizes is dealt by weight; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight until none is above. With sources in the
    order of (limit / weight), the first one that the even level of all later ones
    does not fill up sets the level for itself and all after it.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights)) + 1)
    sources = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
               .withColumn("place", place).withColumn("weight", weight)
               .withColumn("most", F.col("source_size") * F.lit(float(most))))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    left = (F.sum("source_size").over(everywhere) * F.lit(float(share))
            - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    level = F.greatest(left, F.lit(0.0)) / F.sum("weight").over(after)
    leveled = sources.withColumn("level", level)
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    final = F.min_by(open_, F.when(open_.isNotNull(),
                                   F.struct(F.col("most") / F.col("weight"), "place")))
    target = F.least(F.coalesce(final.over(everywhere), F.lit(float("inf"))) * F.col("weight"),
                     F.col("most"))
    return leveled.select("source", "source_size", target.alias("target"))


def copies(rate: Column, unit: Column) -> Column:
    """floor(rate), and one more if ``unit`` in [0, 1) is below the fraction that is left."""
    whole = F.floor(rate)
    return (whole + (unit < rate - whole).cast("long")).cast("int")


def with_copies(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """``docs`` with size, source_size, target and copies (names that clash are replaced).

    A null or empty text has size 0 and a source without words has target 0 and no
    copies. The doc_id decides the Bernoulli copy (the text, where it is null), so
    repeated rows are taken alike and reruns agree. An empty table gives no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"))
    # drawn before the join, so that a caller who leaves the text out does not shuffle it
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn(
        "__unit", hash_unit(seed, key))
    found = source_targets(sized.select("source", "size"), **targets).select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"))
    joined = sized.join(found, F.col("source").eqNullSafe(F.col("__source")))
    rate = F.when(F.col("__source_size") > 0,
                  F.col("__target") / F.col("__source_size")).otherwise(0.0)
    return (joined.withColumn("source_size", F.col("__source_size"))
            .withColumn("target", F.col("__target"))
            .withColumn("copies", copies(rate, F.col("__unit")))
            .drop("__source", "__source_size", "__target", "__unit"))


def mix(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with the columns of ``docs``."""
    taken = with_copies(docs.select("doc_id", "text", "source", F.struct("*").alias("__row")),
                        seed, **targets)
    repeated = taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(True), F.col("copies"))))
    return repeated.select("__row.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return with_copies(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][(place % 3 + 1)::INTEGER] AS weight, source_size * 2.0::DOUBLE AS most
  FROM sources),
leveled AS (
  SELECT *, greatest((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(most) OVER (
             ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
            / (sum(weight) OVER (ORDER BY most / weight, place
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighted),
final AS (
  SELECT min_by(level, (most / weight, place)) AS level FROM leveled WHERE level * weight <= most),
targets AS (
  SELECT l.source, l.source_size,
         least(coalesce(f.level, 'infinity'::DOUBLE) * l.weight, l.most) AS target
  FROM leveled l, final f),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix' || chr(31) || coalesce(d.doc_id::VARCHAR, d.text, '')), 1, 8)
         )::UBIGINT / 4294967296.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + (u < rate - floor(rate))::INTEGER))::BIGINT AS taken,
       (floor(rate) + (u < rate - floor(rate))::INTEGER)::INTEGER AS copies
FROM rated
"""
