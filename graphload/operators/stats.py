"""Load counters, from result rows rather than accumulators (which count retries twice)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL = "(total)"


def load_stats(results: DataFrame, seconds: float | None = None) -> DataFrame:
    """Batches and records that succeeded and failed, per entity and in total.

    ``results`` has one row per batch: entity, records, failed. ``seconds``
    adds the throughput.
    """
    bad = F.col("failed") > 0
    counts = results.rollup("entity").agg(
        F.sum(F.when(bad, 0).otherwise(1)).alias("batch_success"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("batch_failure"),
        F.sum(F.col("records") - F.col("failed")).alias("record_success"),
        F.sum(F.col("failed")).alias("record_failure"),
        F.grouping("entity").alias("__total"))
    stats = counts.withColumn(
        "entity", F.when(F.col("__total") == 1, F.lit(TOTAL)).otherwise(F.col("entity"))
    ).drop("__total")
    if seconds is None:
        return stats
    return stats.withColumn("records_per_second", F.col("record_success") / F.lit(float(seconds)))
