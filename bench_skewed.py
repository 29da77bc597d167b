"""Time the loader's steps on a skewed set of many files; prints one JSON line.

The set is BENCH_COPIES copies of the lines in BENCH_SF_DIR, a third of them moved to one
order, written as 32 files below BENCH_WORK. Every step runs BENCH_RUNS times.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from graphload.operators.delivery import DeliveryOptions, write_batches
from graphload.operators.kv import edge_kv, write_kv
from graphload.operators.rows import dedup_edges
from graphload.operators.slices import offset_splits, read_slices
from graphload.operators.statements import render, render_items, statement_frame
from graphload.spec import EdgeSpec
from loadqueries.base import INT_GRAPH
from loadqueries.loads import Accepter
from loadqueries.statements import _LINE


def skewed_lines(spark, sf_dir: str, copies: int, path: str) -> None:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    order = F.when(F.xxhash64("l_orderkey", "l_linenumber", "copy") % 3 == 0, F.lit(1)).otherwise(
        F.col("l_orderkey") * copies + F.col("copy"))
    (lines.withColumn("copy", copy).withColumn("l_orderkey", order).drop("copy")
     .repartition(32).write.parquet(path))


def steps(spark, lines, work: str) -> dict:
    spec = EdgeSpec(**_LINE)

    def drained(df):
        df.write.format("noop").mode("overwrite").save()

    def kv():
        path = f"{work}/kv-{uuid.uuid4().hex}"
        write_kv(edge_kv(lines, spec, INT_GRAPH), path)

    total = lines.count()
    return {
        "fragments": lambda: drained(render_items(lines, spec, INT_GRAPH)),
        "delivered": lambda: write_batches(
            render_items(lines, spec, INT_GRAPH), "contains", statement_frame(spec), Accepter,
            DeliveryOptions(batch=2000)),
        "statements": lambda: drained(render(lines, spec, INT_GRAPH, batch=500)),
        "key_value_files": kv,
        "slices": lambda: drained(read_slices(
            lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"), ["l_orderkey"],
            offset_splits(total, 20))),
        "dedup": lambda: drained(dedup_edges(lines.select("l_orderkey", "l_partkey"), "l_orderkey",
                                             "l_partkey")),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    work = os.environ["BENCH_WORK"]
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("graphload-bench-skewed")
             .config("spark.sql.shuffle.partitions", "32").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", f"{work}/shared")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{work}/lines"
    skewed_lines(spark, sf_dir, int(os.environ.get("BENCH_COPIES", "20")), path)
    lines = spark.read.parquet(path)
    total, found = lines.count(), {}
    for name, step in steps(spark, lines, work).items():
        seconds = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            started = time.perf_counter()
            step()
            seconds.append(round(time.perf_counter() - started, 2))
        found[name] = {"seconds": seconds, "rows_per_second": round(total / statistics.median(seconds))}
    print(json.dumps({"metric": "skewed_lines", "rows": total, "steps": found}))
    spark.stop()


if __name__ == "__main__":
    main()
