import pytest
from pyspark.sql import functions as F

from graphload.functions import graph_part
from graphload.operators.rows import (
    Slots, assign_batches, both_directions, by_graph_part, by_measured_part, dedup_edges,
    dedup_vertices, repartition_to, slot_table, with_existence_rows,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup(spark):
    rows = spark.createDataFrame(
        [(1, 3, "c"), (1, 2, "b"), (1, 2, "a"), (2, 9, "z")], "id int, at int, v string")
    assert sorted(r.id for r in dedup_vertices(rows, "id").collect()) == [1, 2]
    kept = dedup_vertices(rows, "id", ["at"])
    assert kept.columns == rows.columns
    assert sorted(map(tuple, kept.collect())) == [(1, 2, "a"), (2, 9, "z")]
    edges = spark.createDataFrame([(1, 2, 0), (1, 2, 0), (1, 2, 1), (2, 1, 0)],
                                  "s int, d int, r int")
    assert dedup_edges(edges, "s", "d").count() == 2
    assert dedup_edges(edges, "s", "d", "r", ["r"]).count() == 3


def test_dedup_sends_one_row_per_task_and_hot_key(spark):
    rows = spark.range(0, 40000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    kept = dedup_vertices(rows, "k", ["id"])
    assert "partial_min" in plan_of(kept)
    # one row per key and map task is written, so a hot key costs four rows
    assert kept.count() == 26667
    assert kept.filter("k = 0").collect()[0].id == 0


def test_directions_scan_once(spark, data):
    edges = spark.createDataFrame([(1, 2, 5, "x")], "src int, dst int, edge_type int, v string")
    got = both_directions(edges)
    assert sorted(map(tuple, got.select("src", "dst", "edge_type", "v").collect())) == [
        (1, 2, 5, "x"), (2, 1, -5, "x")]
    lines = spark.read.parquet(f"{data}/lineitem.parquet").selectExpr(
        "l_orderkey AS src", "l_partkey AS dst", "1 AS edge_type")
    assert plan_of(both_directions(lines)).count("FileScan") == 1


def test_existence(spark):
    rows = spark.createDataFrame([(1, "a")], "vid int, name string")
    got = with_existence_rows(rows, value_cols=["name"])
    assert sorted(got.select("prefix", "vid", "name").collect()) == [(1, 1, "a"), (7, 1, None)]


def test_batches_match_a_window_per_group(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("part"))
    got = assign_batches(rows, 7, ["id"], ["part"]).collect()
    seen = {}
    for r in sorted(got):
        place = seen.setdefault(r.part, 0)
        assert (r.batch_id, r.batch_pos) == divmod(place, 7)
        seen[r.part] += 1
    with pytest.raises(ValueError):
        assign_batches(rows, 0, ["id"], ["part"])


def test_hot_part_is_split_into_buckets(spark):
    rows = spark.range(8000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 4)
                                    .otherwise(0).cast("int").alias("part"))
    got = assign_batches(rows, 100, ["id"], ["part"], buckets=8)
    sizes = got.groupBy("part", "bucket").count().collect()
    hot = [r["count"] for r in sizes if r.part == 0]
    assert len(hot) == 8 and max(hot) < 2 * sum(hot) / 8
    groups = got.groupBy("part", "bucket", "batch_id").agg(
        F.count("*").alias("n"), F.max("batch_pos").alias("last")).collect()
    assert all(g.n <= 100 and g.last == g.n - 1 for g in groups)
    assert got.count() == 8000


def test_routing_to_graph_partitions(spark):
    rows = spark.range(1000).select("id", graph_part("id", 7, "INT").alias("part"))
    placed = by_graph_part(rows, 7).withColumn("task", F.spark_partition_id())
    assert placed.filter("task <> part - 1").count() == 0
    split = by_graph_part(rows, 7, splits=3).withColumn("task", F.spark_partition_id())
    assert split.filter("floor(task / 3) <> part - 1").count() == 0
    assert split.select("task").distinct().count() == 21


def test_repartition_rules(spark, data):
    rows = spark.range(10)
    assert repartition_to(rows, 6).rdd.getNumPartitions() == 6
    assert repartition_to(rows, -1) is rows
    assert repartition_to(rows, 6, resumable=True) is rows
    stream = spark.readStream.schema("event_id bigint").parquet(data)
    assert repartition_to(stream, 6) is stream


def test_slots_split_hot_parts_only():
    table = slot_table({1: 1000, 2: 100, 3: 90, 4: 10}, 12)
    assert [(s.first, s.count) for s in table.values()] == [(0, 10), (10, 1), (11, 1), (12, 1)]
    assert slot_table({}, 4) == {} and slot_table({5: 1}, 100) == {5: Slots(0, 1)}
    with pytest.raises(ValueError):
        slot_table({1: 1}, 0)


def test_measured_routing_of_a_hot_part(spark):
    """A third of the rows on one part: no task has twice the mean, none two parts."""
    rows = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, 4).otherwise(
        graph_part("id", 10, "INT")).alias("part"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], rows.schema))
    placed = by_measured_part(rows, 16).withColumn("task", F.spark_partition_id())
    assert placed.columns == ["id", "part", "task"]
    tasks = placed.groupBy("task").agg(F.count("*").alias("n"), F.collect_set(
        F.coalesce("part", F.lit(-1))).alias("parts")).collect()
    assert all(len(t.parts) == 1 for t in tasks)
    assert max(t.n for t in tasks) < 2 * 30001 / len(tasks)
    hot = [t.n for t in tasks if t.parts == [4]]
    assert len(hot) >= 5 and sum(t.n for t in tasks) == 30001
    assert sorted(r.id for r in placed.collect()) == [-1, *range(30000)]
    assert by_measured_part(rows.limit(0), 4).isEmpty()


def test_measured_routing_with_a_split_of_its_own(spark):
    """Copies of one row need a split that is not its hash."""
    rows = spark.range(4000).select(F.lit(1).alias("part"), F.col("id").alias("n"))
    same = rows.withColumn("v", F.lit("x"))
    placed = by_measured_part(same, 8, split=F.col("n")).groupBy(F.spark_partition_id()).count()
    assert [r["count"] for r in placed.collect()] == [500] * 8
