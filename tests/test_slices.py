import os

import pytest
from pyspark.sql import functions as F

from graphload.operators.slices import (
    Slice, load_checkpoint, offset_splits, read_slices, rows_of_step, save_checkpoint,
    source_count, step_of, with_row_index,
)


def test_slice_plan():
    assert offset_splits(10, 3) == [Slice(0, 0, 4), Slice(1, 4, 3), Slice(2, 7, 3)]
    assert offset_splits(10, 3, [2, 5, 9]) == [Slice(0, 2, 2), Slice(1, 5, 2), Slice(2, 9, 1)]
    assert [s.size for s in offset_splits(10, 3, [4, 7, 10])] == [0, 0, 0]
    assert [s.size for s in offset_splits(2, 4)] == [1, 1, 0, 0]
    for total, parallel, reached in [(0, 3, None), (10, 0, None), (10, 3, [0, 3, 7]),
                                     (10, 3, [5, 7, 10]), (10, 3, [1])]:
        with pytest.raises(ValueError):
            offset_splits(total, parallel, reached)


@pytest.mark.parametrize("total, parallel", [(10, 3), (2, 5), (100, 7), (101, 1)])
def test_slices_cover_every_row_once(spark, total, parallel):
    rows = spark.range(total).select((F.col("id") * 37 % 1009).alias("k"), "id").repartition(3)
    got = read_slices(rows, ["k", "id"], offset_splits(total, parallel)).collect()
    expected = sorted((i * 37 % 1009, i) for i in range(total))
    assert [(r.k, r.id) for r in sorted(got, key=lambda r: r.row_index)] == expected
    assert [r.row_index for r in sorted(got, key=lambda r: r.row_index)] == list(range(total))
    for s in offset_splits(total, parallel):
        assert sorted(r.row_index for r in got if r.split == s.split) == list(
            range(s.start, s.start + s.size))


def test_equal_order_keys_spread_over_tasks(spark):
    rows = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 == 0, 5).otherwise(
        F.col("id")).alias("k"), F.lit("same").alias("v"))
    indexed = with_row_index(rows, ["k"], partitions=6)
    got = [r.row_index for r in indexed.collect()]
    assert sorted(got) == list(range(9000))
    plan = rows.withColumn("__read", F.monotonically_increasing_id()).repartitionByRange(
        6, "k", "v", "__read")
    sizes = plan.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 9000 / 3


def test_resume(spark, tmp_path):
    rows = spark.range(50)
    total = source_count(rows).first().n
    path = str(tmp_path)
    assert load_checkpoint(spark, path, "people") is None
    save_checkpoint(spark, path, "people", [10, 25, 40])
    save_checkpoint(spark, path, "people", [12, 25, 41])
    reached = load_checkpoint(spark, path, "people")
    assert reached == [12, 25, 41]
    left = read_slices(rows, ["id"], offset_splits(total, 3, reached)).collect()
    assert sorted(r.id for r in left) == [*range(12, 17), *range(25, 34), *range(41, 50)]
    done = read_slices(rows, ["id"], offset_splits(total, 3, [17, 34, 50]))
    assert done.count() == 0
    assert done.columns == read_slices(rows, ["id"], offset_splits(total, 3)).columns == [
        "split", "id", "row_index"]


def test_a_state_that_was_not_written_to_its_end_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    save_checkpoint(spark, path, "people", [1, 2])
    os.mkdir(f"{path}/people/state=99999999999999999999")
    assert load_checkpoint(spark, path, "people") == [1, 2]
    save_checkpoint(spark, path, "people", [3, 4])
    assert load_checkpoint(spark, path, "people") == [3, 4]


def test_steps_cover_every_row_once(spark):
    slices = offset_splits(50, 3, [12, 25, 41])
    steps = step_of(slices, 4)
    rows = read_slices(spark.range(50), ["id"], slices)
    found = [sorted(r.id for r in rows_of_step(rows, s).collect()) for s in steps]
    assert sorted(i for f in found for i in f) == [*range(12, 17), *range(25, 34), *range(41, 50)]
    assert [s.start + s.size for s in steps[-1]] == [17, 34, 50]


def test_rows_out_of_a_shuffle(spark):
    rows = spark.range(100).groupBy((F.col("id") % 30).alias("k")).count()
    got = read_slices(rows, ["k"], offset_splits(30, 4), scan=False).collect()
    assert sorted((r.row_index, r.k) for r in got) == [(i, i) for i in range(30)]
