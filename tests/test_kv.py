import json
import os

from pyspark.sql import functions as F

from graphload.operators import kv
from graphload.operators.kv import (
    edge_kv, edge_rows, kv_value, sort_kv, vertex_kv, with_value, write_kv,
)
from graphload.spec import EdgeSpec, GraphTarget, Label, VertexSpec
from loadqueries import keyvalue
from test_values import FOURTEEN, MARKER

NAMES = [f"col{i + 1}" for i in range(14)]
TYPES = dict(zip(NAMES, [f[0] for f in FOURTEEN]))
GRAPH = GraphTarget(10, "STRING", 10, {
    "person": Label.of("vertex", TYPES, 1), "friend": Label.of("edge", TYPES, 2)}, MARKER)


def fourteen(spark):
    schema = ", ".join(f"{n} {f[1]}" for n, f in zip(NAMES, FOURTEEN))
    return spark.createDataFrame([("1", "2", *[f[2] for f in FOURTEEN])],
                                 f"src string, dst string, {schema}")


def test_known_rows(spark):
    rows = fourteen(spark)
    vertex = with_value(vertex_kv(rows, VertexSpec("person", "src", tuple(NAMES)), GRAPH,
                                  existence=True)).orderBy("prefix").collect()
    assert [bytes(r.key).hex() for r in vertex] == [
        "010600003100000000000000000001000000", "0706000031000000000000000000"]
    assert bytes(vertex[1].value) == b""
    value = json.loads(bytes(vertex[0].value))
    assert value["col1"] == "" and value["col6"] == 100000 and value["col11"] is True
    assert value["col8"] == {"year": 2021, "month": 1, "day": 1, "hour": 12, "minute": 0,
                             "sec": 0, "microsec": 100}
    assert value["col14"] == {"kind": "POINT", "rings": [[{"x": 3.0, "y": 8.0}]]}
    edge = with_value(edge_kv(rows, EdgeSpec("friend", "src", "dst", None, tuple(NAMES)), GRAPH))
    edge = edge.collect()
    assert sorted(bytes(r.key).hex() for r in edge) == [
        "0201000032000000000000000000feffffff80000000000000003100000000000000000001",
        "02060000310000000000000000000200000080000000000000003200000000000000000001"]
    assert edge[0].value == edge[1].value
    assert sorted(r.part for r in edge) == [1, 6]


def test_hash_policy_ids(spark):
    graph = GraphTarget(10, "INT", 8, {"v": Label.of("vertex", {}, 1)})
    rows = spark.createDataFrame([("Bob",), ("Bob ",), ("Tom",)], "id string")
    kv = vertex_kv(rows, VertexSpec("v", "id", policy="hash"), graph)
    # ids are compared after trimming, so the two Bobs are one vertex
    assert kv.count() == 2
    assert with_value(kv).first().value == bytearray(b"{}")


def test_values_round_trip(spark):
    rows = spark.createDataFrame([(1, "a\"b", None)], "i int, s string, n double")
    packed = rows.select(kv_value(F.struct("i", "s", "n")).alias("v"))
    back = packed.select(F.from_json(F.col("v").cast("string"), "i int, s string, n double"))
    assert tuple(back.first()[0]) == (1, 'a"b', None)


EDGES = GraphTarget(10, "INT", 8, {"contains": Label.of("edge", {"flag": "STRING"}, 12)})
LINES = EdgeSpec("contains", "l_orderkey", "l_partkey", "l_linenumber", ("l_returnflag",),
                 ("flag",))


def test_sorted_inside_tasks(spark, data):
    kv = with_value(edge_kv(spark.read.parquet(f"{data}/lineitem.parquet"), LINES, EDGES))
    rows = sort_kv(kv.repartition(5)).withColumn("task", F.spark_partition_id()).collect()
    by_task = {}
    for r in rows:
        by_task.setdefault(r.task, []).append(bytes(r.key))
    assert all(keys == sorted(keys) for keys in by_task.values())


def test_files_are_sorted_complete_and_do_not_overlap(spark, data, tmp_path):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    # a third of all lines belong to one order
    lines = lines.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, 7).otherwise(
        F.col("l_orderkey")))
    kv = edge_kv(lines, LINES, EDGES)
    path = str(tmp_path / "kv")
    write_kv(kv, path, files=12)
    assert spark.read.parquet(path).count() == kv.count()
    spans = {}
    for folder, _, files in os.walk(path):
        for name in files:
            if name.endswith(".parquet"):
                part = [p for p in folder.split("/") if p.startswith("part=")][0]
                table = spark.read.parquet(f"{folder}/{name}").select("key").toPandas()
                keys = [bytes(k) for k in table["key"]]
                assert keys == sorted(keys)
                spans.setdefault(part, []).append((keys[0], keys[-1]))
    for ranges in spans.values():
        ranges.sort()
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    # the part of the hot order is written by several tasks
    assert max(len(r) for r in spans.values()) > 2


def test_ranks_default_to_zero(spark):
    rows = spark.createDataFrame([(1, 2)], "l_orderkey int, l_partkey int")
    spec = EdgeSpec("contains", "l_orderkey", "l_partkey")
    assert edge_rows(rows, spec, EDGES).first()["rank"] == 0


def test_sorted_tasks_grow_in_number(spark, data, monkeypatch):
    """Tasks that sort and look at rows follow the rows, whatever the session's partitions."""
    monkeypatch.setattr(kv, "ROWS_PER_TASK", 1000)
    lines = spark.read.parquet(f"{data}/lineitem.parquet").count()
    found = keyvalue.kv_sorted(spark, data)
    counts = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(counts) == -(-2 * lines // 1000)
    assert max(r["count"] for r in counts) < 2000


def test_files_and_their_checks_grow_in_number(spark, data, monkeypatch, tmp_path):
    path = str(tmp_path / "kv")
    monkeypatch.setattr(kv, "ROWS_PER_TASK", 1000)
    monkeypatch.setattr(keyvalue, "scratch_path", lambda *a: path)
    keyvalue.kv_files(spark, data)
    rows = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
    lines = spark.read.parquet(f"{data}/lineitem.parquet").count()
    assert len(rows) >= 2 * lines // 1000 and max(r["count"] for r in rows) < 2000


def test_file_checks_see_rows_out_of_order(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(keyvalue, "_RUN", 4)
    for name, keys, wrong in (("sorted", range(10), 0), ("inside", [0, 2, 1, *range(3, 10)], 1),
                              ("between", [0, 1, 2, 4, 3, 5, 6, 7, 8, 9], 1)):
        rows = spark.createDataFrame([(1, 2, bytes([k]), b"") for k in keys],
                                     "part int, prefix int, key binary, value binary")
        path = str(tmp_path / name)
        rows.coalesce(1).write.partitionBy("part", "prefix").parquet(path)
        found = keyvalue._file_checks(spark.read.parquet(path), 3).first()
        assert (found.n, found.out_of_order, found.overlaps) == (10, wrong, 0), name
