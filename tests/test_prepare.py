import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphload.operators.prepare import (
    apply_filter, edge_problem, edge_valid, enforce, id_problem, preview, project_properties,
    rank_problem, required_fields, vertex_problem, vertex_valid, with_composite_key,
)
from graphload.spec import EdgeSpec, GraphTarget, Label, VertexSpec, bind_schema


# value, policy, id type, prefix, valid
TRUTH = [
    ("Bob", None, "STRING", None, True),
    ("Bob", None, "INT", None, False),
    ("11", None, "INT", None, True),
    ("11", None, "STRING", None, True),
    ("Bob", "hash", "STRING", None, False),
    ("Bob", "hash", "INT", None, True),
    ("Bob", "hash", "INT", "p", True),
    ("Bob", "hash", "STRING", "p", False),
    ("1", None, "STRING", "p", True),
    ("1", None, "INT", "p", False),
    (None, None, "STRING", None, False),
    (None, "hash", "INT", None, False),
    (" 12\t", None, "INT", None, True),
    ("", None, "INT", None, False),
    ("-", None, "INT", None, False),
    ("99999999999999999999", None, "INT", None, False),
]


@pytest.mark.parametrize("value, policy, id_type, prefix, valid", TRUTH)
def test_vertex_and_edge_ids(spark, value, policy, id_type, prefix, valid):
    rows = spark.createDataFrame([(value, "5")], "a string, b string")
    assert rows.select(vertex_valid("a", id_type, policy, prefix)).first()[0] is valid
    both = EdgeSpec("e", "a", "a", src_policy=policy, dst_policy=policy, src_prefix=prefix,
                    dst_prefix=prefix)
    assert rows.select(edge_valid(both, id_type)).first()[0] is valid


def test_integer_columns_need_no_check_of_values(spark):
    rows = spark.createDataFrame([(1,), (None,)], "a bigint")
    got = rows.select(id_problem("a", "INT", schema=rows.schema),
                      rank_problem("a", rows.schema)).collect()
    assert [tuple(r) for r in got] == [(None, None), ("id: missing", "rank: missing")]
    text = rows.select(id_problem("a", "INT", schema=rows.schema))._jdf.queryExecution().toString()
    assert "RLIKE" not in text


def test_edges_name_their_problem(spark):
    rows = spark.createDataFrame(
        [("1", "2", "3"), (None, "2", "3"), ("1", "x", "3"), ("1", "2", None), ("1", "2", "r")],
        "s string, d string, r string")
    got = rows.select(edge_problem(EdgeSpec("e", "s", "d", "r"), "INT")).collect()
    assert [r[0] for r in got] == [None, "source: missing", "target: not an integer",
                                   "rank: missing", "rank: not an integer"]


def test_invalid_row_modes(spark):
    rows = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    problem = vertex_problem(VertexSpec("v", "a"), "INT")
    assert [r.a for r in enforce(rows, problem, "drop").collect()] == ["1"]
    good, bad = enforce(rows, problem, "quarantine")
    assert [r.a for r in good.collect()] == ["1"]
    assert sorted((r.a or "", r.problem) for r in bad.collect()) == [
        ("", "id: missing"), ("x", "id: not an integer")]
    with pytest.raises(PySparkException, match="invalid row [0-9]+, id: "):
        enforce(rows, problem, "fail").collect()
    # a later predicate on the checked column, and grouping by it, see the check as well
    for use in (lambda df: df.filter("a = '1'"), lambda df: df.groupBy("a").count()):
        with pytest.raises(PySparkException, match="invalid row"):
            use(enforce(rows, problem, "fail")).collect()
    assert enforce(rows.filter("a = '1'"), problem, "fail").collect() == [("1",)]
    with pytest.raises(ValueError):
        enforce(rows, problem, "ignore")


def test_composite_key_skips_null_parts(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, None)], "x string, y int")
    got = with_composite_key(rows, "_", ["x", "y"], "k")
    assert [r.k for r in got.collect()] == ["a_1", "2", ""]
    assert dict(got.dtypes)["k"] == "string"


def test_projection_and_preview(spark):
    rows = spark.range(50).selectExpr("id", "id AS a", "id AS b")
    assert project_properties(rows, ["a", " ", "b"], ["x", "n", "y"], ["id"]).columns == [
        "id", "x", "y"]
    assert project_properties(rows, ["a"]).columns == ["a"]
    with pytest.raises(ValueError):
        project_properties(rows, ["a"], ["x", "y"])
    assert preview(rows).count() == 20
    assert apply_filter(rows, None) is rows
    assert apply_filter(rows, "a > 40 AND b < 45").count() == 4


def test_required_fields():
    assert required_fields(VertexSpec("v", "id", ("a", "", "id"))) == ["id", "a"]
    assert required_fields(EdgeSpec("e", "s", "d", "r", ("a", "s"))) == ["s", "d", "r", "a"]


GRAPH = GraphTarget(10, "STRING", 8, {
    "person": Label.of("vertex", {"col1": "STRING", "col2": "int64"}, 1),
    "friend": Label.of("edge", {"col1": "STRING"}, 2)})


def test_binding_to_the_target():
    spec = VertexSpec("person", "id", ("a", "", "b"), ("col1", "zz", "col2"))
    assert bind_schema(spec, GRAPH) == {"col1": "STRING", "col2": "INT64"}
    with pytest.raises(ValueError, match="property nope"):
        bind_schema(VertexSpec("person", "id", ("a",), ("nope",)), GRAPH)
    with pytest.raises(ValueError, match="does not exist"):
        bind_schema(VertexSpec("ghost", "id"), GRAPH)
    with pytest.raises(ValueError, match="not a vertex"):
        bind_schema(VertexSpec("friend", "id"), GRAPH)


def test_labels_from_spark_schemas(spark):
    schema = spark.createDataFrame(
        [], "s string, b boolean, i tinyint, d date, t timestamp_ntz, x double").schema
    schema["s"].metadata["graph_type"] = "GEOGRAPHY"
    assert Label.of("vertex", schema).properties == {
        "s": "GEOGRAPHY", "b": "BOOL", "i": "INT8", "d": "DATE", "t": "DATETIME", "x": "DOUBLE"}


@pytest.mark.parametrize("make", [
    lambda: VertexSpec("v", " "), lambda: VertexSpec(" ", "id"),
    lambda: VertexSpec("v", "id", mode="merge"), lambda: VertexSpec("v", "id", ("a",), ()),
    lambda: VertexSpec("v", "id", policy="md5"), lambda: EdgeSpec("e", "s", ""),
    lambda: EdgeSpec("e", "s", "d", " "), lambda: GraphTarget(0), lambda: GraphTarget(1, "UUID"),
    lambda: Label.of("node", {}), lambda: Label.of("vertex", {"a": "BLOB"}),
])
def test_bad_descriptions_are_refused(make):
    with pytest.raises(ValueError):
        make()


def test_filter_reaches_the_scan(spark, data):
    rows = apply_filter(spark.read.parquet(f"{data}/lineitem.parquet"), "l_quantity > 30")
    rows = rows.select(F.col("l_orderkey"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,30.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
