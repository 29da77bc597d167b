import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphload.operators.kv import vertex_kv, with_value
from graphload.operators.rows import dedup_vertices
from graphload.operators.slices import with_row_index
from graphload.operators.statements import render, render_items, statement_frame, statement_rows
from graphload.spec import EdgeSpec, GraphTarget, Label, VertexSpec
from test_values import FOURTEEN, MARKER

PERSON = {"name": "STRING", "age": "INT64", "gender": "INT64", "high": "DOUBLE",
          "weight": "INT64"}
GRAPH = GraphTarget(1, "STRING", 8, {
    "person": Label.of("vertex", PERSON, 1), "friend": Label.of("edge", PERSON, 2),
    "bare": Label.of("edge", {}, 3),
    "odd-name 1": Label.of("vertex", {"a-b": "STRING", "中 文": "INT64"}, 4)})
FIELDS = tuple(PERSON)


def statement(df, spec, graph=GRAPH, **options):
    rows = render(df, spec, graph, buckets=1, **options).collect()
    assert len(rows) == 1
    return rows[0].statement


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("vid1", "Tom", 10, 0, 172.5, 55), ("vid2", "Jena", 12, 1, 165.5, 45)],
        "id string, name string, age int, gender int, high double, weight int")


@pytest.fixture
def friends(people):
    return people.selectExpr(
        "id AS src", "CASE id WHEN 'vid1' THEN 'vid2' ELSE 'vid3' END AS dst",
        "CASE id WHEN 'vid1' THEN 0 ELSE 1 END AS rank", *FIELDS)


# The two rows and their texts are goldens that must match.
TOM, JENA = '("Tom", 10, 0, 172.5, 55)', '("Jena", 12, 1, 165.5, 45)'
SET_TOM = '`name`="Tom",`age`=10,`gender`=0,`high`=172.5,`weight`=55'
SET_JENA = '`name`="Jena",`age`=12,`gender`=1,`high`=165.5,`weight`=45'
NAMES = "`name`,`age`,`gender`,`high`,`weight`"


@pytest.mark.parametrize("options, expected", [
    ({}, f'INSERT VERTEX `person`({NAMES}) VALUES "vid1": {TOM}, "vid2": {JENA}'),
    ({"ignore_index": True},
     f'INSERT VERTEX IGNORE_EXISTED_INDEX `person`({NAMES}) VALUES "vid1": {TOM}, "vid2": {JENA}'),
    ({"mode": "delete"}, 'DELETE VERTEX "vid1", "vid2"'),
    ({"mode": "delete", "delete_edge": True}, 'DELETE VERTEX "vid1", "vid2" WITH EDGE'),
    ({"mode": "update"}, f'UPDATE VERTEX ON `person` "vid1" SET {SET_TOM};'
                         f'UPDATE VERTEX ON `person` "vid2" SET {SET_JENA}'),
    ({"mode": "upsert"}, f'UPSERT VERTEX ON `person` "vid1" SET {SET_TOM};'
                         f'UPSERT VERTEX ON `person` "vid2" SET {SET_JENA}'),
])
def test_vertex_statements(people, options, expected):
    assert statement(people, VertexSpec("person", "id", FIELDS, **options)) == expected


@pytest.mark.parametrize("options, expected", [
    ({}, f'INSERT EDGE `friend`({NAMES}) VALUES "vid1"->"vid2"@0: {TOM}, "vid2"->"vid3"@1: {JENA}'),
    ({"rank": None},
     f'INSERT EDGE `friend`({NAMES}) VALUES "vid1"->"vid2": {TOM}, "vid2"->"vid3": {JENA}'),
    ({"ignore_index": True}, f'INSERT EDGE IGNORE_EXISTED_INDEX `friend`({NAMES}) VALUES '
                             f'"vid1"->"vid2"@0: {TOM}, "vid2"->"vid3"@1: {JENA}'),
    ({"mode": "delete"}, 'DELETE EDGE `friend` "vid1"->"vid2"@0, "vid2"->"vid3"@1'),
    ({"mode": "delete", "rank": None}, 'DELETE EDGE `friend` "vid1"->"vid2"@0, "vid2"->"vid3"@0'),
    ({"mode": "update"}, f'UPDATE EDGE ON `friend` "vid1"->"vid2"@0 SET {SET_TOM};'
                         f'UPDATE EDGE ON `friend` "vid2"->"vid3"@1 SET {SET_JENA}'),
    ({"mode": "upsert"}, f'UPSERT EDGE ON `friend` "vid1"->"vid2"@0 SET {SET_TOM};'
                         f'UPSERT EDGE ON `friend` "vid2"->"vid3"@1 SET {SET_JENA}'),
])
def test_edge_statements(friends, options, expected):
    spec = EdgeSpec(**{"label": "friend", "src": "src", "dst": "dst", "rank": "rank",
                       "fields": FIELDS, **options})
    assert statement(friends, spec) == expected


def test_all_property_types_in_one_row(spark):
    names = [f"col{i + 1}" for i in range(14)]
    graph = GraphTarget(10, "STRING", 8, {
        "person": Label.of("vertex", dict(zip(names, [f[0] for f in FOURTEEN]))),
        "friend": Label.of("edge", dict(zip(names, [f[0] for f in FOURTEEN])))}, MARKER)
    schema = ", ".join(f"{n} {f[1]}" for n, f in zip(names, FOURTEEN))
    rows = spark.createDataFrame([("1", "2", *[f[2] for f in FOURTEEN])],
                                 f"id string, dst string, {schema}")
    values = ", ".join(f[3] for f in FOURTEEN)
    item = render_items(rows, VertexSpec("person", "id", tuple(names)), graph).first().item
    assert item == f'"1": ({values})'
    spec = EdgeSpec("friend", "id", "dst", None, tuple(names))
    assert render_items(rows, spec, graph).first().item == f'"1"->"2": ({values})'


def test_policies_prefixes_and_nulls(spark):
    rows = spark.createDataFrame([(" 1 ", '2"', None, 7)], "a string, b string, n string, r int")
    ints = GraphTarget(3, "INT", 8, {"e": Label.of("edge", {"n": "STRING"}),
                                     "v": Label.of("vertex", {"n": "STRING"})})
    text = GraphTarget(3, "STRING", 8, ints.labels)
    edge = EdgeSpec("e", "a", "b", "r", ("n",), src_policy="hash", dst_policy="uuid")
    assert render_items(rows, edge, ints).first().item == 'hash("1")->uuid("2"")@7: (null)'
    for mode in ("update", "upsert"):
        edge = EdgeSpec("e", "a", "b", "r", ("n",), src_policy="hash", dst_policy="uuid", mode=mode)
        assert render_items(rows, edge, ints).first().item == (
            f'{mode.upper()} EDGE ON `e` hash("1")->uuid("2"")@7 SET `n`=null')
    edge = EdgeSpec("e", "a", "b", None, src_prefix="src", dst_prefix="dst")
    assert render_items(rows, edge, text).first().item == '"src_1"->"dst_2\\"": ()'
    assert render_items(rows, VertexSpec("v", "a", prefix="prefix"), text).first().item == (
        '"prefix_1": ()')
    assert render_items(rows, VertexSpec("v", "a"), ints).first().item == "1: ()"


def test_symbols_in_names(spark):
    rows = spark.createDataFrame([("1", "x", 2)], "id string, p string, q int")
    spec = VertexSpec("odd-name 1", "id", ("p", "q"), ("a-b", "中 文"))
    assert statement(rows, spec) == 'INSERT VERTEX `odd-name 1`(`a-b`,`中 文`) VALUES "1": ("x", 2)'
    with pytest.raises(ValueError, match="back-tick"):
        statement_frame(VertexSpec("odd `name`", "id"))


def test_numeric_rank_is_written_as_a_number(spark):
    rows = spark.createDataFrame([("1", "2", " 007")], "s string, d string, r string")
    item = render_items(rows, EdgeSpec("bare", "s", "d", "r"), GRAPH).first().item
    assert item == '"1"->"2"@7: ()'


def test_batches_keep_every_row(spark):
    rows = spark.range(1234).selectExpr("cast(id AS string) AS id", "id AS age")
    graph = GraphTarget(5, "STRING", 8, GRAPH.labels)
    spec = VertexSpec("person", "id", ("age",))
    got = render(rows, spec, graph, batch=50)
    assert got.agg(F.sum("n_rows")).first()[0] == 1234
    assert got.filter("n_rows > 50").count() == 0
    assert got.filter(statement_rows("statement") != F.col("n_rows")).count() == 0
    assert statement_frame(spec).head == "INSERT VERTEX `person`(`age`) VALUES "


def test_batches_do_not_follow_the_session(spark):
    rows = spark.range(500).selectExpr("cast(id AS string) AS id", "id AS age")
    graph = GraphTarget(5, "STRING", 8, GRAPH.labels)
    found = []
    for setting in ("2", "7"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        got = render(rows.repartition(int(setting)), VertexSpec("person", "id", ("age",)), graph, batch=3)
        assert got.columns == ["part", "bucket", "batch_id", "n_rows", "statement"]
        found.append(sorted(map(tuple, got.collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_rendering_shuffles_once(spark, data):
    rows = spark.read.parquet(f"{data}/customer.parquet")
    spec = VertexSpec("person", "c_custkey", ("c_name",), ("name",))
    plan = render(rows, spec, GraphTarget(10, "INT", 8, GRAPH.labels))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in render(
        rows.select("c_custkey", "c_name"), spec, GraphTarget(10, "INT", 8, GRAPH.labels)
    )._jdf.queryExecution().executedPlan().toString()


def test_rows_without_an_id_stop_the_job(spark):
    rows = spark.createDataFrame([("1", 1), (None, 2)], "id string, age int")
    spec = VertexSpec("person", "id", ("age",))
    with pytest.raises(PySparkException, match="without an id"):
        render_items(rows, spec, GRAPH).collect()
    with pytest.raises(PySparkException, match="without an id"):
        render(rows, spec, GRAPH).collect()


def test_any_column_name_works(spark):
    rows = spark.createDataFrame([("1", 1, "x", "o")], ["a.b", "part", "c`d e", "batch_id"])
    graph = GraphTarget(3, "STRING", 8, {"v": Label.of(
        "vertex", {"p": "INT64", "q": "STRING", "r": "STRING"})})
    spec = VertexSpec("v", "a.b", ("part", "c`d e", "batch_id"), ("p", "q", "r"))
    for buckets in (1, 3):
        got = render(rows, spec, graph, buckets=buckets).first()
        assert got.statement == 'INSERT VERTEX `v`(`p`,`q`,`r`) VALUES "1": (1, "x", "o")'
    kv = with_value(vertex_kv(rows, spec, graph)).first()
    assert bytes(kv.value) == b'{"p":1,"q":"x","r":"o"}'
    indexed = with_row_index(rows, ["a.b"]).first()
    assert indexed.row_index == 0 and indexed["c`d e"] == "x"
    assert dedup_vertices(rows, "a.b", ["c`d e"]).columns == rows.columns
