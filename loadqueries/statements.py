"""Every statement form, one query each, plus counts of what statements carry."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graphload.operators.statements import render, statement_rows
from graphload.spec import EdgeSpec, GraphTarget, Label, VertexSpec

from .base import (
    INT_GRAPH, PARTS, STRING_GRAPH, query, sql_part_int, sql_part_string, sql_quote, sql_signed,
    sql_murmur, sql_text, table,
)

# A bucket is a block of so many keys: their number grows with the table, their size does not.
KEYS = 1000
ORDERS = 10000


def sql_statements(source: str, item: str, part: str, order: str, bucket: str, head: str = "",
                   sep: str = ", ", tail: str = "", batch: int = 500) -> str:
    """SQL of the batches: rows of one (part, bucket) in order, ``batch`` at a time."""
    return f"""
WITH r AS (SELECT {item} AS item, {part} AS part, ({bucket})::INTEGER AS bucket, {order}
           FROM {source}),
b AS (SELECT *, row_number() OVER (PARTITION BY part, bucket ORDER BY {order}) - 1 AS pos
      FROM r)
SELECT part, bucket, pos // {batch} AS batch_id, count(*) AS n_rows,
       {sql_text(head)} || string_agg(item, {sql_text(sep)} ORDER BY pos) || {sql_text(tail)}
       AS statement
FROM b GROUP BY part, bucket, batch_id
"""


def _statements(rows, spec, graph, key, block, order, batch=500):
    bucket = F.call_function("div", key, F.lit(block)).cast("int")
    return render(rows, spec, graph, batch=batch, order_by=order, bucket=bucket)


# -- vertices --------------------------------------------------------------------------

_CUSTOMER = dict(label="customer", id="c_custkey", fields=("c_name", "c_nationkey", "c_mktsegment"),
                 targets=("name", "nation", "segment"))
_CUSTOMER_VALUES = ["'\"' || c_name || '\"'", "c_nationkey::VARCHAR", "'\"' || c_mktsegment || '\"'"]
_NAMES = ["name", "nation", "segment"]
_SET = " || ',' || ".join(f"'`{n}`=' || {v}" for n, v in zip(_NAMES, _CUSTOMER_VALUES))
_ROW = "': (' || " + " || ', ' || ".join(_CUSTOMER_VALUES) + " || ')'"
_INT_KEY = dict(part=sql_part_int("c_custkey"), order="c_custkey", bucket=f"c_custkey // {KEYS}")


def _customers(spark, sf_dir, graph=INT_GRAPH, **changes):
    spec = VertexSpec(**{**_CUSTOMER, **changes})
    return _statements(table(spark, sf_dir, "customer"), spec, graph, F.col("c_custkey"), KEYS,
                       ["c_custkey"], 30)


@query(sql_statements("customer", f"c_custkey || {_ROW}", **_INT_KEY, batch=30,
                      head="INSERT VERTEX `customer`(`name`,`nation`,`segment`) VALUES "))
def stmt_insert_vertex(spark, sf_dir):
    return _customers(spark, sf_dir)


@query(sql_statements(
    "customer", f"'\"c_' || c_custkey || '\"' || {_ROW}", sql_part_string("'c_' || c_custkey"),
    "c_custkey", f"c_custkey // {KEYS}", batch=30,
    head="INSERT VERTEX IGNORE_EXISTED_INDEX `customer`(`name`,`nation`,`segment`) VALUES "))
def stmt_insert_ignore(spark, sf_dir):
    return _customers(spark, sf_dir, STRING_GRAPH, prefix="c", ignore_index=True)


@query(sql_statements(
    "customer", f"'hash(\"' || c_name || '\")' || {_ROW}",
    sql_part_int(sql_signed(sql_murmur("c_name"))), "c_custkey", f"c_custkey // {KEYS}",
    batch=30, head="INSERT VERTEX `customer`(`name`,`nation`,`segment`) VALUES "))
def stmt_insert_hashed(spark, sf_dir):
    return _customers(spark, sf_dir, id="c_name", policy="hash")


@query(sql_statements(
    "documents", f"'\"' || doc_id || '\": (' || {sql_quote('''regexp_replace(text,
    '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')''')} || ', ' || CASE WHEN lang = 'en' THEN 'null' "
    "ELSE '\"' || lang || '\"' END || ')'",
    sql_part_string("doc_id::VARCHAR"), "doc_id", f"doc_id // {KEYS}", batch=20,
    head="INSERT VERTEX `document`(`body`,`lang`) VALUES "))
def stmt_insert_documents(spark, sf_dir):
    """Whole texts, escaped, in batches of 20; a NULL property."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"))
    spec = VertexSpec("document", "doc_id", ("text", "lang"), ("body", "lang"))
    return _statements(docs, spec, STRING_GRAPH, F.col("doc_id"), KEYS, ["doc_id"], 20)


@query(sql_statements("customer", "c_custkey::VARCHAR", **_INT_KEY, batch=30,
                      head="DELETE VERTEX "))
def stmt_delete_vertex(spark, sf_dir):
    return _customers(spark, sf_dir, mode="delete")


@query(sql_statements("customer", "c_custkey::VARCHAR", **_INT_KEY, batch=30,
                      head="DELETE VERTEX ", tail=" WITH EDGE"))
def stmt_delete_with_edge(spark, sf_dir):
    return _customers(spark, sf_dir, mode="delete", delete_edge=True)


@query(sql_statements("customer", f"'UPDATE VERTEX ON `customer` ' || c_custkey || ' SET ' || {_SET}",
                      **_INT_KEY, batch=30, sep=";"))
def stmt_update_vertex(spark, sf_dir):
    return _customers(spark, sf_dir, mode="update")


@query(sql_statements("customer", f"'UPSERT VERTEX ON `customer` ' || c_custkey || ' SET ' || {_SET}",
                      **_INT_KEY, batch=30, sep=";"))
def stmt_upsert_vertex(spark, sf_dir):
    return _customers(spark, sf_dir, mode="upsert")


# -- edges -----------------------------------------------------------------------------

_LINE = dict(label="contains", src="l_orderkey", dst="l_partkey", rank="l_linenumber",
             fields=("l_quantity", "l_returnflag", "l_shipdate"),
             targets=("quantity", "flag", "shipped"))
_LINE_VALUES = ["l_quantity::VARCHAR", "'\"' || l_returnflag || '\"'",
                "'datetime(\"' || l_shipdate || '\")'"]
_LINE_SET = " || ',' || ".join(f"'`{n}`=' || {v}" for n, v in
                               zip(["quantity", "flag", "shipped"], _LINE_VALUES))
_LINE_ROW = "': (' || " + " || ', ' || ".join(_LINE_VALUES) + " || ')'"
_LINE_ENDS = "l_orderkey || '->' || l_partkey"
_LINE_KEY = f"{_LINE_ENDS} || '@' || l_linenumber"
_LINE_ORDER = dict(part=sql_part_int("l_orderkey"), order="l_orderkey, l_partkey, l_linenumber, "
                   "l_quantity, l_returnflag, l_shipdate",
                   bucket=f"l_orderkey // {ORDERS}")
_INSERT_LINE = "INSERT EDGE `contains`(`quantity`,`flag`,`shipped`) VALUES "


def _lines(spark, sf_dir, **changes):
    spec = EdgeSpec(**{**_LINE, **changes})
    return _statements(table(spark, sf_dir, "lineitem"), spec, INT_GRAPH, F.col("l_orderkey"),
                       ORDERS, ["l_orderkey", "l_partkey", "l_linenumber"])


@query(sql_statements("lineitem", f"{_LINE_KEY} || {_LINE_ROW}", **_LINE_ORDER, head=_INSERT_LINE))
def stmt_insert_edge(spark, sf_dir):
    return _lines(spark, sf_dir)


@query(sql_statements("lineitem", f"{_LINE_ENDS} || {_LINE_ROW}", **_LINE_ORDER,
                      head=_INSERT_LINE))
def stmt_insert_edge_norank(spark, sf_dir):
    return _lines(spark, sf_dir, rank=None)


@query(sql_statements(
    "orders", "'\"c_' || o_custkey || '\"->\"o_' || o_orderkey || '\": (\"' || o_orderpriority "
    "|| '\")'", sql_part_string("'c_' || o_custkey"), "o_custkey, o_orderkey",
    f"o_orderkey // {ORDERS}", head="INSERT EDGE IGNORE_EXISTED_INDEX `placed`(`priority`) VALUES "))
def stmt_insert_edge_text_ids(spark, sf_dir):
    spec = EdgeSpec("placed", "o_custkey", "o_orderkey", None, ("o_orderpriority",), ("priority",),
                    src_prefix="c", dst_prefix="o", ignore_index=True)
    return _statements(table(spark, sf_dir, "orders"), spec, STRING_GRAPH, F.col("o_orderkey"),
                       ORDERS, ["o_custkey", "o_orderkey"])


@query(sql_statements("lineitem", _LINE_KEY, **_LINE_ORDER, head="DELETE EDGE `contains` "))
def stmt_delete_edge(spark, sf_dir):
    return _lines(spark, sf_dir, mode="delete")


@query(sql_statements("lineitem", f"'UPDATE EDGE ON `contains` ' || {_LINE_KEY} || ' SET ' || "
                      f"{_LINE_SET}", **_LINE_ORDER, sep=";"))
def stmt_update_edge(spark, sf_dir):
    return _lines(spark, sf_dir, mode="update")


@query(sql_statements("lineitem", f"'UPSERT EDGE ON `contains` ' || {_LINE_KEY} || ' SET ' || "
                      f"{_LINE_SET}", **_LINE_ORDER, sep=";"))
def stmt_upsert_edge(spark, sf_dir):
    return _lines(spark, sf_dir, mode="upsert")


@query(sql_statements(
    "orders", "'UPSERT EDGE ON `placed` hash(\"' || o_custkey || '\")->uuid(\"' || o_orderkey "
    "|| '\")@0 SET `priority`=\"' || o_orderpriority || '\"'",
    sql_part_int(sql_signed(sql_murmur("o_custkey::VARCHAR"))), "o_custkey, o_orderkey",
    f"o_orderkey // {ORDERS}", sep=";"))
def stmt_upsert_edge_policies(spark, sf_dir):
    spec = EdgeSpec("placed", "o_custkey", "o_orderkey", None, ("o_orderpriority",), ("priority",),
                    src_policy="hash", dst_policy="uuid", mode="upsert")
    return _statements(table(spark, sf_dir, "orders"), spec, INT_GRAPH, F.col("o_orderkey"),
                       ORDERS, ["o_custkey", "o_orderkey"])


@query(f"WITH r AS (SELECT {sql_part_int('l_orderkey')} AS part, "
       f"(l_orderkey // {ORDERS})::INTEGER AS bucket, row_number() OVER (PARTITION BY part, bucket) "
       "- 1 AS pos FROM lineitem) SELECT part, bucket, pos // 500 AS batch_id, "
       "count(*)::INTEGER AS carried FROM r GROUP BY ALL", name="statement_rows")
def rows_in_statements(spark, sf_dir):
    return stmt_insert_edge(spark, sf_dir).select(
        "part", "bucket", "batch_id", statement_rows("statement").alias("carried"))


@query(f"SELECT {sql_part_int('l_orderkey')} AS part, count(*) AS n_rows, count(*) AS carried, "
       "0::BIGINT AS oversize, 0::BIGINT AS gaps FROM lineitem GROUP BY part")
def batch_facts(spark, sf_dir):
    """Batches in buckets by row hash: no row lost, none above the limit, only the last not full."""
    spec = EdgeSpec(**_LINE)
    batches = render(table(spark, sf_dir, "lineitem"), spec, INT_GRAPH, batch=100)
    last = F.max("batch_id").over(Window.partitionBy("part", "bucket"))
    return batches.withColumn("last", last).groupBy("part").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(statement_rows("statement").cast("bigint")).alias("carried"),
        F.sum((F.col("n_rows") > 100).cast("bigint")).alias("oversize"),
        F.sum(((F.col("n_rows") < 100) & (F.col("batch_id") < F.col("last"))).cast("bigint"))
        .alias("gaps"))


@query(sql_statements("customer", "c_custkey || ': (' || c_nationkey || ')'", **_INT_KEY, batch=30,
                      head="INSERT VERTEX `odd-name 1`(`nation of: home`) VALUES "))
def stmt_symbols(spark, sf_dir):
    """Names with blanks and symbols."""
    graph = GraphTarget(PARTS, "INT", 8, {
        "odd-name 1": Label.of("vertex", {"nation of: home": "INT32"}, 1)})
    spec = VertexSpec("odd-name 1", "c_custkey", ("c_nationkey",), ("nation of: home",))
    return _statements(table(spark, sf_dir, "customer"), spec, graph, F.col("c_custkey"), KEYS,
                       ["c_custkey"], 30)
