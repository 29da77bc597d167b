"""Scans: files written from the given tables and read back, SQL views, cells, slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphload.operators.positions import read_file_slices
from graphload.operators.slices import offset_splits, read_slices, source_count
from graphload.sources import (
    cells_to_rows, project_json, read_lines, read_source, sql_source, stringify_columns,
)
from graphload.storage import scratch_path

from .base import query, table


@query("SELECT * FROM lineitem")
def src_parquet(spark, sf_dir):
    return read_source(spark, {"type": "parquet", "path": f"{sf_dir}/lineitem.parquet"})


@query("SELECT * FROM orders")
def src_orc(spark, sf_dir):
    path = scratch_path(spark, "orders.orc")
    table(spark, sf_dir, "orders").write.orc(path)
    return read_source(spark, {"type": "orc", "path": path})


@query("SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey::BIGINT AS c_nationkey "
       "FROM customer")
def src_json(spark, sf_dir):
    path = scratch_path(spark, "customer.json")
    table(spark, sf_dir, "customer").write.json(path)
    return read_source(spark, {"type": "json", "path": path})


@query("SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS absent FROM customer")
def src_json_sampled(spark, sf_dir):
    """Needed fields of JSON lines with the types of the first lines, in one pass."""
    path = scratch_path(spark, "customer.json")
    table(spark, sf_dir, "customer").write.json(path)
    return read_source(spark, {"type": "json", "path": path},
                       ["c_custkey", "c_name", "c_acctbal", "absent"])


@query("SELECT doc_id::VARCHAR AS doc_id, lang, source, n_chars::VARCHAR AS n_chars, "
       "CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END AS note "
       "FROM documents")
def src_csv(spark, sf_dir):
    """With a header; note is a quoted empty field, a missing one, or text."""
    path = scratch_path(spark, "documents.csv")
    note = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(
        F.col("doc_id") % 3 == 2, F.col("lang"))
    (table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars",
                                              note.alias("note"))
     .write.option("header", True).option("emptyValue", '""').option("nullValue", "").csv(path))
    return read_source(spark, {"type": "csv", "path": path, "header": True})


@query("SELECT l_orderkey::VARCHAR AS orderkey, l_linenumber::VARCHAR AS line, "
       "l_returnflag AS flag FROM lineitem")
def src_csv_headerless(spark, sf_dir):
    path = scratch_path(spark, "lineitem.csv")
    (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
     .write.option("sep", "|").csv(path))
    rows = read_source(spark, {"type": "csv", "path": path, "sep": "|"})
    return rows.select(F.col("_c0").alias("orderkey"), F.col("_c1").alias("line"),
                       F.col("_c2").alias("flag"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'click'")
def src_lines(spark, sf_dir):
    path = scratch_path(spark, "events.txt")
    (table(spark, sf_dir, "events")
     .select(F.concat_ws("|", "event_id", "user_id", "event_type").alias("value"))
     .write.text(path))
    parts = F.split("value", r"\|")
    return read_lines(spark, path, {
        "event_id": parts[0].cast("bigint"), "user_id": parts[1].cast("bigint"),
        "event_type": parts[2]}, "event_type <> 'click'")


@query("SELECT event_id, user_id, event_type FROM events "
       "WHERE event_type = (SELECT min(event_type) FROM events)")
def src_partition(spark, sf_dir):
    """One folder of a partitioned table; the other folders are not read."""
    path = scratch_path(spark, "events_by_type")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    events.write.partitionBy("event_type").parquet(path)
    first = events.agg(F.min("event_type")).first()[0]
    return read_source(spark, {"type": "parquet", "path": path,
                               "partition_spec": f"event_type='{first}'"})


@query("SELECT n_name, count(*) AS customers FROM customer JOIN nation "
       "ON c_nationkey = n_nationkey GROUP BY n_name")
def src_sql_view(spark, sf_dir):
    return sql_source(
        spark, "SELECT n_name, count(*) AS customers FROM src_customer JOIN src_nation "
        "ON c_nationkey = n_nationkey GROUP BY n_name",
        {"src_customer": table(spark, sf_dir, "customer"),
         "src_nation": table(spark, sf_dir, "nation")})


@query("SELECT c_custkey::VARCHAR AS rowkey, c_name AS name, "
       "CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment, NULL::VARCHAR AS absent "
       "FROM customer")
def src_cells(spark, sf_dir):
    """Customers as (rowkey, family, qualifier, value) cells, then back to rows."""
    cells = table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) AS rowkey",
        "stack(3, 'cf', 'name', c_name, 'cf', 'segment', c_mktsegment, 'other', 'segment', 'x') "
        "AS (family, qualifier, value)")
    cells = cells.filter("NOT (family = 'cf' AND qualifier = 'segment' AND rowkey % 4 = 0)")
    return cells_to_rows(cells, "cf", ["rowkey", "name", "segment", "absent"])


@query("SELECT count(*) AS n FROM lineitem")
def src_count(spark, sf_dir):
    return source_count(table(spark, sf_dir, "lineitem"))


_PAGED = """
WITH n AS (SELECT count(*) AS total FROM orders),
r AS (SELECT o_orderkey, o_custkey,
             row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS row_index FROM orders),
s AS (SELECT i AS split, i * (total // 7) + least(i, total % 7) AS first,
             total // 7 + CASE WHEN i < total % 7 THEN 1 ELSE 0 END AS size
      FROM n, range(7) t(i))
SELECT s.split::INTEGER AS split, row_index::BIGINT AS row_index, o_orderkey, o_custkey
FROM r JOIN s ON row_index >= first{done} AND row_index < first + size
"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


@query(_PAGED.format(done=""))
def paged_scan(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    plan = offset_splits(source_count(orders).first()[0], 7)
    return read_slices(orders, ["o_custkey", "o_orderkey"], plan)


@query(_PAGED.format(done=" + 5 * s.split"))
def paged_resume(spark, sf_dir):
    """Slice i has already written 5 * i rows."""
    orders = _orders(spark, sf_dir)
    total = source_count(orders).first()[0]
    reached = [s.start + 5 * s.split for s in offset_splits(total, 7)]
    return read_slices(orders, ["o_custkey", "o_orderkey"], offset_splits(total, 7, reached))


@query(_PAGED.replace("ORDER BY o_custkey, o_orderkey", "ORDER BY o_orderkey").format(done=""))
def paged_files(spark, sf_dir):
    """Slices in the order of the rows in the files (they lie by o_orderkey)."""
    return read_file_slices(_orders(spark, sf_dir), 7)


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, "
       "o_orderdate::VARCHAR AS o_orderdate, o_orderpriority AS bytes, "
       "'[' || o_orderkey || ',' || o_custkey || ']' AS list, "
       "'{\"k\":' || o_custkey || '}' AS map, (o_orderkey % 2 = 0)::VARCHAR AS flag, "
       "NULL::VARCHAR AS nothing FROM orders")
def stringify(spark, sf_dir):
    return stringify_columns(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate",
        F.encode("o_orderpriority", "UTF-8").alias("bytes"),
        F.array("o_orderkey", "o_custkey").alias("list"),
        F.create_map(F.lit("k"), F.col("o_custkey")).alias("map"),
        (F.col("o_orderkey") % 2 == 0).alias("flag"), F.lit(None).cast("int").alias("nothing")))


@query("SELECT json_extract_string(props, '$.k') AS k, "
       "json_extract_string(props, '$.missing') AS missing FROM events")
def json_project(spark, sf_dir):
    return project_json(table(spark, sf_dir, "events"), "props", ["k", "missing", "k"])
