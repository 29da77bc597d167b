"""Filters, keys, validity, de-duplication, expansion, batches, partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphload.functions import graph_part, is_numeric_id
from graphload.operators.prepare import (
    apply_filter, edge_problem, enforce, id_problem, project_properties, rank_problem,
    vertex_valid, with_composite_key,
)
from graphload.operators.rows import (
    assign_batches, both_directions, by_graph_part, by_measured_part, dedup_edges,
    dedup_vertices, repartition_to, with_existence_rows,
)
from graphload.sources import sql_source
from graphload.spec import EdgeSpec
from graphload.storage import write_once

from .base import PARTS, query, sql_part_int, sql_part_string, table


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
       "WHERE l_quantity > 30 AND l_returnflag = 'R'")
def filter_expr(spark, sf_dir):
    rows = apply_filter(table(spark, sf_dir, "lineitem"),
                        "l_quantity > 30 AND l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT l_orderkey, l_linenumber, concat_ws('_', l_orderkey::VARCHAR, "
       "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END, l_linenumber::VARCHAR) "
       "AS line_id, concat_ws('-', CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END) "
       "AS maybe FROM lineitem")
def composite_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"))
    rows = with_composite_key(rows, "_", ["l_orderkey", "flag", "l_linenumber"], "line_id")
    return with_composite_key(rows, "-", ["flag"], "maybe").drop("flag")


@query("SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def project_rename(spark, sf_dir):
    return project_properties(table(spark, sf_dir, "customer"), ["c_name", " ", "c_mktsegment"],
                              ["name", "unused", "segment"], ["c_custkey"])


_IDS = ("SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN NULL "
        "WHEN event_id % 7 = 0 THEN 'u' || user_id "
        "WHEN event_id % 5 = 0 THEN ' ' || user_id || chr(9) "
        "WHEN event_id % 3 = 0 THEN '-' || user_id "
        "WHEN event_id % 13 = 0 THEN user_id || '99999999999999999999' "
        "ELSE user_id::VARCHAR END AS raw FROM events")


def _ids(spark, sf_dir):
    user, event = F.col("user_id").cast("string"), F.col("event_id")
    raw = (F.when(event % 11 == 0, F.lit(None).cast("string"))
           .when(event % 7 == 0, F.concat(F.lit("u"), user))
           .when(event % 5 == 0, F.concat(F.lit(" "), user, F.lit("\t")))
           .when(event % 3 == 0, F.concat(F.lit("-"), user))
           .when(event % 13 == 0, F.concat(user, F.lit("99999999999999999999")))
           .otherwise(user))
    return table(spark, sf_dir, "events").select("event_id", "user_id", raw.alias("raw"))


_INTEGER = "try_cast(regexp_replace(raw, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS BIGINT)"


@query(f"WITH i AS ({_IDS}) SELECT event_id, raw IS NOT NULL AS text_ids, "
       f"raw IS NOT NULL AND {_INTEGER} IS NOT NULL AS int_ids, "
       "raw IS NOT NULL AS hashed_int_ids, FALSE AS hashed_text_ids, FALSE AS prefixed_int_ids, "
       "raw IS NOT NULL AS prefixed_hashed FROM i")
def valid_vertices(spark, sf_dir):
    return _ids(spark, sf_dir).select(
        "event_id",
        vertex_valid("raw", "STRING").alias("text_ids"),
        vertex_valid("raw", "INT").alias("int_ids"),
        vertex_valid("raw", "INT", "hash").alias("hashed_int_ids"),
        vertex_valid("raw", "STRING", "hash").alias("hashed_text_ids"),
        vertex_valid("raw", "INT", None, "p").alias("prefixed_int_ids"),
        vertex_valid("raw", "INT", "hash", "p").alias("prefixed_hashed"))


@query(f"WITH i AS ({_IDS}) SELECT event_id, "
       f"CASE WHEN raw IS NULL THEN 'source: missing' WHEN {_INTEGER} IS NULL "
       "THEN 'source: not an integer' WHEN event_id % 17 = 0 THEN 'rank: missing' "
       "END AS problem FROM i")
def valid_edges(spark, sf_dir):
    rows = _ids(spark, sf_dir).withColumn(
        "rank", F.when(F.col("event_id") % 17 != 0, F.col("event_id")))
    spec = EdgeSpec("seen", "raw", "user_id", "rank")
    return rows.select("event_id", edge_problem(spec, "INT").alias("problem"))


@query(f"WITH i AS ({_IDS}) SELECT event_id, raw IS NOT NULL AND {_INTEGER} IS NOT NULL "
       "AS valid FROM i")
def valid_rank(spark, sf_dir):
    return _ids(spark, sf_dir).select("event_id", rank_problem("raw").isNull().alias("valid"))


@query(f"WITH i AS ({_IDS}) SELECT event_id, regexp_full_match(raw, '-?[0-9]*') AS loose, "
       "regexp_full_match(raw, '-?[0-9]+') AS strict FROM i")
def is_numeric(spark, sf_dir):
    return _ids(spark, sf_dir).select("event_id", is_numeric_id("raw").alias("loose"),
                                      is_numeric_id("raw", strict=True).alias("strict"))


@query(f"WITH i AS ({_IDS}), p AS (SELECT CASE WHEN raw IS NULL THEN 'id: missing' "
       f"WHEN {_INTEGER} IS NULL THEN 'id: not an integer' END AS problem FROM i) "
       "SELECT coalesce(problem, 'valid') AS outcome, count(*) AS n FROM p GROUP BY 1")
def quarantine(spark, sf_dir):
    good, bad = enforce(_ids(spark, sf_dir), id_problem("raw", "INT"), "quarantine")
    outcome = good.select(F.lit("valid").alias("outcome")).unionByName(
        bad.select(F.col("problem").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, "
       "arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey", name="dedup_vertices")
def dedup_vertices_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return dedup_vertices(orders, "o_custkey", ["o_orderkey"])


@query("SELECT DISTINCT o_custkey FROM orders")
def dedup_vertices_any(spark, sf_dir):
    return dedup_vertices(table(spark, sf_dir, "orders"), "o_custkey").select("o_custkey")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem", name="dedup_edges")
def dedup_edges_plain(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    return dedup_edges(edges, "l_partkey", "l_suppkey")


@query("SELECT l_partkey, l_suppkey, l_linenumber, l_orderkey, l_returnflag FROM (SELECT *, "
       "row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_linenumber "
       "ORDER BY l_orderkey, l_returnflag) AS n FROM lineitem) WHERE n = 1")
def dedup_edges_ranked(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey", "l_returnflag")
    return dedup_edges(edges, "l_partkey", "l_suppkey", "l_linenumber", ["l_orderkey"])


@query("SELECT l_orderkey AS src, l_partkey AS dst, 12 AS edge_type, l_linenumber AS rank "
       "FROM lineitem UNION ALL SELECT l_partkey, l_orderkey, -12, l_linenumber FROM lineitem", name="both_directions")
def both_ways(spark, sf_dir):
    return both_directions(table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"),
        F.lit(12).alias("edge_type"), F.col("l_linenumber").alias("rank")))


@query("SELECT 7 AS prefix, c_custkey AS vid, NULL::VARCHAR AS name FROM customer "
       "UNION ALL SELECT 1, c_custkey, c_name FROM customer")
def existence_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vid"),
                                                   F.col("c_name").alias("name"))
    return with_existence_rows(rows, value_cols=["name"])


@query(f"WITH p AS (SELECT o_orderkey, {sql_part_int('o_custkey')} AS part, "
       "(o_orderkey // 5000)::INTEGER AS bucket FROM orders), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY part, bucket ORDER BY o_orderkey) - 1 "
       "AS n FROM p) SELECT o_orderkey, part, bucket, n // 100 AS batch_id, "
       "(n % 100)::INTEGER AS batch_pos FROM r", name="assign_batches")
def batch_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", graph_part("o_custkey", PARTS, "INT").alias("part"))
    return assign_batches(rows, 100, ["o_orderkey"], ["part"],
                          bucket=F.call_function("div", "o_orderkey", F.lit(5000)).cast("int"))


@query(f"SELECT l_orderkey - 20000 AS id, {sql_part_int('l_orderkey - 20000')} AS part "
       "FROM lineitem")
def part_int(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") - 20000).alias("id"),
        graph_part(F.col("l_orderkey") - 20000, PARTS, "INT").alias("part"))


_NAMES = ("SELECT c_name AS id FROM customer UNION ALL SELECT 'c' || c_custkey FROM customer "
          "UNION ALL SELECT 'c' || lpad(c_custkey::VARCHAR, 7, '0') FROM customer "
          "UNION ALL SELECT '北京' || o_orderkey FROM orders "
          "UNION ALL SELECT url FROM pages")


@query(f"WITH n AS ({_NAMES}) SELECT id, {sql_part_string('id')} AS part FROM n")
def part_string(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    ids = [customer.select(F.col("c_name").alias("id")),
           customer.select(F.concat(F.lit("c"), key).alias("id")),
           customer.select(F.concat(F.lit("c"), F.lpad(key, 7, "0")).alias("id")),
           table(spark, sf_dir, "orders").select(
               F.concat(F.lit("北京"), F.col("o_orderkey").cast("string")).alias("id")),
           table(spark, sf_dir, "pages").select(F.col("url").alias("id"))]
    rows = ids[0]
    for more in ids[1:]:
        rows = rows.unionByName(more)
    return rows.select("id", graph_part("id", PARTS, "STRING").alias("part"))


@query(f"SELECT {sql_part_int('l_orderkey')} AS part, ({sql_part_int('l_orderkey')} - 1) * 4 "
       "+ (l_partkey % 4)::INTEGER AS task, count(*) AS n FROM lineitem GROUP BY ALL")
def part_histogram(spark, sf_dir):
    """Rows per graph partition and the task that got them; four tasks share a partition."""
    rows = table(spark, sf_dir, "lineitem").select(
        graph_part("l_orderkey", PARTS, "INT").alias("part"), "l_partkey")
    routed = by_graph_part(rows, PARTS, splits=4, split=F.pmod("l_partkey", F.lit(4)))
    routed = routed.withColumn("task", F.spark_partition_id())
    return routed.groupBy("part", "task").agg(F.count(F.lit(1)).alias("n"))


_SKEWED = (f"SELECT CASE WHEN l_linenumber % 3 = 0 THEN 4 ELSE {sql_part_int('l_orderkey')} END "
           "AS part FROM lineitem")


@query(f"WITH r AS ({_SKEWED}), c AS (SELECT part, count(*) AS n FROM r GROUP BY part) "
       "SELECT part, n, greatest(1, ceil(n / ((sum(n) OVER ()) / 24.0::DOUBLE)))::BIGINT AS slots, "
       "TRUE AS even FROM c")
def part_slots(spark, sf_dir):
    """Rows routed by measured size, where one graph partition has a third of them: tasks of
    each graph partition, and whether none has twice the mean of all."""
    own = graph_part("l_orderkey", PARTS, "INT")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 == 0, 4).otherwise(own).alias("part"), "l_orderkey",
        "l_linenumber")
    tasks = by_measured_part(rows, 24).groupBy("part", F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"))
    # one row for each task
    tasks = write_once(tasks, name="tasks")
    mean = tasks.agg(F.avg("n")).first()[0]
    return tasks.groupBy("part").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("slots"),
        F.lit(tasks.agg(F.max("n")).first()[0] < 2 * mean).alias("even"))


@query("SELECT c_custkey::VARCHAR AS id, c_name FROM customer JOIN nation "
       "ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> 0")
def valid_sentence(spark, sf_dir):
    """A sentence that leaves out bad ids by a join, a semi join and HAVING; none of them stops it."""
    spoilt = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("bad"), F.col("c_custkey").cast("string")))
    rows = table(spark, sf_dir, "customer").select(
        F.coalesce(spoilt, F.col("c_custkey").cast("string")).alias("id"), "c_name", "c_nationkey")
    good = rows.filter("NOT id LIKE 'bad%'").select("id")
    found = sql_source(
        spark, "SELECT c.id, first(c_name) AS c_name FROM v_rows c JOIN v_nation n "
        "ON c_nationkey = n_nationkey WHERE c.id IN (SELECT id FROM v_good) GROUP BY c.id "
        "HAVING count(*) = 1",
        {"v_rows": rows, "v_good": good, "v_nation": table(spark, sf_dir, "nation")})
    return enforce(found, id_problem("id", "INT"), "fail", "id")


@query("SELECT count(*) AS n, 12::BIGINT AS tasks FROM lineitem")
def repartitioned(spark, sf_dir):
    """Rows dealt out to as many tasks as an entity asks for."""
    rows = repartition_to(table(spark, sf_dir, "lineitem"), 12)
    return rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("tasks"))
