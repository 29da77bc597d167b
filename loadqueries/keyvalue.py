"""Binary keys and key/value files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graphload.functions import key_part, key_prefix
from graphload.operators.kv import (
    edge_kv, sort_kv, sort_tasks, vertex_kv, with_value, write_kv,
)
from graphload.operators.publish import (
    current_set, publish_kv, read_kv, read_manifest, set_problems, sets_of,
)
from graphload.spec import EdgeSpec, VertexSpec
from graphload.storage import cut_lineage, scratch_path

from .base import (
    INT_GRAPH, PARTS, STRING_GRAPH, query, sql_big, sql_little, sql_part_int, sql_part_string,
    table,
)

_CUSTOMER = VertexSpec("customer", "c_custkey", ("c_name", "c_nationkey", "c_mktsegment"),
                       ("name", "nation", "segment"))
_VALUE = ("'{\"name\":\"' || c_name || '\",\"nation\":' || c_nationkey || ',\"segment\":\"' || "
          "c_mktsegment || '\"}'")


def _shown(kv):
    return kv.select("part", "prefix", F.lower(F.hex("key")).alias("key"),
                     F.col("value").cast("string").alias("value"))


def _head(part: str, kind: int) -> str:
    return sql_little(f"{part} * 256 + {kind}", 4)


@query(f"""
WITH c AS (SELECT *, {sql_part_int('c_custkey')} AS part FROM customer)
SELECT part, 1 AS prefix, {_head('part', 1)} || {sql_little('c_custkey', 8)} || '01000000' AS key,
       {_VALUE} AS value FROM c
UNION ALL
SELECT part, 7, {_head('part', 7)} || {sql_little('c_custkey', 8)}, '' FROM c
""")
def kv_vertices(spark, sf_dir):
    """Integer ids with existence rows."""
    return _shown(with_value(vertex_kv(table(spark, sf_dir, "customer"), _CUSTOMER, INT_GRAPH,
                                       existence=True)))


@query(f"""
WITH c AS (SELECT *, 'c_' || c_custkey AS vid FROM customer),
p AS (SELECT *, {sql_part_string('vid')} AS part FROM c)
SELECT part, 1 AS prefix, {_head('part', 1)} || rpad(lower(hex(vid)), 48, '0') || '01000000' AS key,
       {_VALUE} AS value FROM p
""")
def kv_vertices_text_ids(spark, sf_dir):
    spec = VertexSpec(_CUSTOMER.label, _CUSTOMER.id, _CUSTOMER.fields, _CUSTOMER.targets,
                      prefix="c")
    return _shown(with_value(vertex_kv(table(spark, sf_dir, "customer"), spec, STRING_GRAPH)))


# Consecutive rows of a file that are looked at together.
_RUN = 16384
_EDGE_SPEC = EdgeSpec("contains", "l_orderkey", "l_partkey", "l_linenumber", ("l_returnflag",),
                      ("flag",))
_EDGE_SQL = f"""
WITH e AS (SELECT l_orderkey AS src, l_partkey AS dst, l_linenumber AS rank,
                  min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
p AS (SELECT *, {sql_part_int('src')} AS sp, {sql_part_int('dst')} AS dp FROM e),
k AS (
SELECT sp AS part, 2 AS prefix, {_head('sp', 2)} || {sql_little('src', 8)} || {sql_little('12', 4)}
       || {sql_big('rank')} || {sql_little('dst', 8)} || '01' AS key,
       '{{"flag":"' || flag || '"}}' AS value FROM p
UNION ALL
SELECT dp, 2, {_head('dp', 2)} || {sql_little('dst', 8)} || {sql_little('-12', 4)}
       || {sql_big('rank')} || {sql_little('src', 8)} || '01',
       '{{"flag":"' || flag || '"}}' FROM p)
"""


@query(_EDGE_SQL + "SELECT part, prefix, key, value FROM k")
def kv_edges(spark, sf_dir):
    """Both directions of every line, one per (order, part, line number)."""
    return _shown(with_value(edge_kv(table(spark, sf_dir, "lineitem"), _EDGE_SPEC, INT_GRAPH)))


@query(f"""
WITH e AS (SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem),
p AS (SELECT *, {sql_part_int('src')} AS sp, {sql_part_int('dst')} AS dp FROM e)
SELECT sp AS part, 2 AS prefix, {_head('sp', 2)} || {sql_little('src', 8)} || {sql_little('13', 4)}
       || {sql_big('0')} || {sql_little('dst', 8)} || '01' AS key, '{{}}' AS value FROM p
UNION ALL
SELECT dp, 2, {_head('dp', 2)} || {sql_little('dst', 8)} || {sql_little('-13', 4)}
       || {sql_big('0')} || {sql_little('src', 8)} || '01', '{{}}' FROM p
""")
def kv_edges_bare(spark, sf_dir):
    """Edges without rank or properties, with many copies in the source."""
    spec = EdgeSpec("supplied_by", "l_partkey", "l_suppkey")
    return _shown(with_value(edge_kv(table(spark, sf_dir, "lineitem"), spec, INT_GRAPH)))


@query(f"SELECT {sql_part_int('c_custkey')} AS part, 1 AS prefix, count(*) AS n FROM customer "
       "GROUP BY ALL UNION ALL "
       f"SELECT {sql_part_int('c_custkey')}, 7, count(*) FROM customer GROUP BY ALL")
def keys_decoded(spark, sf_dir):
    kv = vertex_kv(table(spark, sf_dir, "customer"), _CUSTOMER, INT_GRAPH, existence=True)
    return kv.groupBy(key_part("key", PARTS).alias("part"), key_prefix("key").alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"))


@query(_EDGE_SQL + "SELECT part, prefix, count(*) AS n, min(key) AS first_key, max(key) AS last_key, "
       "sum(('0x' || substr(md5(key || value), 1, 8))::BIGINT)::BIGINT AS content, "
       "0::BIGINT AS out_of_order, 0::BIGINT AS overlaps FROM k GROUP BY part, prefix")
def kv_files(spark, sf_dir):
    """Edges written as sorted files, read back: size, key range and content of each part.

    No key comes before its predecessor in a file, no file begins before the one
    in front of it has ended.
    """
    path = scratch_path(spark, "kv")
    lines = table(spark, sf_dir, "lineitem")
    tasks = sort_tasks(2 * lines.count(), 6)
    write_kv(edge_kv(lines, _EDGE_SPEC, INT_GRAPH), path, tasks)
    return _file_checks(spark.read.parquet(path), tasks)


def _file_checks(rows, tasks):
    """Runs of rows of a file are looked at in about ``tasks`` tasks, then against each other."""
    run = ["part", "prefix", "file_path", "run"]
    rows = rows.select(
        "part", "prefix", F.lower(F.hex("key")).alias("key"), F.col("value").cast("string"),
        "_metadata.file_path", "_metadata.row_index",
        F.floor(F.col("_metadata.row_index") / _RUN).alias("run"))
    dealt = rows.repartition(tasks, "file_path", "run")
    before = F.lag("key").over(Window.partitionBy(*run).orderBy("row_index"))
    digest = F.conv(F.substring(F.md5(F.concat("key", "value")), 1, 8), 16, 10).cast("bigint")
    # the groups are those of the window, so its order serves for both
    runs = dealt.withColumn("before", before).groupBy(*run).agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"),
        F.sum(digest).alias("content"),
        F.sum((F.col("before") >= F.col("key")).cast("bigint")).alias("wrong"))

    def ended(groups, place):
        return F.max("last").over(Window.partitionBy(*groups).orderBy(place).rowsBetween(
            Window.unboundedPreceding, -1))

    late = F.coalesce((F.col("ended") >= F.col("first")).cast("bigint"), F.lit(0))
    files = runs.withColumn("ended", ended(run[:3], "run")).groupBy(*run[:3]).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum("content").alias("content"),
        F.sum(F.coalesce("wrong", F.lit(0)) + late).alias("wrong"))
    return files.withColumn("ended", ended(run[:2], "first")).groupBy("part", "prefix").agg(
        F.sum("n").alias("n"), F.min("first").alias("first_key"), F.max("last").alias("last_key"),
        F.sum("content").alias("content"), F.sum("wrong").alias("out_of_order"),
        F.sum(late).alias("overlaps"))


@query(_EDGE_SQL + "SELECT part, prefix, key, value, 0::BIGINT AS wrong FROM k")
def kv_sorted(spark, sf_dir):
    """Rows sorted in their tasks: none comes before its predecessor."""
    lines = table(spark, sf_dir, "lineitem")
    tasks = sort_tasks(2 * lines.count(), 5)
    rows = with_value(edge_kv(lines, _EDGE_SPEC, INT_GRAPH))
    placed = cut_lineage(sort_kv(rows.repartition(tasks, "key")).withColumn(
        "task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    # a task's rows are looked at in a task of their own
    placed = placed.repartitionById(tasks, "task")
    before = F.lag("key").over(Window.partitionBy("task").orderBy("place"))
    wrong = F.coalesce((before >= F.col("key")).cast("bigint"), F.lit(0))
    return placed.withColumn("wrong", wrong).select(
        "part", "prefix", F.lower(F.hex("key")).alias("key"),
        F.col("value").cast("string").alias("value"), "wrong")


@query(_EDGE_SQL + "SELECT part, prefix, count(*) AS rows, min(key) AS first_key, max(key) AS last_key, "
       "sum(('0x' || substr(md5(key || value), 1, 8))::BIGINT)::BIGINT AS content, "
       "2::BIGINT AS sets, 0::BIGINT AS problems FROM k GROUP BY part, prefix")
def kv_published(spark, sf_dir):
    """A set of half of the edges, a run that died before its manifest, and a whole set: what
    readers see, beside what the manifest says of the files."""
    path = scratch_path(spark, "published")
    lines = table(spark, sf_dir, "lineitem")
    n = lines.count()
    half, whole = sort_tasks(n, 4), sort_tasks(2 * n, 6)
    publish_kv(edge_kv(lines.filter("l_orderkey % 2 = 0"), _EDGE_SPEC, INT_GRAPH), path, "one",
               half)
    write_kv(edge_kv(lines.filter("l_orderkey % 2 = 1"), _EDGE_SPEC, INT_GRAPH),
             f"{path}/run=died", half)
    publish_kv(edge_kv(lines, _EDGE_SPEC, INT_GRAPH), path, "two", whole)
    now = current_set(spark, path)
    said = read_manifest(spark, now).groupBy("part", "prefix").agg(
        F.sum("rows").alias("rows"), F.lower(F.hex(F.min("first_key"))).alias("first_key"),
        F.lower(F.hex(F.max("last_key"))).alias("last_key"))
    digest = F.conv(F.substring(F.md5(F.concat(F.lower(F.hex("key")), F.col("value").cast("string"))),
                                1, 8), 16, 10).cast("bigint")
    seen = read_kv(spark, path).groupBy("part", "prefix").agg(F.sum(digest).alias("content"))
    return said.join(seen, ["part", "prefix"]).withColumns({
        "sets": F.lit(len(sets_of(spark, path))).cast("bigint"),
        "problems": F.lit(set_problems(spark, now).count()).cast("bigint")})
