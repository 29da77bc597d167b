"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphload.functions import (
    escape_text, geo_cells, jtrim, murmur64, parse_date, parse_datetime, parse_epoch, parse_time,
    parse_typed, parse_wkt, prefix_id, quote_text, render_literal, unsentinel, wrap_policy,
)

from .base import (
    query, sql_escape, sql_murmur, sql_quote, sql_signed, sql_trim, table,
)


@query(f"SELECT doc_id, md5({sql_trim('text')}) AS trimmed, "
       f"length({sql_trim('chr(9) || lang || chr(13) || chr(10)')}) AS n FROM documents", name="jtrim")
def jtrim_text(spark, sf_dir):
    padded = F.concat(F.lit("\t"), F.col("lang"), F.lit("\r\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(jtrim("text")).alias("trimmed"),
        F.length(jtrim(padded)).cast("bigint").alias("n"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang FROM documents", name="unsentinel")
def empty_marker(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", unsentinel("lang", "en").alias("lang"))


@query("SELECT c_custkey, 'c_' || c_custkey AS id, c_custkey::VARCHAR AS bare FROM customer", name="prefix_id")
def prefixed_id(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", prefix_id("c_custkey", "c").alias("id"),
        prefix_id("c_custkey", None).alias("bare"))


@query(f"SELECT doc_id, md5({sql_escape('text')}) AS escaped, md5({sql_quote('text')}) AS quoted "
       "FROM documents", name="escape_text")
def escape_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(escape_text("text")).alias("escaped"),
        F.md5(quote_text("text")).alias("quoted"))


@query(f"SELECT doc_id, {sql_signed(sql_murmur('text'))} AS hash FROM documents")
def murmur_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", murmur64("text").alias("hash"))


@query("SELECT o_orderkey, "
       "'date(\"' || strftime(o_orderdate, '%Y-%m-%d') || '\")' AS day, "
       "'datetime(\"' || o_orderdate || '\")' AS at, "
       "'time(\"' || strftime(o_orderdate, '%H:%M:%S') || '\")' AS clock, "
       "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR "
       "ELSE 'timestamp(\"' || o_orderdate || '\")' END AS stamp, "
       "'ST_GeogFromText(\"POINT(' || o_custkey || ' ' || o_orderkey || ')\")' AS place, "
       "o_custkey::VARCHAR AS num, (o_orderkey % 2 = 0)::VARCHAR AS flag, "
       "'\"' || o_orderpriority || '\"' AS word, "
       "CASE WHEN o_orderkey % 5 > 0 THEN '\"' || o_orderstatus || '\"' END AS maybe FROM orders")
def render_literals(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    even = F.col("o_orderkey") % 2 == 0
    point = F.concat(F.lit(" POINT("), F.col("o_custkey"), F.lit(" "), F.col("o_orderkey"),
                     F.lit(")\n"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        render_literal(day, "DATE").alias("day"),
        render_literal("o_orderdate", "DATETIME").alias("at"),
        render_literal(F.date_format("o_orderdate", "HH:mm:ss"), "TIME").alias("clock"),
        render_literal(F.when(even, F.col("o_orderkey").cast("string")).otherwise(
            F.col("o_orderdate").cast("string")), "TIMESTAMP").alias("stamp"),
        render_literal(point, "GEOGRAPHY").alias("place"),
        render_literal("o_custkey", "INT64").alias("num"),
        render_literal(even, "BOOL").alias("flag"),
        render_literal("o_orderpriority", "STRING").alias("word"),
        render_literal(F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")),
                       "FIXED_STRING").alias("maybe"))


@query("SELECT l_orderkey, l_linenumber, l_linenumber::TINYINT AS i8, l_linenumber::SMALLINT "
       "AS i16, l_suppkey::INTEGER AS i32, l_orderkey AS i64, l_quantity::FLOAT AS f32, "
       "l_extendedprice AS f64, l_returnflag = 'R' AS flag, l_linestatus AS word FROM lineitem", name="parse_typed")
def parse_types(spark, sf_dir):
    def padded(c):
        return F.concat(F.lit(" "), F.col(c).cast("string"), F.lit("\t"))
    flag = F.when(F.col("l_returnflag") == "R", F.lit(" TRUE")).otherwise(F.lit("false"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        parse_typed(padded("l_linenumber"), "INT8").alias("i8"),
        parse_typed(padded("l_linenumber"), "INT16").alias("i16"),
        parse_typed(padded("l_suppkey"), "INT32").alias("i32"),
        parse_typed(padded("l_orderkey"), "INT64").alias("i64"),
        parse_typed(padded("l_quantity"), "FLOAT").alias("f32"),
        parse_typed(padded("l_extendedprice"), "DOUBLE").alias("f64"),
        parse_typed(flag, "BOOL").alias("flag"),
        parse_typed(padded("l_linestatus"), "STRING").alias("word"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate::DATE END AS day "
       "FROM orders", name="parse_date")
def parse_dates(spark, sf_dir):
    """Written without leading zeros; every ninth value is not a date."""
    text = F.when(F.col("o_orderkey") % 9 > 0, F.date_format("o_orderdate", "yyyy-M-d")).otherwise(
        F.lit("soon"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_date(text, on_error="null").alias("day"))


@query("SELECT event_id, hour(ts)::TINYINT AS hour, minute(ts)::TINYINT AS minute, "
       "second(ts)::TINYINT AS sec, (event_id % 1000)::INTEGER AS microsec, "
       "((event_id % 1000) * 1000)::INTEGER AS strict_microsec FROM events", name="parse_time")
def parse_times(spark, sf_dir):
    text = F.concat(F.date_format("ts", "H:m:s"), F.lit("."),
                    F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", parse_time(text).alias("t"), parse_time(text, strict=True).alias("s"))
    return rows.select("event_id", "t.*", F.col("s.microsec").alias("strict_microsec"))


@query("SELECT event_id, year(ts)::SMALLINT AS year, month(ts)::TINYINT AS month, "
       "day(ts)::TINYINT AS day, hour(ts)::TINYINT AS hour, minute(ts)::TINYINT AS minute, "
       "second(ts)::TINYINT AS sec, 0 AS microsec, date_trunc('second', ts) AS exact FROM events", name="parse_datetime")
def parse_datetimes(spark, sf_dir):
    """Half of the values use a T between day and time, half a space."""
    sep = F.when(F.col("event_id") % 2 == 0, F.lit("T")).otherwise(F.lit(" "))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd"), sep, F.date_format("ts", "HH:mm:ss"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", parse_datetime(text).alias("t"),
        parse_datetime(text, strict=True).alias("exact"))
    return rows.select("event_id", "t.*", "exact")


@query("SELECT event_id, CASE WHEN event_id % 4 > 0 THEN user_id END AS epoch FROM events", name="parse_epoch")
def parse_epochs(spark, sf_dir):
    text = F.when(F.col("event_id") % 4 > 0, F.col("user_id").cast("string")).otherwise(
        F.col("ts").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", parse_epoch(text, on_error="null").alias("epoch"))


@query("SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'POINT' WHEN 1 THEN 'LINESTRING' "
       "WHEN 2 THEN 'POLYGON' END AS kind, "
       "CASE c_custkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 END::INTEGER AS rings, "
       "CASE c_custkey % 8 WHEN 0 THEN c_custkey + 0.5 WHEN 1 THEN c_custkey * 3 + 4 "
       "WHEN 2 THEN c_nationkey * 4.0 + 3 + c_custkey * 3.5 + 9 END::DOUBLE AS sum_x "
       "FROM customer", name="parse_wkt")
def parse_shapes(spark, sf_dir):
    """Points, lines, polygons with a hole, and texts that are none of these: another word, a
    ring that is open, one that is too short, a line of one position, a point of two."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    half = (k * 0.5).cast("string")
    kinds = [
        F.format_string("POINT(%d.5 8)", k),
        F.format_string("LINESTRING (%d 8, %d 73.23, %d 1)", k, k * 2, F.lit(4)),
        F.format_string("polygon((%d 1, %d 2, %d.0 3, 3 4, %d 1), (%d 1,  %s 2,9 1, %d 3 , %d 1))",
                        n, n, n, n, k, half, k, k),
        F.lit("CIRCLE(1 2)"),
        F.format_string("POLYGON((%d 0,1 1,2 2,%d 1))", k, k),
        F.format_string("POLYGON((%d 0,1 1,%d 0))", k, k),
        F.format_string("LINESTRING(%d 1)", k),
        F.format_string("POINT(%d 2, 3 4)", k),
    ]
    text = kinds[-1]
    for place, kind in enumerate(kinds[:-1]):
        text = F.when(k % 8 == place, kind).otherwise(text)
    shape = parse_wkt(text, on_error="null")
    total = F.aggregate(F.flatten("g.rings"), F.lit(0.0), lambda acc, p: acc + p["x"])
    return table(spark, sf_dir, "customer").select("c_custkey", shape.alias("g")).select(
        "c_custkey", F.col("g.kind").alias("kind"),
        F.when(F.col("g").isNotNull(), F.size("g.rings")).alias("rings"), total.alias("sum_x"))


@query("SELECT c_custkey, 'hash(\"' || c_name || '\")' AS hashed, "
       "'uuid(\"' || c_name || '\")' AS uuid FROM customer")
def render_policy(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", wrap_policy("c_name", "hash").alias("hashed"),
        wrap_policy("c_name", "uuid").alias("uuid"))


# The quadrant table, the turns and the projection of the published cell scheme.
# The scheme as SQL: direction, cube face, quadratic projection, and a
# fold over 30 Hilbert curve steps that carries (cell * 4 + orientation).
_CELLS = """
WITH c AS (SELECT radians((c_custkey * 37 % 1700) / 10.0 - 85) AS phi,
                  radians((c_custkey * 91 % 3600) / 10.0 - 180) AS theta FROM customer),
d AS (SELECT cos(theta) * cos(phi) AS x, sin(theta) * cos(phi) AS y, sin(phi) AS z FROM c),
a AS (SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN 0
                     WHEN abs(y) >= abs(z) THEN 1 ELSE 2 END AS axis FROM d),
f AS (SELECT *, axis + CASE WHEN [x, y, z][axis + 1] < 0 THEN 3 ELSE 0 END AS face FROM a),
uv AS (SELECT face, [y, -x, -x, z, z, -y][face + 1] / [x, y, z, x, y, z][face + 1] AS u,
              [z, z, -y, y, -x, -x][face + 1] / [x, y, z, x, y, z][face + 1] AS v FROM f),
st AS (SELECT face, CASE WHEN u >= 0 THEN 0.5 * sqrt(1 + 3 * u) ELSE 1 - 0.5 * sqrt(1 - 3 * u) END
              AS s, CASE WHEN v >= 0 THEN 0.5 * sqrt(1 + 3 * v) ELSE 1 - 0.5 * sqrt(1 - 3 * v) END
              AS t FROM uv),
ij AS (SELECT face, least(greatest(floor(s * 1073741824), 0), 1073741823)::BIGINT AS i,
              least(greatest(floor(t * 1073741824), 0), 1073741823)::BIGINT AS j FROM st),
leaf AS (SELECT list_reduce(
    list_concat([(face * 4 + face % 2)::UHUGEINT], list_transform(range(30), lambda k:
      (((i >> (29 - k)) & 1) * 2 + ((j >> (29 - k)) & 1))::UHUGEINT)),
    lambda acc, q: list_transform([[0,1,3,2, 0,3,1,2, 2,3,1,0, 2,1,3,0]
        [((acc % 4) * 4 + q)::INTEGER + 1]], lambda p:
      ((acc // 4) * 4 + p::UHUGEINT) * 4
      + xor((acc % 4)::INTEGER, [1, 0, 0, 3][p + 1])::UHUGEINT)[1]) // 4 * 2 + 1 AS id FROM ij)
SELECT level::INTEGER AS level, (CASE WHEN cell >= 9223372036854775808::UHUGEINT
         THEN cell::HUGEINT - 18446744073709551616::HUGEINT ELSE cell::HUGEINT END)::BIGINT AS cell,
       count(*) AS n
FROM (SELECT level, id // (1::UHUGEINT << (61 - 2 * level)::UHUGEINT)
                    * (1::UHUGEINT << (61 - 2 * level)::UHUGEINT)
                    + (1::UHUGEINT << (60 - 2 * level)::UHUGEINT) AS cell
      FROM leaf, range(10, 19) l(level))
GROUP BY ALL
"""


@query(_CELLS, name="geo_cells")
def geo_cell_counts(spark, sf_dir):
    """Customers, given coordinates, counted in the cells of levels 10 to 18."""
    key = F.col("c_custkey")
    cells = geo_cells((key * 37 % 1700) / 10 - 85, (key * 91 % 3600) / 10 - 180)
    rows = table(spark, sf_dir, "customer").select(F.posexplode(cells).alias("pos", "cell"))
    return (rows.groupBy((F.col("pos") + 10).alias("level"), "cell")
            .agg(F.count(F.lit(1)).alias("n")))
