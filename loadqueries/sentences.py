"""Joins, aggregates, windows and set operations written as SQL sentences."""

from __future__ import annotations

from graphload.sources import sql_source

from .base import query, table


def _run(spark, sf_dir, sentence, *names):
    return sql_source(spark, sentence, {n: table(spark, sf_dir, n) for n in names})


_INNER = """
SELECT n_name, o_orderpriority, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority
"""


@query(_INNER)
def sql_join_inner(spark, sf_dir):
    return _run(spark, sf_dir, _INNER, "orders", "customer", "nation")


_LEFT = """
SELECT c_custkey, coalesce(n, 0) AS orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o
ON c_custkey = o_custkey
"""


@query(_LEFT)
def sql_join_left(spark, sf_dir):
    return _run(spark, sf_dir, _LEFT, "orders", "customer")


_SEMI = """
SELECT 'buyer' AS kind, c_custkey FROM customer WHERE EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL
SELECT 'idle' AS kind, c_custkey FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
"""


@query(_SEMI)
def sql_join_semi_anti(spark, sf_dir):
    return _run(spark, sf_dir, _SEMI, "orders", "customer")


# Bands of growing width, one per nation, so a customer falls into at most one.
_BANDS = ("SELECT n_nationkey, n_nationkey * n_nationkey * 20 - 1000 AS lo, "
          "(n_nationkey + 1) * (n_nationkey + 1) * 20 - 1000 AS hi FROM nation")


@query(f"SELECT c_custkey, n_nationkey AS band FROM customer JOIN ({_BANDS}) b "
       "ON c_acctbal >= lo AND c_acctbal < hi")
def sql_join_range(spark, sf_dir):
    """A range join as an equi-join on 500-wide bins plus the range test."""
    return _run(spark, sf_dir, f"""
        WITH bands AS ({_BANDS}),
        bins AS (SELECT *, explode(sequence(floor(lo / 500), floor(hi / 500))) AS bin FROM bands)
        SELECT c_custkey, n_nationkey AS band
        FROM customer JOIN bins ON floor(c_acctbal / 500) = bin
        WHERE c_acctbal >= lo AND c_acctbal < hi""", "customer", "nation")


_AGG = """
SELECT l_returnflag, l_linestatus, count(*) AS lines, count(DISTINCT l_suppkey) AS suppliers,
       sum(CAST(l_quantity AS BIGINT)) AS quantity, min(l_shipdate) AS first_shipped
FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10
"""


@query("SELECT l_returnflag, l_linestatus, lines, suppliers, quantity::BIGINT AS quantity, "
       f"first_shipped FROM ({_AGG})")
def sql_agg(spark, sf_dir):
    return _run(spark, sf_dir, _AGG, "lineitem")


_ROLLUP = """
SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g1, grouping(l_linestatus) AS g2,
       count(*) AS lines
FROM lineitem GROUP BY {how}
"""
_ROLLUP_ORACLE = ("SELECT l_returnflag, l_linestatus, g1::TINYINT AS g1, g2::TINYINT AS g2, lines "
                  "FROM ({sql})")


@query(_ROLLUP_ORACLE.format(sql=_ROLLUP.format(how="ROLLUP (l_returnflag, l_linestatus)")))
def sql_rollup(spark, sf_dir):
    return _run(spark, sf_dir, _ROLLUP.format(how="ROLLUP (l_returnflag, l_linestatus)"),
                "lineitem")


@query(_ROLLUP_ORACLE.format(sql=_ROLLUP.format(how="CUBE (l_returnflag, l_linestatus)")))
def sql_cube(spark, sf_dir):
    return _run(spark, sf_dir, _ROLLUP.format(how="CUBE (l_returnflag, l_linestatus)"),
                "lineitem")


_WINDOW = """
SELECT o_custkey, o_orderkey, place FROM (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
  FROM orders) r
WHERE place <= 3
"""


@query(f"SELECT o_custkey, o_orderkey, place::INTEGER AS place FROM ({_WINDOW})")
def sql_window(spark, sf_dir):
    """First orders of a customer; Spark keeps three per customer before the shuffle."""
    return _run(spark, sf_dir, _WINDOW, "orders")


_FRAME = """
WITH m AS (SELECT o_orderstatus, year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n
           FROM orders GROUP BY o_orderstatus, year(o_orderdate), month(o_orderdate))
SELECT o_orderstatus, y, m, n,
       sum(n) OVER (PARTITION BY o_orderstatus ORDER BY y, m
                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last3,
       lag(n) OVER (PARTITION BY o_orderstatus ORDER BY y, m) AS before
FROM m
"""


@query("SELECT o_orderstatus, y::INTEGER AS y, m::INTEGER AS m, n, last3::BIGINT AS last3, before "
       f"FROM ({_FRAME})")
def sql_window_frame(spark, sf_dir):
    """Moving sums over months, which are few after the aggregate."""
    return _run(spark, sf_dir, _FRAME, "orders")


_TOPK = "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"


@query(_TOPK)
def sql_topk(spark, sf_dir):
    return _run(spark, sf_dir, _TOPK, "orders")


_SETOPS = """
SELECT 'both' AS kind, k FROM (SELECT c_nationkey AS k FROM customer
  INTERSECT SELECT s_nationkey FROM supplier) a
UNION ALL
SELECT 'customers only' AS kind, k FROM (SELECT c_nationkey AS k FROM customer
  EXCEPT SELECT s_nationkey FROM supplier) b
UNION
SELECT 'nation' AS kind, n_nationkey AS k FROM nation
"""


@query(_SETOPS)
def sql_setops(spark, sf_dir):
    return _run(spark, sf_dir, _SETOPS, "customer", "supplier", "nation")
