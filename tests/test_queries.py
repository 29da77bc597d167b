"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def db(data):
    connection = duckdb.connect()
    for name in os.listdir(data):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{data}/{name}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order)
             for r in rows]
    return sorted(clean, key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, data, db, name):
    frame = contract.queries()[name](spark, data)
    found = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(frame.columns) == sorted(columns)
    assert {c: KINDS[t] for c, t in frame.dtypes} == {c[0]: str(c[1]) for c in found.description}
    expected = ordered(columns, found.fetchall())
    assert ordered(frame.columns, map(tuple, frame.collect())) == expected
    assert expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
