"""Literals and typed values of every target type."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphload.functions import (
    parse_date, parse_datetime, parse_epoch, parse_time, parse_typed, parse_wkt, render_literal,
)

MARKER = "_EMPTY"

# Fixed values, goldens that must match: (target type, source type, value, literal)
FOURTEEN = [
    ("STRING", "string", MARKER, '""'),
    ("FIXED_STRING", "string", "fixedBob", '"fixedBob"'),
    ("INT8", "smallint", 12, "12"),
    ("INT16", "smallint", 200, "200"),
    ("INT32", "int", 1000, "1000"),
    ("INT64", "bigint", 100000, "100000"),
    ("DATE", "string", "2021-01-01", 'date("2021-01-01")'),
    ("DATETIME", "string", "2021-01-01T12:00:00.100", 'datetime("2021-01-01T12:00:00.100")'),
    ("TIME", "string", "12:00:00.100", 'time("12:00:00.100")'),
    ("TIMESTAMP", "string", "345436232", "345436232"),
    ("BOOL", "boolean", True, "true"),
    ("DOUBLE", "double", 12.01, "12.01"),
    ("FLOAT", "double", 22.12, "22.12"),
    ("GEOGRAPHY", "string", "POINT(3 8)", 'ST_GeogFromText("POINT(3 8)")'),
]
MORE = [
    ("TIMESTAMP", "string", "2021-01-01T12:00:00", 'timestamp("2021-01-01T12:00:00")'),
    ("STRING", "string", " a\"b\n ", '"a\\"b"'),
    ("STRING", "string", None, None),
    ("DURATION", "string", " P1D ", "P1D"),
    ("GEOGRAPHY", "string", "LINESTRING(3 8, 4.7 73.23)",
     'ST_GeogFromText("LINESTRING(3 8, 4.7 73.23)")'),
]


@pytest.mark.parametrize("kind, source, value, literal", FOURTEEN + MORE)
def test_literals(one, kind, source, value, literal):
    assert one(render_literal("v", kind, MARKER), v=(value, source)) == literal
    if source != "string":
        assert one(render_literal("v", kind, MARKER, False), v=(value, source)) == literal


@pytest.mark.parametrize("kind, source, value, typed", [
    ("STRING", "string", MARKER, ""), ("STRING", "string", " Bob\t", "Bob"),
    ("FIXED_STRING", "string", "fixedBob", "fixedBob"),
    ("INT8", "smallint", 12, 12), ("INT16", "string", " 200 ", 200), ("INT32", "int", 1000, 1000),
    ("INT64", "string", "100000", 100000), ("VID", "string", "-7", -7),
    ("BOOL", "string", "True", True), ("BOOL", "string", "false", False),
    ("DOUBLE", "string", "12.01", 12.01), ("DOUBLE", "double", 22.12, 22.12),
    ("TIMESTAMP", "string", "345436232", 345436232),
    ("DATE", "string", "2021-01-01", datetime.date(2021, 1, 1)),
    ("DATE", "string", None, None), ("GEOGRAPHY", "string", None, None),
])
def test_typed_values(one, kind, source, value, typed):
    assert one(parse_typed("v", kind, MARKER), v=(value, source)) == typed


@pytest.mark.parametrize("kind, value", [
    ("INT8", "300"), ("INT32", "x"), ("BOOL", "yes"), ("DATE", "2021-01"), ("TIME", "12:00"),
    ("DATETIME", "2021-01-01"), ("DATETIME", "2021-01-01T12"), ("TIMESTAMP", "2021-01-01T12:00:00"),
    ("TIMESTAMP", "-"), ("GEOGRAPHY", "CIRCLE(1 2)"), ("GEOGRAPHY", "POINT(a b)"),
    ("GEOGRAPHY", "POLYGON((0 0,1 1,2 2))"), ("GEOGRAPHY", "LINESTRING(1 1)"),
    ("GEOGRAPHY", "POINT(1 2, 3 4)"), ("GEOGRAPHY", "POLYGON((0 0,1 1,0 0))"),
    ("GEOGRAPHY", "POLYGON((0 0,1 1,1 0,0 0),(5 5,6 6,7 7,5 6))"),
    ("DOUBLE", "1,5"), ("DATE", "2021-13-01"), ("DATE", "2021-xx-03"), ("DATE", "2021-02-29"),
    ("DATE", "2021-00-10"), ("TIME", "12:xx:00"), ("DATETIME", "2021-xx-01T1:2:3"),
    ("DATETIME", "2021-01-01 1:2:"), ("INT64", "1.0"), ("INT64", ""), ("BOOL", ""),
])
def test_bad_values_fail_or_become_null(one, kind, value):
    with pytest.raises(PySparkException):
        one(parse_typed("v", kind), v=(value, "string"))
    assert one(parse_typed("v", kind, on_error="null"), v=(value, "string")) is None


@pytest.mark.parametrize("kind", ["DURATION", "UNKNOWN", "nonsense"])
def test_types_without_a_stored_form(kind):
    with pytest.raises(ValueError):
        parse_typed(F.lit("x"), kind)


def test_fraction_digits_are_the_microseconds_as_written(one):
    assert tuple(one(parse_time("t"), t=("12:00:00.100", "string"))) == (12, 0, 0, 100)
    assert tuple(one(parse_time("t", strict=True), t=("12:00:00.100", "string"))) == (
        12, 0, 0, 100000)
    for text in ("2021-01-01T12:00:00.100", " 2021-01-01 12:00:00.100 "):
        assert tuple(one(parse_datetime("t"), t=(text, "string"))) == (2021, 1, 1, 12, 0, 0, 100)
        assert one(parse_datetime("t", strict=True), t=(text, "string")) == datetime.datetime(
            2021, 1, 1, 12, 0, 0, 100000)


def test_epoch(one):
    assert one(parse_epoch("t"), t=(" -5 ", "string")) == -5
    assert one(parse_date("t"), t=("2021-1-9", "string")) == datetime.date(2021, 1, 9)


@pytest.mark.parametrize("text, kind, rings", [
    ("POINT(3 8)", "POINT", [[(3, 8)]]),
    ("LINESTRING(3 8, 4.7 73.23)", "LINESTRING", [[(3, 8), (4.7, 73.23)]]),
    ("LINESTRING(1 2,2 4)", "LINESTRING", [[(1, 2), (2, 4)]]),
    ("POLYGON((0 1, 1 2, 2 3, 0 1))", "POLYGON", [[(0, 1), (1, 2), (2, 3), (0, 1)]]),
    ("POLYGON((1 2,2 4,3 5,5 6,1 2))", "POLYGON", [[(1, 2), (2, 4), (3, 5), (5, 6), (1, 2)]]),
    ("polygon ( (0 0,9 0,9 9,0 0) , (1 1,2 1,2 2,1 1) )", "POLYGON",
     [[(0, 0), (9, 0), (9, 9), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]),
    ("POINT (-1.5e2 +2)", "POINT", [[(-150, 2)]]),
])
def test_shapes(one, text, kind, rings):
    found = one(parse_wkt("t"), t=(text, "string"))
    assert found.kind == kind
    assert [[(p.x, p.y) for p in ring] for ring in found.rings] == rings


def test_bad_values_fail_without_ansi_too(spark, one):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for kind, value in [("INT8", "300"), ("DOUBLE", "x"), ("DATE", "2021-02-30")]:
            with pytest.raises(PySparkException, match="not a valid"):
                one(parse_typed("v", kind), v=(value, "string"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_dates_match_the_calendar(spark):
    texts = [f"{y}-{m}-{d}" for y in (1, 1900, 2000, 2021, 2024, 12021) for m in range(0, 14)
             for d in (0, 1, 28, 29, 30, 31, 32)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", parse_date("t", on_error="null").cast("string").alias("d")).collect()
    for row in rows:
        y, m, d = map(int, row.t.split("-"))
        try:
            datetime.date(2000 + y % 400, m, d)
            exists = True
        except ValueError:
            exists = False
        assert (row.d is not None) == exists, row
        if exists and y < 10000:
            assert row.d == f"{y:04}-{m:02}-{d:02}"


@pytest.mark.parametrize("kind, source, value, typed", [
    ("INT64", "int", 7, 7), ("INT32", "int", 7, 7), ("BOOL", "boolean", True, True),
    ("DOUBLE", "double", 1.5, 1.5), ("DATE", "date", datetime.date(2020, 1, 2),
                                     datetime.date(2020, 1, 2)),
    ("DOUBLE", "int", 3, 3.0), ("STRING", "int", 3, "3"), ("INT8", "bigint", -128, -128),
])
def test_known_source_types(spark, kind, source, value, typed):
    rows = spark.createDataFrame([(value,)], f"v {source}")
    as_typed = parse_typed("v", kind, source=rows.schema["v"].dataType)
    assert rows.select(as_typed).first()[0] == typed


@pytest.mark.parametrize("kind, source, value", [
    ("INT8", "bigint", 128), ("INT64", "double", 1.5), ("INT64", "boolean", True)])
def test_values_that_do_not_fit_their_type(spark, kind, source, value):
    rows = spark.createDataFrame([(value,)], f"v {source}")
    with pytest.raises(PySparkException, match="not a valid"):
        rows.select(parse_typed("v", kind, source=rows.schema["v"].dataType)).collect()
