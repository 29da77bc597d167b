"""Property values parsed to Spark types for the key/value path.

``on_error="fail"`` stops the job at the first bad value, ``"null"`` yields
NULL for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .literals import check_type
from .text import _col, is_numeric_id, jtrim, unsentinel

# Target type -> Spark type of a plain cast.
CASTS = {
    "DOUBLE": "double",
    "FLOAT": "float",
    "INT8": "tinyint",
    "INT16": "smallint",
    "INT32": "int",
    "INT64": "bigint",
    "VID": "bigint",
}

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOGRAPHY = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("rings", T.ArrayType(T.ArrayType(POINT))),
])


def _fail(raw: Column, what: str, to: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a valid {what}: "), raw.cast("string"))).cast(to)


def _cast(c: Column, to: str, on_error: str) -> Column:
    """Cast that fails or yields NULL for a bad value, whatever the session's ANSI setting."""
    tried = c.try_cast(to)
    if on_error == "null":
        return tried
    return F.coalesce(tried, F.when(c.isNotNull(), _fail(c, to, to)))


def _require(ok: Column, value: Column, raw: Column, what: str, on_error: str) -> Column:
    """``value`` where ``ok``; NULL input stays NULL; otherwise error or NULL."""
    known = F.when(raw.isNull(), F.lit(None)).when(ok, value)
    return known if on_error == "null" else known.otherwise(_fail(raw, what, "void"))


def _all_known(fields: list[Column]) -> Column:
    known = F.lit(True)
    for field in fields:
        known = known & field.isNotNull()
    return known


def _field(parts: Column, index: int) -> Column:
    return F.get(parts, index)


def _clock(text: Column, on_error: str, strict: bool) -> tuple[Column, list[Column]]:
    """Validity and (hour, minute, sec, microsec) of ``h:m:s[.fraction]``.

    By default the fraction digits are the microsecond number as written
    (".100" is 100); ``strict`` reads them as a decimal fraction (100000).
    """
    parts = F.split(text, ":")
    seconds = F.split(_field(parts, 2), r"\.")
    digits = _field(seconds, 1)
    if strict:
        digits = F.rpad(digits, 6, "0")
    micro = F.when(F.size(seconds) == 2, _cast(digits, "int", on_error)).otherwise(F.lit(0))
    return F.size(parts) >= 3, [
        _cast(_field(parts, 0), "tinyint", on_error).alias("hour"),
        _cast(_field(parts, 1), "tinyint", on_error).alias("minute"),
        _cast(_field(seconds, 0), "tinyint", on_error).alias("sec"),
        micro.alias("microsec"),
    ]


def _day(text: Column, on_error: str) -> tuple[Column, list[Column]]:
    parts = F.split(text, "-")
    return F.size(parts) >= 3, [
        _cast(_field(parts, 0), "smallint", on_error).alias("year"),
        _cast(_field(parts, 1), "tinyint", on_error).alias("month"),
        _cast(_field(parts, 2), "tinyint", on_error).alias("day"),
    ]


def parse_time(c: Column | str, on_error: str = "fail", strict: bool = False) -> Column:
    text = jtrim(_col(c))
    ok, fields = _clock(text, on_error, strict)
    return _require(ok & _all_known(fields), F.struct(*fields), text, "time", on_error)


def parse_date(c: Column | str, on_error: str = "fail") -> Column:
    text = jtrim(_col(c))
    ok, (year, month, day) = _day(text, on_error)
    # a month or day that does not exist becomes NULL before the date is made
    month = F.when(month.between(1, 12), month)
    last = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    made = F.make_date(year, month, F.when(day.between(1, last), day))
    return _require(ok & made.isNotNull(), made, text, "date", on_error)


def parse_datetime(c: Column | str, on_error: str = "fail", strict: bool = False) -> Column:
    """``y-m-dTh:m:s[.fraction]`` or with a space.

    Returns a struct of the written numbers; with ``strict`` a TIMESTAMP_NTZ
    whose fraction is a real fraction of a second.
    """
    text = jtrim(_col(c))
    halves = F.when(text.contains("T"), F.split(text, "T")).otherwise(F.split(text, " "))
    ok_day, day = _day(_field(halves, 0), on_error)
    ok_clock, clock = _clock(_field(halves, 1), on_error, strict)
    ok = (F.size(halves) >= 2) & ok_day & ok_clock & _all_known([*day, *clock])
    if strict:
        year, month, dom = day
        hour, minute, sec, micro = clock
        seconds = (sec.cast("decimal(16,6)") + micro.cast("decimal(16,6)") / F.lit(1000000))
        value = F.try_make_timestamp_ntz(year, month, dom, hour, minute,
                                         seconds.cast("decimal(16,6)"))
        ok = ok & value.isNotNull()
    else:
        value = F.struct(*day, *clock)
    return _require(ok, value, text, "datetime", on_error)


def parse_epoch(c: Column | str, on_error: str = "fail") -> Column:
    """Integer seconds; anything else is an error."""
    text = jtrim(_col(c))
    value = text.try_cast("bigint")
    return _require(is_numeric_id(text, strict=True) & value.isNotNull(), value, text,
                    "timestamp number", on_error)


def parse_bool(c: Column | str, on_error: str = "fail") -> Column:
    """Only true and false, in any case; Spark's own cast takes more words."""
    text = F.lower(jtrim(_col(c)))
    return _require(text.isin("true", "false"), text == "true", text, "boolean", on_error)


def _points(text: Column) -> Column:
    """``x y, x y`` to an array of points; extra ordinates are ignored."""
    def point(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(xy, 0).try_cast("double").alias("x"),
                        F.get(xy, 1).try_cast("double").alias("y"))
    return F.transform(F.split(text, ","), point)


def parse_wkt(c: Column | str, on_error: str = "fail") -> Column:
    """POINT, LINESTRING and POLYGON (first ring is the shell, others holes).

    A point is one position, a line two or more, a ring four or more of which the
    last is the first again.
    """
    text = jtrim(_col(c))
    kind = F.upper(F.regexp_extract(text, r"(?i)\A(POINT|LINESTRING|POLYGON)\s*\(", 1))
    body = F.regexp_extract(text, r"(?s)\A\w+\s*\((.*)\)\z", 1)
    ring_texts = F.split(F.regexp_extract(body, r"(?s)\A\s*\((.*)\)\s*\z", 1), r"\)\s*,\s*\(")
    rings = F.when(kind == "POLYGON", F.transform(ring_texts, _points)).otherwise(
        F.array(_points(body)))
    good_point = lambda p: p["x"].isNotNull() & p["y"].isNotNull()
    first = F.get(rings, 0)
    closed = lambda ring: (F.size(ring) >= 4) & (F.get(ring, 0) == F.element_at(ring, -1))
    shaped = (F.when(kind == "POINT", F.size(first) == 1)
              .when(kind == "LINESTRING", F.size(first) >= 2)
              .otherwise(F.forall(rings, closed)))
    ok = ((kind != "") & F.forall(rings, lambda ring: F.forall(ring, good_point))
          & F.coalesce(shaped, F.lit(False)))
    value = F.struct(kind.alias("kind"), rings.alias("rings"))
    return _require(ok, value, text, "point, line or polygon text", on_error)


def parse_typed(c: Column | str, kind: str, marker: str | None = None, on_error: str = "fail",
                strict: bool = False, source: T.DataType | None = None) -> Column:
    """Value of a source column as its target type; NULL stays NULL.

    ``source`` is the type of the column where it is known: integers then go to
    integer types, and values to their own type, without a detour over text.
    """
    kind = check_type(kind)
    c = _col(c)
    text = source is None or isinstance(source, T.StringType)
    if kind in ("STRING", "FIXED_STRING"):
        return unsentinel(jtrim(c, text), marker if text else None)
    if kind in CASTS:
        if not text and source.simpleString() == CASTS[kind]:
            return c
        whole = isinstance(source, T.IntegralType) and kind not in ("FLOAT", "DOUBLE")
        return _cast(c if whole else jtrim(c, text), CASTS[kind], on_error)
    if kind == "BOOL":
        return c if isinstance(source, T.BooleanType) else parse_bool(c, on_error)
    if kind == "DATE":
        return c if isinstance(source, T.DateType) else parse_date(c, on_error)
    if kind == "TIME":
        return parse_time(c, on_error, strict)
    if kind == "DATETIME":
        return parse_datetime(c, on_error, strict)
    if kind == "TIMESTAMP":
        return parse_epoch(c, on_error)
    if kind == "GEOGRAPHY":
        return parse_wkt(c, on_error)
    raise ValueError(f"target type {kind} cannot be written as key/value data")
