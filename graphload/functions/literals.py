"""Property values as literals of the statement language."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, is_numeric_id, jtrim, quote_text, unsentinel

# Target types.
TYPES = (
    "STRING", "FIXED_STRING", "BOOL",
    "INT8", "INT16", "INT32", "INT64", "VID",
    "FLOAT", "DOUBLE",
    "DATE", "TIME", "DATETIME", "TIMESTAMP",
    "GEOGRAPHY", "DURATION", "UNKNOWN",
)

# Target types written as a call around quoted text.
LITERAL_CALLS = {
    "DATE": "date",
    "DATETIME": "datetime",
    "TIME": "time",
    "TIMESTAMP": "timestamp",
    "GEOGRAPHY": "ST_GeogFromText",
}


def check_type(kind: str) -> str:
    name = kind.upper()
    if name not in TYPES:
        raise ValueError(f"unknown target type {kind!r}")
    return name


def render_literal(c: Column | str, kind: str, marker: str | None = None,
                   source_text: bool = True) -> Column:
    """Literal text of a value for its target type; NULL stays NULL.

    The type is known when the plan is built, so each property costs one
    expression and no per-row dispatch. ``source_text=False`` says the column
    is not text, so there is nothing to trim.
    """
    kind = check_type(kind)
    text = jtrim(_col(c), source_text)
    if kind in ("STRING", "FIXED_STRING"):
        return quote_text(unsentinel(text, marker))
    if kind in LITERAL_CALLS:
        call = F.concat(F.lit(LITERAL_CALLS[kind] + '("'), text, F.lit('")'))
        if kind == "TIMESTAMP":
            return F.when(is_numeric_id(text), text).otherwise(call)
        return call
    return text
