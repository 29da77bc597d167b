from .geo import geo_cells, geo_source_id
from .hashing import graph_part, murmur64
from .keys import edge_key, existence_key, key_part, key_prefix, vertex_key
from .literals import render_literal
from .text import (
    escape_text,
    is_numeric_id,
    jtrim,
    prefix_id,
    quote_name,
    quote_text,
    unsentinel,
    wrap_policy,
)
from .typed import parse_date, parse_datetime, parse_epoch, parse_time, parse_typed, parse_wkt

__all__ = [
    "edge_key", "escape_text", "existence_key", "geo_cells", "geo_source_id",
    "graph_part", "is_numeric_id", "jtrim", "key_part", "key_prefix", "murmur64",
    "parse_date", "parse_datetime", "parse_epoch", "parse_time", "parse_typed",
    "parse_wkt", "prefix_id", "quote_name", "quote_text", "render_literal",
    "unsentinel", "vertex_key", "wrap_policy",
]
