"""Rows rendered as statements.

A row becomes one text fragment; a batch of fragments joined between a fixed
head and tail is a statement. Head, separator and tail depend only on the
entity, so they are known before the job starts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import check_id_type, graph_part, murmur64
from ..functions.literals import render_literal
from ..functions.text import (
    _col, clean_id, is_text, jtrim, quote_name, quote_text, wrap_policy,
)
from ..spec import EdgeSpec, GraphTarget, VertexSpec, bind_schema
from .prepare import required_fields
from .rows import batch_columns, can_sort, row_bucket, row_place

# Buckets of a graph partition where a caller names none.
BUCKETS = 64


@dataclass(frozen=True)
class Frame:
    """Fixed text around the fragments of a statement."""

    head: str = ""
    sep: str = ", "
    tail: str = ""

    def join(self, items: list[str]) -> str:
        return self.head + self.sep.join(items) + self.tail


def id_text(schema: StructType, name: str, target: GraphTarget, policy: str | None = None,
            prefix: str | None = None) -> Column:
    """Id as written in a statement."""
    text = clean_id(name, prefix, target.empty_marker, is_text(schema, name))
    if policy:
        return wrap_policy(text, policy)
    return quote_text(text) if check_id_type(target.id_type) == "STRING" else text


def _literals(schema: StructType, spec: VertexSpec | EdgeSpec, target: GraphTarget
              ) -> list[tuple[str, Column]]:
    """(target property, literal); NULL is written as the word null."""
    types = bind_schema(spec, target)
    return [(t, F.coalesce(render_literal(f, types[t], target.empty_marker, is_text(schema, f)),
                           F.lit("null")))
            for f, t in spec.properties]


def _joined(texts: list[Column], sep: str) -> Column:
    """Texts that are never NULL with a separator between; one flat concatenation."""
    parts = [part for text in texts for part in (F.lit(sep), text)]
    return F.concat(*parts[1:]) if parts else F.lit("")


def _values(literals: list[tuple[str, Column]]) -> Column:
    return _joined([value for _, value in literals], ", ")


def _assignments(literals: list[tuple[str, Column]]) -> Column:
    return _joined([F.concat(F.lit(quote_name(name) + "="), value) for name, value in literals],
                   ",")


def _insert_head(spec: VertexSpec | EdgeSpec) -> str:
    option = "IGNORE_EXISTED_INDEX " if spec.ignore_index else ""
    names = ",".join(quote_name(t) for _, t in spec.properties)
    return f"INSERT {spec.kind.upper()} {option}{quote_name(spec.label)}({names}) VALUES "


def _change(spec: VertexSpec | EdgeSpec, key: Column, literals) -> Column:
    start = f"{spec.mode.upper()} {spec.kind.upper()} ON {quote_name(spec.label)} "
    return F.concat(F.lit(start), key, F.lit(" SET "), _assignments(literals))


def statement_frame(spec: VertexSpec | EdgeSpec) -> Frame:
    if spec.mode == "insert":
        return Frame(_insert_head(spec))
    if spec.mode == "delete":
        if spec.kind == "edge":
            return Frame(f"DELETE EDGE {quote_name(spec.label)} ")
        return Frame("DELETE VERTEX ", tail=" WITH EDGE" if spec.delete_edge else "")
    return Frame(sep=";")


def _vertex_item(schema: StructType, spec: VertexSpec, target: GraphTarget) -> Column:
    vid = id_text(schema, spec.id, target, spec.policy, spec.prefix)
    if spec.mode == "delete":
        return vid
    literals = _literals(schema, spec, target)
    if spec.mode == "insert":
        return F.concat(vid, F.lit(": ("), _values(literals), F.lit(")"))
    return _change(spec, vid, literals)


def rank_value(schema: StructType, name: str) -> Column:
    return jtrim(name).cast("bigint") if is_text(schema, name) else _col(name).cast("bigint")


def _edge_item(schema: StructType, spec: EdgeSpec, target: GraphTarget) -> Column:
    src = id_text(schema, spec.src, target, spec.src_policy, spec.src_prefix)
    dst = id_text(schema, spec.dst, target, spec.dst_policy, spec.dst_prefix)
    ends = F.concat(src, F.lit("->"), dst)
    rank = rank_value(schema, spec.rank).cast("string") if spec.rank else None
    if spec.mode == "insert":
        key = ends if rank is None else F.concat(ends, F.lit("@"), rank)
        return F.concat(key, F.lit(": ("), _values(_literals(schema, spec, target)), F.lit(")"))
    # without a rank column these modes address rank 0
    key = F.concat(ends, F.lit("@"), F.lit("0") if rank is None else rank)
    return key if spec.mode == "delete" else _change(spec, key, _literals(schema, spec, target))


def item_of(df: DataFrame, spec: VertexSpec | EdgeSpec, target: GraphTarget) -> Column:
    """The fragment of a row of ``df``.

    A row without an id has no text; it stops the job rather than being left
    out when texts are joined.
    """
    make = _vertex_item if spec.kind == "vertex" else _edge_item
    stop = F.raise_error(F.lit(f"{spec.label}: a row without an id or rank")).cast("string")
    return F.coalesce(make(df.schema, spec, target), stop)


def render_items(df: DataFrame, spec: VertexSpec | EdgeSpec, target: GraphTarget) -> DataFrame:
    """One fragment per row in ``item``: the input of delivery, no shuffle."""
    return df.select(item_of(df, spec, target).alias("item"))


def join_batches(df: DataFrame, frame: Frame, keys: list[str]) -> DataFrame:
    """Fragments (``item``, ordered by ``batch_pos``) to one statement per batch.

    A group holds at most one batch, so it stays small whatever the skew.
    """
    ordered = F.array_sort(F.collect_list(F.struct("batch_pos", "item")))
    texts = F.transform(ordered, lambda e: e["item"])
    joined = F.concat(F.lit(frame.head), F.array_join(texts, frame.sep), F.lit(frame.tail))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), joined.alias("statement"))


def id_value(schema: StructType, name: str, target: GraphTarget, policy: str | None = None,
             prefix: str | None = None) -> Column:
    """Id as a value: text, or the integer it names or hashes to."""
    if policy == "uuid":
        raise ValueError("uuid ids are made by the database, not here")
    text = clean_id(name, prefix, target.empty_marker, is_text(schema, name))
    if policy == "hash":
        return murmur64(text)
    if target.id_type.upper() == "STRING":
        return text
    return text.cast("bigint") if is_text(schema, name) else _col(name).cast("bigint")


def _route_id(schema: StructType, spec: VertexSpec | EdgeSpec, target: GraphTarget) -> Column:
    """Value that picks the graph partition of a row."""
    if spec.kind == "vertex":
        name, policy, prefix = spec.id, spec.policy, spec.prefix
    else:
        name, policy, prefix = spec.src, spec.src_policy, spec.src_prefix
    # the database makes uuid ids; route by the text, as for any other hash
    return id_value(schema, name, target, "hash" if policy else None, prefix)


def render(df: DataFrame, spec: VertexSpec | EdgeSpec, target: GraphTarget, batch: int = 500,
           order_by: list[str] | None = None, buckets: int = BUCKETS,
           bucket: Column | None = None) -> DataFrame:
    """Statements of an entity: part, bucket, batch_id, n_rows, statement.

    Batches hold rows of one graph partition and bucket in ``order_by`` order (the
    entity key by default; the other columns break ties), whatever the physical layout
    of the input and the settings of the session. A row's bucket is a hash of the row,
    one of ``buckets``, or ``bucket``; a bucket is sorted by one task, so their number
    grows with the data. The one shuffle carries the source columns; text is made after.
    """
    order = list(dict.fromkeys((order_by or spec.key_fields) + required_fields(spec)))
    columns = [_col(c) for c in order]
    part = graph_part(_route_id(df.schema, spec, target), target.parts, target.id_type)
    if bucket is None:
        bucket = row_bucket(columns, buckets)
    keys = [part.alias("__part"), bucket.alias("__bucket")]
    routed = df.select(*columns, *keys)
    groups = [c for c in routed.columns if c not in order]
    # numbered in a step of its own: rendering stays above the window, after the shuffle
    placed = routed.withColumn("__place", row_place(
        [c for c in order if can_sort(df.schema, c)], groups))
    batch_id, batch_pos = batch_columns(F.col("__place"), batch)
    items = placed.select(*[F.col(g).alias(g[2:]) for g in groups], batch_id.alias("batch_id"),
                          batch_pos.alias("batch_pos"), item_of(df, spec, target).alias("item"))
    return join_batches(items, statement_frame(spec), [g[2:] for g in groups] + ["batch_id"])


def render_vertices(df: DataFrame, spec: VertexSpec, target: GraphTarget, **options) -> DataFrame:
    return render(df, spec, target, **options)


def render_edges(df: DataFrame, spec: EdgeSpec, target: GraphTarget, **options) -> DataFrame:
    return render(df, spec, target, **options)


def statement_rows(c: Column | str) -> Column:
    """Rows an insert statement carries."""
    c = _col(c)
    mark = ": ("
    return ((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)).cast("int")
