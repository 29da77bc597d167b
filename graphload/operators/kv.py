"""Binary key/value rows and sorted key/value files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import graph_part
from ..functions.keys import EDGE, EXISTENCE, VERTEX, edge_key, existence_key, vertex_key
from ..functions.typed import parse_typed
from ..spec import EdgeSpec, GraphTarget, VertexSpec, bind_schema
from .rows import dedup
from .statements import id_value, rank_value

# Rows that a task sorts, some 200 MB of keys and values with what the sort needs.
ROWS_PER_TASK = 1_000_000


def typed_properties(schema: StructType, spec: VertexSpec | EdgeSpec, target: GraphTarget
                     ) -> Column:
    """Properties as a struct of typed values under their target names."""
    types = bind_schema(spec, target)
    fields = [parse_typed(f, types[t], target.empty_marker, source=schema[f].dataType).alias(t)
              for f, t in spec.properties]
    return F.struct(*fields) if fields else _no_properties()


def _no_properties() -> Column:
    """A struct needs a field; a NULL one is left out of the JSON value."""
    return F.struct(F.lit(None).cast("string").alias("none"))


def vertex_rows(df: DataFrame, spec: VertexSpec, target: GraphTarget) -> DataFrame:
    """(vid, props), typed."""
    return df.select(id_value(df.schema, spec.id, target, spec.policy, spec.prefix).alias("vid"),
                     typed_properties(df.schema, spec, target).alias("props"))


def edge_rows(df: DataFrame, spec: EdgeSpec, target: GraphTarget) -> DataFrame:
    """(src, dst, rank, props), typed; no rank column means rank 0."""
    rank = rank_value(df.schema, spec.rank) if spec.rank else F.lit(0).cast("bigint")
    return df.select(
        id_value(df.schema, spec.src, target, spec.src_policy, spec.src_prefix).alias("src"),
        id_value(df.schema, spec.dst, target, spec.dst_policy, spec.dst_prefix).alias("dst"),
        rank.alias("rank"), typed_properties(df.schema, spec, target).alias("props"))


def _unique(rows: DataFrame, keys: list[str], spec: VertexSpec | EdgeSpec) -> DataFrame:
    if spec.properties:
        return dedup(rows, keys, ["props"])
    # plain keys aggregate by hash, without the sort that structs need
    return rows.select(*keys).distinct().withColumn("props", _no_properties())


def vertex_kv(df: DataFrame, spec: VertexSpec, target: GraphTarget, existence: bool = False,
              unique: bool = True) -> DataFrame:
    """part, prefix, key, props of every vertex, one per id when ``unique``."""
    rows = vertex_rows(df, spec, target)
    if unique:
        rows = _unique(rows, ["vid"], spec)
    number = target.label(spec.label, "vertex").number
    rows = rows.withColumn("part", graph_part("vid", target.parts, target.id_type))
    key = vertex_key("part", "vid", target.id_len, number, target.id_type)
    if not existence:
        return rows.select("part", F.lit(VERTEX).alias("prefix"), key.alias("key"), "props")
    both = rows.withColumn("prefix", F.explode(F.array(F.lit(VERTEX), F.lit(EXISTENCE))))
    tagged = F.col("prefix") == VERTEX
    bare = existence_key("part", "vid", target.id_len, target.id_type)
    return both.select("part", "prefix", F.when(tagged, key).otherwise(bare).alias("key"),
                       F.when(tagged, F.col("props")).alias("props"))


def edge_kv(df: DataFrame, spec: EdgeSpec, target: GraphTarget, unique: bool = True) -> DataFrame:
    """part, prefix, key, props of every edge in both directions."""
    rows = edge_rows(df, spec, target)
    if unique:
        rows = _unique(rows, ["src", "dst", "rank"], spec)
    number = target.label(spec.label, "edge").number
    turned = F.col("way") < 0
    ways = rows.withColumn("way", F.explode(F.array(F.lit(1), F.lit(-1)))).select(
        F.when(turned, F.col("dst")).otherwise(F.col("src")).alias("near"),
        F.when(turned, F.col("src")).otherwise(F.col("dst")).alias("far"),
        (F.col("way") * number).alias("number"), "rank", "props")
    ways = ways.withColumn("part", graph_part("near", target.parts, target.id_type))
    return ways.select(
        "part", F.lit(EDGE).alias("prefix"),
        edge_key("part", "near", F.col("number"), "rank", "far", target.id_len,
                 target.id_type).alias("key"), "props")


def kv_value(props: Column | str) -> Column:
    """Typed properties as JSON bytes; no properties (existence rows) as no bytes."""
    props = F.col(props) if isinstance(props, str) else props
    return F.when(props.isNull(), F.lit(bytearray())).otherwise(
        F.to_json(props).cast("binary"))


def with_value(kv: DataFrame) -> DataFrame:
    return kv.select("part", "prefix", "key", kv_value("props").alias("value"))


def sort_kv(df: DataFrame, *before: str) -> DataFrame:
    """Sort inside each task by unsigned byte order of the key."""
    return df.sortWithinPartitions(*before, "key")


def sort_tasks(rows: int, least: int = 1) -> int:
    """Tasks (and ranges of files) for so many rows: their number grows, not their size."""
    return max(least, -(-rows // ROWS_PER_TASK))


def write_kv(kv: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists"
             ) -> None:
    """Sorted key/value files under ``path/part=<p>/prefix=<k>/``.

    Tasks take ranges of (part, prefix, key), so files of one part never
    overlap, a large part is written by many tasks and small parts share one.
    ``files`` is the number of ranges (``sort_tasks`` of the rows), by default the
    session's shuffle partitions. The values are built after the shuffle, from the narrower typed properties.
    """
    order = ["part", "prefix", "key"]
    ranged = kv.repartitionByRange(files, *order) if files else kv.repartitionByRange(*order)
    rows = with_value(ranged) if "props" in kv.columns else ranged
    (sort_kv(rows, "part", "prefix").write.mode(mode).partitionBy("part", "prefix").parquet(path))
