"""Row-level work: de-duplication, expansion, batch numbers, partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import _col


def dedup(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key.

    Both forms are aggregates with a map-side step, so each task sends at most
    one row per key and a hot key does not gather its copies in one place.
    With ``order_by`` the smallest row in that order survives (remaining
    columns break ties); without, any.
    """
    if order_by is None:
        return df.dropDuplicates(keys)
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return df.dropDuplicates(keys)
    best = df.groupBy(*map(_col, keys)).agg(F.min(F.struct(*map(_col, rest))).alias("__best"))
    return best.select(*[_col(c) if c in keys else F.col("__best").getField(c).alias(c)
                         for c in df.columns])


def dedup_vertices(df: DataFrame, id: str, order_by: list[str] | None = None) -> DataFrame:
    return dedup(df, [id], order_by)


def dedup_edges(df: DataFrame, src: str, dst: str, rank: str | None = None,
                order_by: list[str] | None = None) -> DataFrame:
    return dedup(df, [src, dst] + ([rank] if rank else []), order_by)


def both_directions(edges: DataFrame, src: str = "src", dst: str = "dst",
                    edge_type: str = "edge_type") -> DataFrame:
    """Each edge as an out-row and an in-row (ends swapped, type negated), in one scan."""
    others = [c for c in edges.columns if c not in (src, dst, edge_type)]

    def row(a: str, b: str, kind: Column) -> Column:
        return F.struct(_col(a).alias(src), _col(b).alias(dst), kind.alias(edge_type),
                        *[_col(c) for c in others])

    return edges.select(F.inline(F.array(row(src, dst, _col(edge_type)),
                                         row(dst, src, -_col(edge_type)))))


def with_existence_rows(df: DataFrame, kind: str = "prefix", existence: int = 7, tag: int = 1,
                        value_cols: list[str] | None = None) -> DataFrame:
    """Each vertex as an existence row (no values) and a tag row, in one scan."""
    values = value_cols or []
    ids = [c for c in df.columns if c not in values]

    def row(number: int, filled: bool) -> Column:
        return F.struct(
            F.lit(number).alias(kind), *[_col(c) for c in ids],
            *[(_col(c) if filled else F.lit(None).cast(df.schema[c].dataType)).alias(c)
              for c in values])

    return df.select(F.inline(F.array(row(existence, False), row(tag, True))))


def row_bucket(columns: list[Column], buckets: int) -> Column:
    """Bucket 0..buckets-1 from a hash of the whole row.

    Rows that share an id but differ elsewhere spread over the buckets.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def can_sort(schema: StructType, name: str) -> bool:
    return schema[name].dataType.typeName() not in ("map", "variant")


def row_place(order_by: list[Column | str], keys: list[Column | str]) -> Column:
    """0-based place of a row in its group, a bigint."""
    window = Window.partitionBy(*[_col(c) for c in keys]).orderBy(*[_col(c) for c in order_by])
    return F.count(F.lit(1)).over(window.rowsBetween(Window.unboundedPreceding, 0)) - 1


def batch_columns(place: Column, batch: int) -> tuple[Column, Column]:
    """Number of the batch a place is in, and the 0-based place there."""
    if batch <= 0:
        raise ValueError("batch must be positive")
    return F.call_function("div", place, F.lit(batch)), (place % batch).cast("int")


def assign_batches(df: DataFrame, batch: int, order_by: list[Column | str],
                   partition_by: list[Column | str], buckets: int = 1,
                   bucket: Column | None = None) -> DataFrame:
    """Consecutive groups of ``batch`` rows inside a group of ``partition_by``.

    Adds ``batch_id`` and ``batch_pos`` (0-based). A graph has few partitions,
    so grouping by them alone would leave most tasks idle and one hot partition
    with a third of the rows. ``buckets`` splits each group (column ``bucket``,
    by row hash unless ``bucket`` says how); the window then sorts one bucket at
    a time, and grouping by (partition, bucket, batch) needs no second shuffle.
    """
    if bucket is None:
        bucket = row_bucket([_col(c) for c in df.columns], buckets)
    df = df.withColumn("bucket", bucket)
    keys = [*partition_by, "bucket"]
    batch_id, batch_pos = batch_columns(F.col("__place"), batch)
    return (df.withColumn("__place", row_place(order_by, keys))
            .withColumns({"batch_id": batch_id, "batch_pos": batch_pos}).drop("__place"))


def repartition_to(df: DataFrame, n: int, resumable: bool = False) -> DataFrame:
    """Spread rows over ``n`` tasks; streams, ``n`` <= 0 and resumable scans stay as read."""
    return df if df.isStreaming or n <= 0 or resumable else df.repartition(n)


def by_graph_part(df: DataFrame, n: int, part: str = "part", splits: int = 1,
                  split: Column | None = None) -> DataFrame:
    """Route rows to Spark partition = graph partition - 1.

    With ``splits`` > 1 every graph partition takes that many consecutive Spark
    partitions, chosen by a hash of the row, so a hot graph partition is shared.
    """
    slot = _col(part) - 1
    if splits > 1:
        inner = row_bucket([_col(c) for c in df.columns], splits) if split is None else split
        slot = slot * splits + inner
    return df.repartitionById(n * splits, slot.cast("int"))


@dataclass(frozen=True)
class Slots:
    """Which Spark partitions a graph partition has: ``count`` from ``first`` on."""

    first: int
    count: int


def part_histogram(df: DataFrame, part: str = "part") -> dict[int, int]:
    """Rows of each graph partition; a graph has few, whatever the data."""
    counted = df.groupBy(_col(part).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return {row.p: row.n for row in counted.collect()}


def slot_table(histogram: dict[int, int], tasks: int) -> dict[int, Slots]:
    """Deal about ``tasks`` Spark partitions out so that none has many more rows than another.

    A graph partition with more than its share (all rows / tasks) is split into as many as
    it fills; the others keep one each. So there are ``tasks`` + graph partitions at most,
    and with as many tasks as graph partitions no slot has twice the mean.
    """
    if tasks <= 0:
        raise ValueError("the number of tasks must be positive")
    share = max(1.0, sum(histogram.values()) / tasks)
    table, first = {}, 0
    for part in sorted(histogram):
        count = max(1, -int(-histogram[part] // share))
        table[part] = Slots(first, count)
        first += count
    return table


def by_measured_part(df: DataFrame, tasks: int, part: str = "part",
                     split: Column | None = None) -> DataFrame:
    """Route rows to Spark partitions of one graph partition each, hot ones to several.

    The sizes are counted first (one aggregate over ``part``), so only graph partitions that
    need it are split, by ``split`` or a hash of the row. Repeated rows go together; give a
    ``split`` where one row makes up most of a graph partition. Without rows nothing moves.
    A null ``part`` is a graph partition of its own.
    """
    marked = df.withColumn("__part", F.coalesce(_col(part).cast("bigint"), F.lit(-1)))
    table = slot_table(part_histogram(marked, "__part"), tasks)
    if not table:
        return df
    key = split if split is not None else F.xxhash64(*[_col(c) for c in df.columns])
    # one entry for each graph partition
    entries = [x for p, s in table.items()
               for x in (F.lit(p).cast("bigint"), F.struct(F.lit(s.first), F.lit(s.count)))]
    own = F.create_map(*entries)[F.col("__part")]
    total = sum(s.count for s in table.values())
    slot = own["col1"] + F.pmod(key, own["col2"])
    return marked.repartitionById(total, slot.cast("int")).drop("__part")
