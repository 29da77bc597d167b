"""Row positions that the files themselves give: no sort, no shuffle, no copy.

A row of a Parquet file has its number in the file, and the numbers of rows in files
come from their footers (a scan without columns). Files in the order of their paths
then give every row a position in the whole table, the same in every run as long as
the files stay, and slices of it are plain conditions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _col
from ..storage import write_once
from .slices import Slice, offset_splits, slice_of

# The table of files is broadcast, and named in conditions, up to so many (some 20 MB);
# beyond it Spark joins it by shuffle and opens every file for every slice.
FILES_TO_BROADCAST = 100_000

_PATH = "_metadata.file_path"
_PLACE = "_metadata.row_index"


@dataclass(frozen=True)
class Files:
    """(path, rows, first): the files of a table, ``first`` the position of the first row."""

    table: DataFrame
    total: int
    few: bool


def file_offsets(rows: DataFrame) -> Files:
    """Count the rows of each file of a Parquet scan; no column is read."""
    counts = rows.select(F.col(_PATH).alias("path")).groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"))
    # one row for each file, so this single-task window is as small as the list of files
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    table = write_once(counts.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0))),
                       name="files")
    seen = table.agg(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("files")).first()
    return Files(table, seen.total or 0, seen.files <= FILES_TO_BROADCAST)


def with_file_position(rows: DataFrame, files: Files | None = None,
                       ranges: list[Slice] | None = None) -> DataFrame:
    """``rows`` of a Parquet scan with ``row_index``, those in ``ranges`` only if given.

    Files outside of the ranges are not opened. The ranges are one condition each.
    """
    files = files or file_offsets(rows)
    table = files.table
    marked = rows.select("*", F.col(_PATH).alias("__path"), F.col(_PLACE).alias("__place"))
    if ranges is not None:
        first, last = F.col("first"), F.col("first") + F.col("rows") - 1
        meets = _any(ranges, lambda r: (first < r.start + r.size) & (last >= r.start))
        table = table.filter(meets)
        if files.few:
            names = [r.path for r in table.select("path").collect()]
            marked = rows.filter(F.col(_PATH).isin(names)).select(
                "*", F.col(_PATH).alias("__path"), F.col(_PLACE).alias("__place"))
    table = table.select(F.col("path").alias("__path"), F.col("first").alias("__first"))
    placed = marked.join(F.broadcast(table) if files.few else table, "__path").withColumn(
        "row_index", F.col("__first") + F.col("__place")).drop("__path", "__place", "__first")
    if ranges is None:
        return placed
    index = F.col("row_index")
    return placed.filter(_any(ranges, lambda r: (index >= r.start) & (index < r.start + r.size)))


def _any(ranges: list[Slice], condition) -> Column:
    found = F.lit(False)
    for r in ranges:
        if r.size:
            found = found | condition(r)
    return found


def read_file_slices(rows: DataFrame, parallel: int, reached: list[int] | None = None,
                     files: Files | None = None) -> DataFrame:
    """Rows of every slice of a Parquet scan: ``split``, the columns, ``row_index``.

    The slices are those of ``offset_splits`` over positions by file. An empty table has none.
    """
    files = files or file_offsets(rows)
    kept = [_col(c) for c in rows.columns]
    if not files.total:
        return rows.select(F.lit(0).alias("split"), *kept,
                           F.lit(0).cast("bigint").alias("row_index")).limit(0)
    slices = offset_splits(files.total, parallel, reached)
    split, _, _ = slice_of(F.col("row_index"), files.total, parallel)
    found = with_file_position(rows, files, None if reached is None else slices)
    return found.select(split.alias("split"), *kept, "row_index")
