"""Odd-shaped inputs to flat text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cells_to_rows(cells: DataFrame, family: str, fields: list[str], rowkey: str = "rowkey",
                  qualifier: str = "qualifier", value: str = "value",
                  version: str | None = None) -> DataFrame:
    """Wide-column cells to one text row per row key.

    ``cells`` has rowkey, family, qualifier, value. A field named rowkey (any
    case) is the key itself; a cell a row lacks is NULL. Of several values of a cell
    the one with the largest ``version`` counts (the largest text, without one or
    where versions are equal). The aggregate combines
    map-side, so a row key with many cells sends one partial row per task.
    """
    wanted = [f for f in dict.fromkeys(fields) if f.lower() != "rowkey"]
    kept = cells.filter((F.col("family") == family) & F.col(qualifier).isin(wanted))
    text = F.col(value).cast("string")

    def newest(f: str) -> Column:
        here = F.col(qualifier) == f
        if version is None:
            return F.max(F.when(here, text)).alias(f)
        return F.max(F.when(here, F.struct(F.col(version).alias("v"), text.alias("t"))))["t"].alias(f)

    cell = [newest(f) for f in wanted]
    if not wanted:
        rows = cells.select(F.col(rowkey).cast("string").alias("__key")).distinct()
    else:
        rows = kept.groupBy(F.col(rowkey).cast("string").alias("__key")).agg(*cell)
    return rows.select(*[F.col("__key").alias(f) if f.lower() == "rowkey" else F.col(f)
                         for f in dict.fromkeys(fields)])


def stringify_columns(df: DataFrame) -> DataFrame:
    """Every column as text; nested values as JSON, bytes as UTF-8, NULL stays NULL."""
    def text(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(field.dataType, T.BinaryType):
            c = F.decode(c, "UTF-8")
        return c.cast("string").alias(field.name)
    return df.select(*[text(f) for f in df.schema.fields])


def project_json(df: DataFrame, col: str, fields: list[str]) -> DataFrame:
    """Named keys of a JSON object as text columns; a missing key is NULL."""
    names = list(dict.fromkeys(fields))
    return df.select(F.json_tuple(col, *names).alias(*names))
