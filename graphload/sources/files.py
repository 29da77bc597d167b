"""File sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A character no field holds, so that no text is taken for NULL: a quoted empty
# field reads as "" and an unquoted one as NULL.
NO_NULL_TEXT = "\0"


def read_file(spark: SparkSession, kind: str, path: str, partition_spec: str | None = None,
              schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet, ORC or JSON lines. ``partition_spec`` such as ``dt='x'`` prunes folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.format(kind).load(path)
    return df if partition_spec is None else df.filter(partition_spec.replace("/", " AND "))


# Lines of JSON whose types are taken for those of all lines.
SAMPLE_LINES = 500
_CORRUPT = "__corrupt"


def read_json_sampled(spark: SparkSession, path: str, fields: list[str],
                      partition_spec: str | None = None, lines: int = SAMPLE_LINES) -> DataFrame:
    """``fields`` of JSON lines, with the types of the first ``lines`` lines.

    Only those are read twice. A field that they do not have is text. A whole JSON line with
    a value of another type raises when one of its fields is used; a line that is no JSON
    gives NULLs, as without types.
    """
    first = spark.read.text(path).filter(F.length("value") > 0).select("value").limit(lines)
    seen = spark.read.json(spark.sparkContext.parallelize([r.value for r in first.collect()], 1)
                           ).schema
    kinds = {f.name: f.dataType for f in seen}
    schema = T.StructType([T.StructField(f, kinds.get(f, T.StringType())) for f in fields]
                          + [T.StructField(_CORRUPT, T.StringType())])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    if partition_spec is not None:
        rows = rows.filter(partition_spec.replace("/", " AND "))
    other = F.col(_CORRUPT).isNotNull() & F.try_parse_json(_CORRUPT).isNotNull()
    stop = F.raise_error(F.concat(
        F.lit('a value is not of the type that the first lines show; name a schema, "text" or '
              '"infer": '), F.substring(_CORRUPT, 1, 200)))
    return rows.select(*[F.when(other, stop.cast(schema[f].dataType)).otherwise(
        F.col(f"`{f}`")).alias(f) for f in fields])


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = False,
             partition_spec: str | None = None) -> DataFrame:
    """Delimited text, every column a string; without header columns are _c0, _c1, ..."""
    df = (spark.read.option("sep", sep).option("header", header)
          .option("nullValue", NO_NULL_TEXT).option("emptyValue", "").csv(path))
    return df if partition_spec is None else df.filter(partition_spec.replace("/", " AND "))


def read_lines(spark: SparkSession, path: str, parse: dict[str, Column] | Callable,
               predicate: Column | str | None = None,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Text lines to rows. ``parse`` maps a column name to an expression on ``value``.

    Where expressions cannot say it, ``parse`` is a function over Arrow batches
    of lines that yields batches of ``schema``. Blank lines are dropped first;
    ``predicate`` filters the parsed rows.
    """
    lines = spark.read.text(path).filter(F.length("value") > 0)
    if callable(parse):
        rows = lines.mapInArrow(parse, schema)
        return rows if predicate is None else rows.filter(predicate)
    columns = [c.alias(name) if schema is None
               else c.cast(schema[name].dataType).alias(name) for name, c in parse.items()]
    rows = lines.select(*columns)
    return rows if predicate is None else rows.filter(predicate)


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """Saved statements, one per line."""
    return (spark.read.option("recursiveFileLookup", True).text(path, lineSep="\n")
            .select(F.col("value").alias("statement")).filter(F.length("statement") > 0))
