"""Reading a source described by a dict."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from .files import read_csv, read_file, read_json_sampled
from .jdbc import PRESETS, jdbc_url, read_jdbc
from .shapes import cells_to_rows
from .sql import sql_source
from .streams import read_stream

Reader = Callable[[SparkSession, dict, list[str]], "DataFrame | None"]

_custom: dict[str, Reader] = {}


def register_source(name: str, reader: Reader) -> None:
    """Add a source type: ``reader(spark, spec, fields)`` gives rows, or None for nothing."""
    _custom[name.lower()] = reader


def _file(spark, spec, fields):
    return read_file(spark, spec["type"].lower(), spec["path"], spec.get("partition_spec"),
                     spec.get("schema"))


def _json(spark, spec, fields):
    """JSON lines in one pass over the data.

    The needed fields have the types that the first lines show; a line that does not fit
    them stops the job where one of its fields is used. ``"schema": "text"`` takes the fields
    as texts (a key that occurs nowhere is then NULL), ``"schema": "infer"`` finds types that
    hold for all lines, with a pass of its own; so does a read that names no fields.
    """
    schema = spec.get("schema")
    if schema == "text":
        schema = StructType([StructField(f, StringType()) for f in fields])
    elif schema is None and fields:
        return read_json_sampled(spark, spec["path"], fields, spec.get("partition_spec"))
    elif schema == "infer":
        schema = None
    return read_file(spark, "json", spec["path"], spec.get("partition_spec"), schema)


def _csv(spark, spec, fields):
    return read_csv(spark, spec["path"], spec.get("sep", ","), spec.get("header", False),
                    spec.get("partition_spec"))


def _sql(spark, spec, fields):
    return sql_source(spark, spec["sentence"], spec.get("views"))


def _jdbc(spark, spec, fields):
    kind = spec["type"].lower()
    options = {k: spec[k] for k in ("table", "sentence", "user", "password", "partition_column",
                                    "lower", "upper", "num_partitions", "fetch_size") if k in spec}
    driver = spec.get("driver") or PRESETS[kind][1]
    url = spec.get("url") or jdbc_url(kind, spec["host"], spec["port"], spec["database"])
    return read_jdbc(spark, url, driver, **options)


def _table(spark, spec, fields):
    rows = spark.read.table(spec["table"])
    if spec.get("partition_spec"):
        rows = rows.filter(spec["partition_spec"].replace("/", " AND "))
    if spec.get("sentence"):
        return sql_source(spark, spec["sentence"], {spec["table"].split(".")[-1]: rows})
    return rows


def _cells(spark, spec, fields):
    cells = read_file(spark, spec.get("format", "parquet"), spec["path"])
    return cells_to_rows(cells, spec["family"], fields, version=spec.get("version"))


def _format(spark, spec, fields):
    """Any connector on the class path, or a Python data source of the session."""
    reader = spark.read.format(spec["format"]).options(**spec.get("options", {}))
    if spec.get("schema") is not None:
        reader = reader.schema(spec["schema"])
    return reader.load(spec.get("path"))


_readers: dict[str, Reader] = {
    "parquet": _file, "orc": _file, "json": _json, "csv": _csv,
    "sql": _sql, "hive": _sql, "table": _table, "cells": _cells,
    "format": _format,
    "jdbc": _jdbc, "mysql": _jdbc, "postgresql": _jdbc, "clickhouse": _jdbc, "oracle": _jdbc,
    "kafka": read_stream, "pulsar": read_stream, "file_stream": read_stream,
    "stream": read_stream,
}


def read_source(spark: SparkSession, spec: dict, fields: list[str] = ()) -> DataFrame | None:
    """Rows of a source; type names that are not built in go to registered readers."""
    kind = spec["type"].strip().lower()
    reader = _readers.get(kind) or _custom.get(kind)
    if reader is None:
        raise ValueError(f"no reader for source type {spec['type']!r}; register one")
    return reader(spark, spec, list(fields))


def resolve_paths(spec: dict, params: str | None) -> dict:
    """Replace a path that names a run parameter (``k=v,k=v``) by its value."""
    if params is None or "path" not in spec:
        return spec
    known = dict(pair.split("=", 1) for pair in params.split(",") if pair.strip())
    if spec["path"] not in known:
        raise ValueError(f"no run parameter for path {spec['path']!r}")
    return {**spec, "path": known[spec["path"]]}
