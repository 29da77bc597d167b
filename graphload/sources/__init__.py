from .dispatch import read_source, register_source, resolve_paths
from .files import read_csv, read_file, read_lines, read_statements
from .jdbc import jdbc_options, jdbc_url, read_jdbc
from .shapes import cells_to_rows, project_json, stringify_columns
from .sql import sql_source
from .streams import kafka_options, pulsar_options, read_stream

__all__ = [
    "cells_to_rows", "jdbc_options", "jdbc_url", "kafka_options", "project_json",
    "pulsar_options", "read_csv", "read_file", "read_jdbc", "read_lines", "read_source",
    "read_statements", "read_stream", "register_source", "resolve_paths", "sql_source",
    "stringify_columns",
]
