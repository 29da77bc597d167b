"""Filters, composite keys, projection and row validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from ..functions.hashing import check_id_type
from ..functions.text import _col, check_policy, is_numeric_id, jtrim
from ..spec import EdgeSpec, VertexSpec


def apply_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows for which a SQL condition holds; Catalyst pushes it into the scan."""
    return df if condition is None else df.filter(condition)


def with_composite_key(df: DataFrame, sep: str, cols: list[str], new_col: str) -> DataFrame:
    """Append a key joined from columns. NULL parts are skipped; all NULL gives ""."""
    return df.select("*", F.concat_ws(sep, *[_col(c).cast("string") for c in cols]).alias(new_col))


def project_properties(df: DataFrame, fields: list[str], targets: list[str] | None = None,
                       keep: list[str] = ()) -> DataFrame:
    """Key columns plus properties under their target names; blank names skipped."""
    targets = list(fields) if targets is None else list(targets)
    if len(targets) != len(fields):
        raise ValueError("fields and target fields differ in number")
    return df.select(*map(_col, keep), *[_col(f).alias(t) for f, t in zip(fields, targets) if f.strip()])


def required_fields(spec: VertexSpec | EdgeSpec) -> list[str]:
    """Source columns an entity needs, each once."""
    return list(dict.fromkeys(spec.key_fields + [f for f, _ in spec.properties]))


def integer_text(c: Column | str) -> Column:
    """Trimmed text that is a number and fits a bigint."""
    text = jtrim(_col(c))
    return is_numeric_id(text) & text.try_cast("bigint").isNotNull()


def _is_integer(schema: StructType | None, name: Column | str) -> bool:
    """Whether the column type already says that every value is an integer."""
    return (schema is not None and isinstance(name, str)
            and isinstance(schema[name].dataType, IntegralType))


def id_problem(c: Column | str, id_type: str, policy: str | None = None,
               prefix: str | None = None, what: str = "id", schema: StructType | None = None
               ) -> Column:
    """Why an id cannot be used, or NULL. Rules fixed per load fold away.

    With the ``schema`` of the rows, integer columns need no look at the values.
    """
    integer = _is_integer(schema, c)
    c = _col(c)
    check_policy(policy)
    if check_id_type(id_type) == "STRING":
        rule = F.lit(f"{what}: a key policy needs integer ids") if policy else F.lit(None)
    elif policy:
        rule = F.lit(None)
    elif prefix is not None:
        rule = F.lit(f"{what}: integer ids take no prefix")
    elif integer:
        rule = F.lit(None)
    else:
        rule = F.when(~integer_text(c), F.lit(f"{what}: not an integer"))
    return F.when(c.isNull(), F.lit(f"{what}: missing")).otherwise(rule.cast("string"))


def rank_problem(c: Column | str, schema: StructType | None = None) -> Column:
    missing = F.when(_col(c).isNull(), F.lit("rank: missing"))
    if _is_integer(schema, c):
        return missing
    return missing.when(~integer_text(c), F.lit("rank: not an integer"))


def vertex_problem(spec: VertexSpec, id_type: str, schema: StructType | None = None) -> Column:
    return id_problem(spec.id, id_type, spec.policy, spec.prefix, schema=schema)


def edge_problem(spec: EdgeSpec, id_type: str, schema: StructType | None = None) -> Column:
    problems = [
        id_problem(spec.src, id_type, spec.src_policy, spec.src_prefix, "source", schema),
        id_problem(spec.dst, id_type, spec.dst_policy, spec.dst_prefix, "target", schema),
    ]
    if spec.rank:
        problems.append(rank_problem(spec.rank, schema))
    return F.coalesce(*problems)


def problem_of(spec: VertexSpec | EdgeSpec, id_type: str, schema: StructType | None = None
               ) -> Column:
    problem = vertex_problem if spec.kind == "vertex" else edge_problem
    return problem(spec, id_type, schema)


def vertex_valid(c: Column | str, id_type: str, policy: str | None = None,
                 prefix: str | None = None) -> Column:
    return id_problem(c, id_type, policy, prefix).isNull()


def edge_valid(spec: EdgeSpec, id_type: str) -> Column:
    return edge_problem(spec, id_type).isNull()


def enforce(df: DataFrame, problem: Column, mode: str = "fail", at: str | None = None):
    """Apply the invalid-row policy.

    ``fail`` stops the job at the first invalid row, ``drop`` leaves such rows
    out (streams), ``quarantine`` returns (valid rows, invalid rows with the
    reason in ``problem``). In ``fail`` mode the check sits in the column ``at`` (the
    first one by default) and runs where that column is used: a predicate would be
    pushed below joins and see rows that the source does not give. The message
    names a row number, which keeps later predicates on the column above the check, too.
    """
    if mode == "drop":
        return df.filter(problem.isNull())
    if mode == "fail":
        name = df.columns[0] if at is None else at
        row = F.concat(F.lit("invalid row "), F.monotonically_increasing_id().cast("string"))
        stop = F.raise_error(F.concat(row, F.lit(", "), problem))
        checked = F.when(problem.isNull(), _col(name)).otherwise(
            stop.cast(df.schema[name].dataType))
        return df.select(*[checked.alias(c) if c == name else _col(c) for c in df.columns])
    if mode == "quarantine":
        marked = df.withColumn("problem", problem)
        return (marked.filter(F.col("problem").isNull()).drop("problem"),
                marked.filter(F.col("problem").isNotNull()))
    raise ValueError(f"unknown invalid-row mode {mode!r}")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """First rows of an input, for a dry run."""
    return df.limit(rows)
