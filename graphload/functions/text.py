"""Text helpers: trimming, escaping, quoting, id prefixes. All native Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# The characters that trimming removes (U+0000 to U+0020).
TRIMMED = "".join(chr(code) for code in range(0x21))

# Character -> escape, applied in this order (backslash first).
ESCAPES = [
    ("\\", "\\\\"),
    ("\t", "\\t"),
    ("\n", "\\n"),
    ('"', '\\"'),
    ("'", "\\'"),
    ("\r", "\\r"),
    ("\b", "\\b"),
]

# Key policies.
POLICIES = ("hash", "uuid")


def _col(c: Column | str) -> Column:
    """A column by its exact name, dots and symbols included."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def jtrim(c: Column | str, text: bool = True) -> Column:
    """Text without leading and trailing control characters and spaces.

    Spark's one-argument trim removes only spaces, and trimming a set of
    characters is slow, so values with clean ends skip it. ``text=False`` says
    the column is not text and has nothing to trim.
    """
    value = _col(c).cast("string")
    if not text:
        return value
    clean = (F.substring(value, 1, 1) > " ") & (F.substring(value, -1, 1) > " ")
    return F.when(clean, value).otherwise(F.btrim(value, F.lit(TRIMMED)))


def is_text(schema: StructType, name: str) -> bool:
    return isinstance(schema[name].dataType, StringType)


def unsentinel(c: Column | str, marker: str | None) -> Column:
    """Replace the marker that stands for "empty text" by the empty text."""
    c = _col(c)
    return c if marker is None else F.when(c == marker, F.lit("")).otherwise(c)


def prefix_id(c: Column | str, prefix: str | None) -> Column:
    """``prefix_id``; no prefix leaves the id alone."""
    text = _col(c).cast("string")
    return text if prefix is None else F.concat(F.lit(prefix + "_"), text)


def escape_text(c: Column | str) -> Column:
    text = _col(c)
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def quote_text(c: Column | str) -> Column:
    return F.concat(F.lit('"'), escape_text(c), F.lit('"'))


def quote_name(name: str) -> str:
    """Identifier in back-ticks; other symbols inside are kept as they are."""
    if "`" in name:
        raise ValueError(f"a back-tick cannot be part of a name: {name!r}")
    return f"`{name}`"


def is_numeric_id(c: Column | str, strict: bool = False) -> Column:
    """Optional minus, then only digits. "" and "-" count unless ``strict``."""
    return _col(c).rlike(r"\A-?\p{Nd}+\z" if strict else r"\A-?\p{Nd}*\z")


def wrap_policy(c: Column | str, policy: str | None) -> Column:
    """``hash("id")`` or ``uuid("id")`` as written in a statement."""
    if policy is None:
        return _col(c)
    check_policy(policy)
    return F.concat(F.lit(f'{policy}("'), _col(c), F.lit('")'))


def check_policy(policy: str | None) -> str | None:
    if policy is not None and policy not in POLICIES:
        raise ValueError(f"unknown key policy {policy!r}; use one of {POLICIES}")
    return policy


def clean_id(c: Column | str, prefix: str | None = None, marker: str | None = None,
             text: bool = True) -> Column:
    """Trimmed id text, empty marker resolved, prefix added."""
    return prefix_id(unsentinel(jtrim(c, text), marker if text else None), prefix)
