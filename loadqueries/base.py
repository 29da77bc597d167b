"""Registration, the graph all queries load, and SQL building blocks of the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphload.spec import GraphTarget, Label

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name or ``name``, with the SQL that must agree."""
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLES[name or fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PARTS = 10

LABELS = {
    "customer": Label.of("vertex", {"name": "STRING", "nation": "INT32", "segment": "STRING"}, 1),
    "orders": Label.of("vertex", {"status": "STRING", "day": "DATETIME", "priority": "STRING"}, 2),
    "part": Label.of("vertex", {"name": "STRING", "brand": "STRING", "size": "INT32"}, 3),
    "supplier": Label.of("vertex", {"name": "STRING"}, 4),
    "nation": Label.of("vertex", {"name": "STRING"}, 5),
    "region": Label.of("vertex", {"name": "STRING"}, 6),
    "document": Label.of("vertex", {"body": "STRING", "lang": "STRING"}, 7),
    "event": Label.of("vertex", {"kind": "STRING", "at": "DATETIME"}, 8),
    "placed": Label.of("edge", {"priority": "STRING"}, 11),
    "contains": Label.of("edge", {"quantity": "DOUBLE", "flag": "STRING", "shipped": "DATETIME"},
                         12),
    "supplied_by": Label.of("edge", {}, 13),
    "in_nation": Label.of("edge", {}, 14),
    "in_region": Label.of("edge", {}, 15),
}

INT_GRAPH = GraphTarget(PARTS, "INT", 8, LABELS)
STRING_GRAPH = GraphTarget(PARTS, "STRING", 24, LABELS)

# -- SQL building blocks ---------------------------------------------------------------

TWO64 = "18446744073709551616"


def sql_part_int(x: str, n: int = PARTS) -> str:
    return f"((({x})::HUGEINT + {TWO64}) % {TWO64} % {n} + 1)::INTEGER"


def _mul(a: str, b: str) -> str:
    return f"((({a})::UHUGEINT * ({b})::UHUGEINT) % {TWO64}::UHUGEINT)::UBIGINT"


def _mix(a: str) -> str:
    return f"xor({a}, ({a}) >> 47)"


def sql_word(hex_text: str, first: str, count: int = 8) -> str:
    """Little-endian number of up to ``count`` bytes from hex digit ``first`` (1-based)."""
    digits = "||".join(f"lpad(substr({hex_text}, {first} + {2 * i}, 2), 2, '0')"
                       for i in reversed(range(count)))
    return f"('0x' || {digits})::UBIGINT"


def sql_murmur(text: str) -> str:
    """MurmurHash64A of a text as UBIGINT: a fold over its 8-byte words, then the tail."""
    # The multiplier, the shift (in _mix) and the seed of the id hash.
    m = "14313749767032793493::UBIGINT"
    size = f"(octet_length(encode({text})))"
    words = f"({size} // 8)"
    seed = f"xor(3339675911::UBIGINT, {_mul(size, m)})"
    k1 = _mul("w", m)
    word = sql_word("x", "1")
    step = _mul(f"xor(h, {_mul(_mix('w1'), m)})", m)
    fold = (f"list_reduce(list_concat([{seed}], list_transform("
            f"regexp_extract_all(hex({text}), '.{{16}}'), lambda x: {word})), "
            f"lambda h, w: {step.replace('w1', k1)})")
    tail = sql_word(f"rpad(hex({text}), ({words} * 16 + 16)::INTEGER, '0')", f"{words} * 16 + 1")
    ended = (f"CASE WHEN {size} % 8 = 0 THEN {fold} "
             f"ELSE {_mul(f'xor({fold}, {tail})', m)} END")
    mixed = f"list_transform([{ended}], lambda e: {_mul(_mix('e'), m)})[1]"
    return f"list_transform([{mixed}], lambda z: {_mix('z')})[1]"


def sql_signed(u: str) -> str:
    return (f"(CASE WHEN ({u}) >= 9223372036854775808::UBIGINT "
            f"THEN ({u})::HUGEINT - {TWO64}::HUGEINT ELSE ({u})::HUGEINT END)::BIGINT")


def sql_part_string(text: str, n: int = PARTS) -> str:
    return (f"(CASE WHEN octet_length(encode({text})) = 8 "
            f"THEN {sql_word(f'hex({text})', '1')} ELSE {sql_murmur(text)} END % {n} + 1)::INTEGER")


def sql_little(x: str, size: int) -> str:
    """Little-endian bytes of an integer as lower-case hex."""
    u = f"((({x})::HUGEINT + {TWO64}) % {TWO64})::UBIGINT"
    return "||".join(f"lpad(lower(hex(({u} >> {8 * i}) & 255)), 2, '0')" for i in range(size))


def sql_big(x: str) -> str:
    """Big-endian bytes of an integer with the sign bit flipped, as hex."""
    return f"lpad(lower(hex((({x})::HUGEINT + 9223372036854775808)::UBIGINT)), 16, '0')"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def sql_escape(x: str) -> str:
    # Character -> escape, backslash first.
    for plain, escaped in (("'\\'", "'\\\\'"), ("chr(9)", "'\\t'"), ("chr(10)", "'\\n'"),
                           ("'\"'", "'\\\"'"), ("''''", "'\\'''"), ("chr(13)", "'\\r'"),
                           ("chr(8)", "'\\b'")):
        x = f"replace({x}, {plain}, {escaped})"
    return x


def sql_quote(x: str) -> str:
    return f"('\"' || {sql_escape(x)} || '\"')"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
