"""64-bit id hash and the graph partition of an id.

Spark has no MurmurHash64A, so the hash is one Arrow UDF over whole column
batches; everything around it stays native.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .text import _col

# MurmurHash64A multiplier, shift and the seed of the id hash.
MULTIPLIER = 0xC6A4A7935BD1E995
SHIFT = 47
SEED = 0xC70F6907

_WORD = np.arange(8)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte buffer, start and length of every value."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype="<i8")[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    # eight spare bytes let the last word be read without a bounds check
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    return raw, ends[:-1], np.diff(ends)


def _words(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw[at[:, None] + _WORD]).view("<u8").ravel()


def _murmur(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    m, shift = np.uint64(MULTIPLIER), np.uint64(SHIFT)
    h = np.uint64(SEED) ^ (size.astype(np.uint64) * m)
    words = size // 8
    # word j of all values that have one, longest first: as many steps as the
    # longest value has words, whatever the mix of lengths
    longest_first = np.argsort(-words, kind="stable")
    sorted_words = words[longest_first]
    for j in range(int(words.max(initial=0))):
        rows = longest_first[:np.searchsorted(-sorted_words, -j, side="left")]
        k = _words(raw, start[rows] + 8 * j) * m
        k ^= k >> shift
        h[rows] = (h[rows] ^ (k * m)) * m
    rest = size % 8
    rows = np.flatnonzero(rest)
    if len(rows):
        tail = _words(raw, start[rows] + 8 * words[rows])
        keep = (np.uint64(1) << (rest[rows] * 8).astype(np.uint64)) - np.uint64(1)
        h[rows] = (h[rows] ^ (tail & keep)) * m
    h ^= h >> shift
    h *= m
    h ^= h >> shift
    return h


def _signed(values: np.ndarray, column: pa.Array) -> pa.Array:
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return pa.array(values.view(np.int64), type=pa.int64(), mask=nulls)


@F.arrow_udf(LongType())
def _murmur64(ids: pa.Array) -> pa.Array:
    return _signed(_murmur(*_bytes_of(ids)), ids)


@F.arrow_udf(LongType())
def _part_hash(ids: pa.Array) -> pa.Array:
    """Ids of exactly eight bytes are their own little-endian number."""
    raw, start, size = _bytes_of(ids)
    h = _murmur(raw, start, size)
    eight = np.flatnonzero(size == 8)
    if len(eight):
        h[eight] = _words(raw, start[eight])
    return _signed(h, ids)


def murmur64(c: Column | str) -> Column:
    """Signed MurmurHash64A of the UTF-8 bytes of an id (the hash policy)."""
    return _murmur64(_col(c).cast("string"))


def unsigned_mod(c: Column, n: int) -> Column:
    """A bigint read as unsigned, modulo ``n``, without overflow."""
    half = F.shiftrightunsigned(c, 1)
    return (half % n * 2 + c.bitwiseAND(F.lit(1).cast("bigint"))) % n


def graph_part(c: Column | str, n: int, id_type: str) -> Column:
    """Graph partition 1..n of an id."""
    if n <= 0:
        raise ValueError("the graph needs at least one partition")
    c = _col(c)
    value = c.cast("bigint") if check_id_type(id_type) == "INT" else _part_hash(c.cast("string"))
    return (unsigned_mod(value, n) + 1).cast("int")


def check_id_type(id_type: str) -> str:
    name = id_type.upper()
    if name not in ("STRING", "INT"):
        raise ValueError(f"id type must be STRING or INT, not {id_type!r}")
    return name
