"""Binary keys of vertices and edges, built from native expressions.

Layouts (LE = little-endian, BE = big-endian, L = id length of the graph):

* vertex     LE32(part << 8 | 1), id padded to L, LE32(tag number)
* existence  LE32(part << 8 | 7), id padded to L
* edge       LE32(part << 8 | 2), source padded to L, LE32(edge number),
             BE64(rank with the sign bit flipped), target padded to L, 01
"""

from __future__ import annotations

import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import check_id_type
from .text import _col

# First byte of each kind of key, and the edge version byte.
VERTEX, EDGE, EXISTENCE = 1, 2, 7
EDGE_VERSION = 1


def _bytes(c: Column, size: int) -> Column:
    """Big-endian bytes of a non-negative bigint, or of all 8 bytes of any bigint."""
    return F.unhex(F.lpad(F.hex(c), 2 * size, "0"))


def _swap8(c: Column) -> Column:
    """Byte order of a bigint reversed: swap bytes, then pairs, then halves."""
    for shift, mask in ((8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        keep = F.lit(mask).cast("bigint")
        c = F.shiftleft(c.bitwiseAND(keep), shift).bitwiseOR(
            F.shiftrightunsigned(c, shift).bitwiseAND(keep))
    return F.shiftleft(c, 32).bitwiseOR(F.shiftrightunsigned(c, 32))


def _little(c: Column, size: int) -> Column:
    """Little-endian bytes of the low 4 or 8 bytes of a bigint."""
    swapped = _swap8(c.cast("bigint"))
    return _bytes(swapped if size == 8 else F.shiftrightunsigned(swapped, 32), size)


def _head(part: Column | str, kind: int | Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    return _little(F.shiftleft(_col(part).cast("bigint"), 8).bitwiseOR(kind.cast("bigint")), 4)


def _number(n: int | Column) -> Column:
    return F.lit(bytearray(struct.pack("<i", n))) if isinstance(n, int) else _little(n, 4)


def id_bytes(c: Column | str, length: int, id_type: str = "STRING") -> Column:
    """Id as fixed-width bytes; longer ids are an error, never cut."""
    if check_id_type(id_type) == "INT":
        if length < 8:
            raise ValueError("integer ids need an id length of at least 8")
        raw = _little(_col(c), 8)
        return raw if length == 8 else F.rpad(raw, length, bytearray(b"\0"))
    raw = F.encode(_col(c).cast("string"), "UTF-8")
    return F.when(F.octet_length(raw) <= length, F.rpad(raw, length, bytearray(b"\0"))).when(
        raw.isNotNull(),
        F.raise_error(F.concat(F.lit(f"id longer than {length} bytes: "),
                               _col(c).cast("string"))))


def vertex_key(part: Column | str, vid: Column | str, length: int, tag: int,
               id_type: str = "STRING") -> Column:
    return F.concat(_head(part, VERTEX), id_bytes(vid, length, id_type), _number(tag))


def existence_key(part: Column | str, vid: Column | str, length: int,
                  id_type: str = "STRING") -> Column:
    return F.concat(_head(part, EXISTENCE), id_bytes(vid, length, id_type))


def edge_key(part: Column | str, src: Column | str, edge_type: int | Column,
             rank: Column | str | int, dst: Column | str, length: int,
             id_type: str = "STRING") -> Column:
    """Key of one direction; pass the negated number and swapped ends for the other."""
    rank = F.lit(rank) if isinstance(rank, int) else _col(rank)
    flipped = rank.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
    return F.concat(
        _head(part, EDGE), id_bytes(src, length, id_type), _number(edge_type),
        _bytes(flipped, 8), id_bytes(dst, length, id_type),
        F.lit(bytearray([EDGE_VERSION])))


def key_part(key: Column | str, n: int) -> Column:
    """Graph partition 1..n written in a key."""
    digits = F.hex(F.substring(_col(key), 1, 4))
    swapped = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(4))])
    # signed 32-bit number, so partitions past 2^23 come out non-positive
    word = F.conv(swapped, 16, 10).cast("bigint")
    signed = F.when(word >= (1 << 31), word - (1 << 32)).otherwise(word)
    part = F.shiftright(signed, 8)
    return F.when(part <= 0, part + n).otherwise(part).cast("int")


def key_prefix(key: Column | str) -> Column:
    return F.conv(F.hex(F.substring(_col(key), 1, 1)), 16, 10).cast("int")
