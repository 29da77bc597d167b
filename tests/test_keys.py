import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphload.functions import (
    edge_key, existence_key, graph_part, key_part, key_prefix, vertex_key,
)


def test_known_text_keys(spark):
    rows = spark.createDataFrame([("1", "2")], "s string, d string").select(
        "s", "d", graph_part("s", 10, "STRING").alias("sp"),
        graph_part("d", 10, "STRING").alias("dp"))
    got = rows.select(
        vertex_key("sp", "s", 10, 1), edge_key("sp", "s", 2, 0, "d", 10),
        edge_key("dp", "d", -2, 0, "s", 10), existence_key("sp", "s", 10)).first()
    assert [bytes(k).hex() for k in got] == [
        "010600003100000000000000000001000000",
        "02060000310000000000000000000200000080000000000000003200000000000000000001",
        "0201000032000000000000000000feffffff80000000000000003100000000000000000001",
        "0706000031000000000000000000",
    ]


def test_integer_keys_match_struct_packing(spark):
    ids = [0, 1, -1, 258, (1 << 63) - 1, -(1 << 63), 1 << 40]
    parts = [1, 255, 256, 65536, 7, 70000, 8388607]
    rows = spark.createDataFrame(list(zip(parts, ids)), "p int, i bigint").select(
        "p", "i", vertex_key("p", "i", 8, 77, "INT").alias("v"),
        vertex_key("p", "i", 12, 77, "INT").alias("wide"),
        existence_key("p", "i", 8, "INT").alias("x"),
        edge_key("p", "i", F.lit(-300), "i", F.col("i") + F.lit(0), 8, "INT").alias("e")).collect()
    for r in rows:
        assert bytes(r.v) == struct.pack("<Iqi", r.p << 8 | 1, r.i, 77)
        assert bytes(r.wide) == struct.pack("<Iq4xi", r.p << 8 | 1, r.i, 77)
        assert bytes(r.x) == struct.pack("<Iq", r.p << 8 | 7, r.i)
        rank = struct.pack(">Q", (r.i ^ (1 << 63)) & ((1 << 64) - 1) if r.i >= 0
                           else (r.i + (1 << 64)) ^ (1 << 63))
        assert bytes(r.e) == (struct.pack("<Iqi", r.p << 8 | 2, r.i, -300) + rank
                              + struct.pack("<q", r.i) + b"\x01")


def test_keys_decode(spark):
    rows = spark.range(1, 200).select(F.col("id").cast("int").alias("p"), "id")
    got = rows.select("p", key_part(vertex_key("p", "id", 8, 1, "INT"), 200).alias("q"),
                      key_prefix(vertex_key("p", "id", 8, 1, "INT")).alias("a"),
                      key_prefix(existence_key("p", "id", 8, "INT")).alias("b"),
                      key_prefix(edge_key("p", "id", 1, 0, "id", 8, "INT")).alias("c")).collect()
    assert all(r.p == r.q and (r.a, r.b, r.c) == (1, 7, 2) for r in got)


def test_long_ids_are_refused(one):
    assert bytes(one(existence_key(F.lit(1), "t", 3), t=("中", "string"))) == (
        b"\x07\x01\x00\x00" + "中".encode())
    with pytest.raises(PySparkException, match="longer than 3"):
        one(existence_key(F.lit(1), "t", 3), t=("中a", "string"))
    with pytest.raises(ValueError):
        existence_key(F.lit(1), "t", 4, "INT")
