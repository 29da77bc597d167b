from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphload.functions import geo_cells, geo_source_id, graph_part, murmur64
from graphload.functions.geo import leaf_cell
from graphload.functions.hashing import MULTIPLIER, SEED

M64 = (1 << 64) - 1


def scalar_murmur(data: bytes) -> int:
    """The published algorithm, one byte string at a time."""
    h = SEED ^ (len(data) * MULTIPLIER & M64)
    for i in range(0, len(data) - 7, 8):
        k = int.from_bytes(data[i:i + 8], "little") * MULTIPLIER & M64
        k = (k ^ (k >> 47)) * MULTIPLIER & M64
        h = (h ^ k) * MULTIPLIER & M64
    tail = data[len(data) // 8 * 8:]
    if tail:
        h = (h ^ int.from_bytes(tail, "little")) * MULTIPLIER & M64
    h = (h ^ (h >> 47)) * MULTIPLIER & M64
    return h ^ (h >> 47)


def signed(u):
    return u - (1 << 64) if u >> 63 else u


# Partition ids of ten partitions.
TEXT_PARTS = {
    "1": 6, "2": 1, "3": 4, "4": 7, "5": 10, "6": 2, "7": 3, "8": 7, "9": 5, "10": 4, "11": 9,
    "12": 4, "-1": 1, "-2": 6, "-3": 1, "19": 9, "22": 8, "中文": 5, "北京": 7, "北京123": 1,
    "北A12ABC": 3, "蒙DPP8EC": 4, "赣F6893_Vehicle": 2, "湘3Z4A1E_vehicle": 1, "abcdefgh": 10,
    "上下左右前后测试": 7, "0123456789": 8,
}
INT_PARTS = {**{k: k + 1 for k in range(1, 10)}, 10: 1, 11: 2, 12: 3, -1: 6, -2: 5, -3: 4}


def test_partition_of_text_ids(spark):
    rows = spark.createDataFrame([(k,) for k in TEXT_PARTS], "k string").select(
        "k", graph_part("k", 10, "STRING")).collect()
    assert dict(map(tuple, rows)) == TEXT_PARTS


def test_partition_of_integer_ids(spark):
    rows = spark.createDataFrame([(k,) for k in INT_PARTS], "k bigint").select(
        "k", graph_part("k", 10, "INT")).collect()
    assert dict(map(tuple, rows)) == INT_PARTS


def test_partition_of_extreme_integers(spark):
    keys = [-(1 << 63), (1 << 63) - 1, -1, 0, -10, 1 << 62]
    for n in (1, 7, 10, 100, 2**31 - 1):
        rows = spark.createDataFrame([(k,) for k in keys], "k bigint").select(
            "k", graph_part("k", n, "INT")).collect()
        assert [r[1] for r in rows] == [(k & M64) % n + 1 for k in keys]


def test_hash_matches_the_scalar_algorithm(spark):
    found = ["", "a", "abcdefgh", "abcdefghi", "x" * 1000]

    @settings(max_examples=400, deadline=None)
    @given(st.text(max_size=60))
    def gather(text):
        if text.isprintable():
            found.append(text)

    gather()
    rows = spark.createDataFrame([(t,) for t in found] + [(None,)], "t string").select(
        "t", murmur64("t").alias("h")).collect()
    for row in rows:
        assert row.h == (None if row.t is None else signed(scalar_murmur(row.t.encode())))


# Leaf cells of the public cell library.
CELLS = [
    (49.703498679, 11.770681595, 0x47A1CBD595522B39),
    (55.685376759, 12.588490937, 0x46525318B63BE0F9),
    (45.486546517, -93.449700022, 0x52B30B71698E729D),
    (-25.285264027, 133.823116966, 0x2B2BFD076787C5DF),
    (-75.000000031, 0.000000133, 0xB09DFF882A7809E1),
]


def test_cells(spark):
    rows = spark.createDataFrame([(a, b, signed(c)) for a, b, c in CELLS] + [(None, 1.0, None)],
                                 "lat double, lng double, leaf bigint")
    got = rows.select("leaf", leaf_cell("lat", "lng").alias("c"),
                      geo_cells("lat", "lng").alias("up"),
                      geo_source_id("lat", "lng").alias("id")).collect()
    for row in got[:-1]:
        assert row.c == row.leaf
        assert len(row.up) == 9
        for level, cell in zip(range(10, 19), row.up):
            bit = 1 << (2 * (30 - level))
            assert cell == signed((row.leaf & M64) & (M64 ^ (bit - 1)) & (M64 ^ bit) | bit)
        assert row.id == ",".join(map(str, row.up))
    assert got[-1].c is None


def test_empty_input(spark):
    empty = spark.createDataFrame([], "t string")
    assert empty.select(murmur64("t"), graph_part("t", 3, "STRING")).collect() == []
    assert spark.range(1).select(murmur64(F.lit(None).cast("string"))).first()[0] is None
