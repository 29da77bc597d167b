"""Resharding: the flow against brute force, the layout, the files."""

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from graphload.llm import sharding
from helpers import AWKWARD, documents


def least_moved(old, capacity):
    """Brute force: whatever does not fit where it is must move."""
    return sum(max(0, size - (capacity[i] if i < len(capacity) else 0))
               for i, size in enumerate(old))


@pytest.mark.parametrize("seed", range(30))
def test_flow(seed):
    rng = random.Random(seed)
    old = [rng.choice([0, 3, 50, 1000]) for _ in range(rng.randint(1, 7))]
    capacity = [rng.randint(0, 400) for _ in range(rng.randint(1, 7))]
    capacity[-1] += max(0, sum(old) - sum(capacity))
    flow = sharding.min_cost_flow(old, capacity)
    assert [sum(f.values()) for f in flow] == old
    for j, most in enumerate(capacity):
        assert sum(f.get(j, 0) for f in flow) <= most
    moved = sum(n for i, f in enumerate(flow) for j, n in f.items() if i != j)
    assert moved == least_moved(old, capacity)


def test_flow_by_enumeration():
    old, capacity = [3, 1, 0], [1, 1, 2]
    best = min(
        sum(n for (i, j), n in zip(itertools.product(range(3), range(3)), cells) if i != j)
        for cells in itertools.product(range(4), repeat=9)
        if [sum(cells[3 * i:3 * i + 3]) for i in range(3)] == old
        and all(sum(cells[j::3]) <= capacity[j] for j in range(3)))
    flow = sharding.min_cost_flow(old, capacity)
    assert sum(n for i, f in enumerate(flow) for j, n in f.items() if i != j) == best
    with pytest.raises(ValueError):
        sharding.min_cost_flow([5], [4])


def test_query(spark, data):
    rows = sharding.op9_sharding(spark, data).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    sizes, slots = [0] * 16, [[] for _ in range(16)]
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(r.size for r in rows)
    assert max(sizes) - min(sizes) <= largest
    # what stays could have stayed: about the least is moved
    old = [0] * 16
    for r in rows:
        old[r.old_shard] += r.size
    moved = sum(r.size for r in rows if r.old_shard != r.shard)
    assert moved <= least_moved(old, [sum(old) / 16] * 16) + 16 * largest


def test_awkward_and_rewrite(spark, tmp_path):
    docs = documents(spark, AWKWARD, extra=True).drop("n_chars")
    placed = sharding.reshard(docs, F.lit(0), sharding.text_size(F.col("text")),
                              [F.col("doc_id"), F.xxhash64("text")], shards=3)
    rows = placed.collect()
    assert len(rows) == len(AWKWARD)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    changed = sharding.rewrite_affected(placed, str(tmp_path / "new"))
    assert changed == [0, 1, 2]
    assert spark.read.parquet(str(tmp_path / "new")).count() == len(AWKWARD)
    # shards that keep their rows are not written
    even = sharding.reshard(spark.range(64).withColumn("size", F.lit(1)), F.col("id") % 2,
                            F.col("size"), [F.col("id")], shards=2)
    assert sharding.affected_shards(even) == []
    empty = sharding.reshard(documents(spark, []), F.lit(0), F.lit(1), [F.col("doc_id")])
    assert empty.count() == 0


def test_files_of_fewer_shards(spark, tmp_path):
    """Shards that end empty are gone from the folder, and no row lies there twice."""
    path = str(tmp_path / "shards")
    rows = spark.range(300).select("id", (F.col("id") % 6).alias("old"), F.lit(1).alias("size"))
    found, changed = sharding.reshard_files(rows, path, F.col("old"), F.col("size"),
                                            [F.col("id")], shards=2)
    assert changed == list(range(6))
    there = spark.read.parquet(path)
    assert sorted(r.id for r in there.collect()) == list(range(300))
    assert sorted(p.name for p in tmp_path.joinpath("shards").glob("shard=*")) == [
        "shard=0", "shard=1"]
    assert sorted(map(tuple, found.select("id", "shard", "slot").collect())) == sorted(
        map(tuple, there.select("id", "shard", "slot").collect()))


def test_shards_that_keep_their_rows_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "shards")
    # shard 2 is even already; only 0 and 1 exchange rows
    old = F.when(F.col("id") < 100, 2).when(F.col("id") < 150, 0).otherwise(1)
    rows = spark.range(300).select("id", old.alias("old"), F.lit(1).alias("size"))
    found, changed = sharding.reshard_files(rows, path, F.col("old"), F.col("size"),
                                            [F.col("id")], shards=3)
    assert changed == [0, 1]
    assert "slot" not in spark.read.parquet(f"{path}/shard=2").columns
    got = found.collect()
    assert sorted(r.id for r in got) == list(range(300))
    for shard in range(3):
        assert sorted(r.slot for r in got if r["shard"] == shard) == list(range(100))


def test_whole_documents_lie_in_the_shards(spark, data, tmp_path, monkeypatch):
    path = str(tmp_path / "shards")
    monkeypatch.setattr(sharding, "scratch_path", lambda *a: path)
    said = {r.doc_id: (r["shard"], r.slot) for r in sharding.op9_sharding(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    there = spark.read.parquet(path).collect()
    assert sorted(tuple(r[c] for c in docs.columns) for r in there) == sorted(
        map(tuple, docs.collect()))
    assert {r.doc_id: (r["shard"], r.slot) for r in there} == said
