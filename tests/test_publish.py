"""Published key/value sets: whole, replaced at once, and checked against their files."""

import os

import pytest
from pyspark.sql import functions as F

from graphload.operators import kv, publish
from graphload.operators.kv import edge_kv, write_kv
from graphload.operators.publish import (
    current_set, publish_kv, read_kv, read_manifest, retire, set_problems, sets_of,
)
from loadqueries import keyvalue
from test_kv import EDGES, LINES


@pytest.fixture(scope="module")
def edges(spark, data):
    lines = spark.read.parquet(f"{data}/lineitem.parquet").filter("l_orderkey < 400")
    # a third of all lines belong to one order
    return edge_kv(lines.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, 7).otherwise(
        F.col("l_orderkey"))), LINES, EDGES)


def keys(frame):
    return sorted(bytes(r.key) for r in frame.select("key").collect())


def files_of(found):
    return [os.path.join(folder, n) for folder, _, names in os.walk(found.data) for n in names
            if n.endswith(".parquet")]


def test_the_newest_whole_set_counts(spark, edges, tmp_path, monkeypatch):
    path = str(tmp_path / "kv")
    assert current_set(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_kv(spark, path)
    half = edges.filter("part % 2 = 0")
    first = publish_kv(half, path, files=4)
    assert keys(read_kv(spark, path)) == keys(half)
    # a run that dies after its files, and one that dies among them
    with monkeypatch.context() as broken:
        broken.setattr(publish, "file_manifest", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish_kv(edges, path, "died", files=4)
    write_kv(edges.limit(5), f"{path}/run=among", 1)
    assert current_set(spark, path) == first
    assert keys(read_kv(spark, path)) == keys(half)
    held = read_kv(spark, path)
    second = publish_kv(edges, path, "died", files=4)
    assert keys(read_kv(spark, path)) == keys(edges)
    # whoever reads the older set still can
    assert keys(held) == keys(half)
    assert [s.run for s in sets_of(spark, path)] == [first.run, "died"] and second.run == "died"
    assert retire(spark, path) == [first.run]
    assert [s.run for s in sets_of(spark, path)] == ["died"]
    assert not os.path.exists(first.data) and os.path.exists(f"{path}/run=among")
    assert keys(read_kv(spark, path)) == keys(edges)
    with pytest.raises(ValueError):
        retire(spark, path, 0)


def test_a_manifest_that_was_not_written_to_its_end_does_not_count(spark, edges, tmp_path):
    path = str(tmp_path / "kv")
    first = publish_kv(edges, path, files=2)
    os.mkdir(f"{path}/published=99999999999999999999-other")
    assert current_set(spark, path) == first


def test_manifest(spark, edges, tmp_path):
    found = publish_kv(edges, str(tmp_path / "kv"), files=12)
    said = read_manifest(spark, found).collect()
    assert sorted(f"{found.data}/{r.file}" for r in said) == sorted(files_of(found))
    for r in said:
        rows = [bytes(k.key) for k in spark.read.parquet(f"{found.data}/{r.file}").collect()]
        assert (r["rows"], bytes(r.first_key), bytes(r.last_key)) == (
            len(rows), min(rows), max(rows))
        assert r.bytes == os.path.getsize(f"{found.data}/{r.file}")
        assert f"part={r.part}/prefix={r.prefix}/" in r.file
    assert set_problems(spark, found).isEmpty()


def test_manifest_with_more_files_than_are_broadcast(spark, edges, tmp_path, monkeypatch):
    found = publish_kv(edges, str(tmp_path / "kv"), files=3)
    monkeypatch.setattr(publish, "FILES_TO_BROADCAST", 1)
    assert set_problems(spark, found).isEmpty()


def test_problems_are_found(spark, edges, tmp_path):
    found = publish_kv(edges, str(tmp_path / "kv"), files=6)
    first, second, third = sorted(files_of(found))[:3]
    inside = {f: f.removeprefix(f"{found.data}/") for f in (first, second, third)}
    os.remove(first)
    # another file's content: the checksum beside it goes, as it would not fit
    content = open(third, "rb").read()
    open(second, "wb").write(content)
    folder, name = os.path.split(second)
    for crc in (f"{folder}/.{name}.crc",):
        os.remove(crc)
    open(f"{os.path.dirname(third)}/more.parquet", "wb").write(content)
    problems = {(r.file, r.problem) for r in set_problems(spark, found).collect()}
    more = f"{os.path.dirname(inside[third])}/more.parquet"
    assert {(inside[first], "missing"), (inside[second], "changed"), (more, "added")} <= problems
    assert any(problem == "overlaps" for _, problem in problems)


def test_empty_set(spark, edges, tmp_path):
    path = str(tmp_path / "kv")
    publish_kv(edges, path, files=2)
    found = publish_kv(edges.limit(0), path, files=2)
    assert read_kv(spark, path).isEmpty() and read_manifest(spark, found).isEmpty()
    assert set_problems(spark, found).isEmpty()


def test_problems_read_the_keys_once(spark, edges, tmp_path):
    found = publish_kv(edges, str(tmp_path / "kv"), files=3)
    problems = set_problems(spark, found)
    # what is compared is one row for each file, not the files' rows
    assert not [f for f in problems.inputFiles() if found.data in f]
    assert problems.isEmpty()


def test_published_files_grow_in_number(spark, data, tmp_path, monkeypatch):
    path = str(tmp_path / "sets")
    monkeypatch.setattr(kv, "ROWS_PER_TASK", 1000)
    monkeypatch.setattr(keyvalue, "scratch_path", lambda *a: path)
    keyvalue.kv_published(spark, data)
    lines = spark.read.parquet(f"{data}/lineitem.parquet").count()
    said = read_manifest(spark, current_set(spark, path)).collect()
    assert len(said) >= 2 * lines // 1000 and max(r["rows"] for r in said) < 2000
