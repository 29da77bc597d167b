"""Line dedup: frequent lines against a plain count, runs over many batches and reopened."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from graphload.llm import linededup
from helpers import AWKWARD, documents, lower


def key_of(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def low(doc_id):
    return (doc_id is not None, doc_id or 0)


def plain(rows, min_chars, min_docs):
    """(doc_id, text, lines, dropped) of each row."""
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(doc_id)
    keeper = {k: max(ids, key=low) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if keeper.get(key_of(x), doc_id) == doc_id]
        out.append((doc_id, "\n".join(left) if len(left) < len(lines) else text, len(lines),
                    len(lines) - len(left)))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_random(spark, seed):
    rng = random.Random(seed)
    lines = ["", " ", "x", "Abcdef gh", " abcdef GH\t", "É long line", "é long line", "\x0bnext LINE\r",
             *[f"line number {i}" for i in range(60)]]
    rows = [(rng.randrange(150), "\n".join(rng.choices(lines, k=rng.randint(0, 12))))
            for _ in range(160)]
    out = linededup.drop_frequent(documents(spark, rows), 5, 3, batches=7)
    assert found(out) == plain(rows, 5, 3)


def test_awkward(spark):
    rows = [*AWKWARD, (20, "\n\n"), (21, "word " * 30000 + "\nrest"), (None, "a line of no document"),
            (22, "a line of no document"), (23, "A LINE of no document \nsecond"), (24, "x" * 20000)]
    docs = documents(spark, rows, extra=True).withColumns({"n_lines": F.lit("z"), "a": F.lit(1)})
    out = linededup.drop_frequent(docs, 10, 2, batches=3)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    assert found(out) == plain(rows, 10, 2)
    assert linededup.drop_frequent(documents(spark, [])).isEmpty()


def test_large_document(spark):
    """A text of very many lines, nearly all of which go, in time that grows with its lines."""
    many = "\n".join(f"a line that two have {i}" for i in range(60000))
    rows = [(1, many + "\nown"), (2, many)]
    out = linededup.drop_frequent(documents(spark, rows), 10, 2).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in out} == {1: (60001, 60000), 2: (60000, 0)}
    assert {r.doc_id: r.text for r in out} == {1: "own", 2: many}


def keys(spark, hashes, top):
    return spark.createDataFrame([(h, -h, 1, top) for h in hashes],
                                 "a long, b long, n long, top long")


def test_runs(spark, tmp_path):
    """Batches against sets and counts; the runs of a level are merged; the index reopens."""
    rng = random.Random(5)
    seen, counts = {}, defaultdict(int)
    runs = linededup.LineRuns(spark, f"{tmp_path}/index", fanout=3)
    for batch in range(11):
        if batch in (4, 9):
            runs.close()
            runs = linededup.LineRuns(spark, f"{tmp_path}/index", fanout=3)
        hashes = set(rng.choices(range(300), k=80)) if batch != 6 else set()
        fresh = {r.a for r in runs.add(keys(spark, hashes, 100 - batch)).collect()}
        assert fresh == hashes - set(seen)
        for h in hashes:
            seen.setdefault(h, 100 - batch)
            counts[h] += 1
    assert sorted(runs.runs) == [(0, 8), (9, 9), (10, 10)]
    total = {r.a: (r.n, r.top) for r in runs.totals().collect()}
    assert total == {h: (counts[h], seen[h]) for h in seen}
    runs.clean()
    runs.close()
    assert sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "index").iterdir()) == [
        "run-0-8", "run-10-10", "run-9-9"]


def test_merge_that_died(spark, tmp_path):
    """Runs beside the run they were merged into are not counted twice; a run that was not
    written to its end is no run."""
    path = f"{tmp_path}/index"
    runs = linededup.LineRuns(spark, path, fanout=2)
    runs.add(keys(spark, [1, 2], 9))
    runs.add(keys(spark, [2, 3], 8))
    assert sorted(runs.runs) == [(0, 1)] and len(runs.merged) == 2
    (tmp_path / "index" / "run-2-2-4").mkdir()
    again = linededup.LineRuns(spark, path, fanout=2)
    assert sorted(again.runs) == [(0, 1)]
    assert {r.a: r.n for r in again.totals().collect()} == {1: 1, 2: 2, 3: 1}
    assert again.add(keys(spark, [3, 4], 7)).collect() == [(4, -4, 7)]


def test_merge_join_leaves_runs_where_they_are(spark):
    runs = linededup.LineRuns(spark)
    runs.add(keys(spark, range(50), 1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = spark.table(next(iter(runs.runs.values()))[0]).select("a", "b")
        plan = keys(spark, range(9), 2).join(run, ["a", "b"], "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text


def test_drop_seen(spark):
    """Batches that arrive one after the other; the first to have a line keeps it."""
    runs = linededup.LineRuns(spark)
    batches = [[(1, "first long line\nother"), (2, "First long line")],
               [(3, "first long line \nsecond long line"), (4, None)],
               [(5, "second long line\nfirst long line\nthird")]]
    got = {}
    for rows in batches:
        out = linededup.drop_seen(documents(spark, rows), runs, 10)
        got |= {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "other", 2: "First long line", 3: "second long line", 4: None, 5: "third"}
