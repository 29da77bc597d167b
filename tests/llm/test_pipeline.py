"""The pipeline's stages, one after the other and each on its own input."""

import corpus_pipeline
from graphload.llm import ngramjoin, passages
from graphload.storage import write_once
from helpers import AWKWARD, documents


def test_run(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_copies", "passages", "mixing", "encoding"]
    for name, stage in corpus_pipeline.STAGES:
        out = write_once(stage(spark, docs, data))
        if name != "encoding":
            assert out.columns == columns
            assert out.dtypes == docs.dtypes
        seen[name] = (docs, out)
        docs = out
    ids = {n: [sorted(r.doc_id for r in f.collect()) for f in pair] for n, pair in seen.items()}
    assert set(ids["language"][1]) <= set(ids["language"][0])
    assert len(ids["language"][1]) >= 0.98 * len(ids["language"][0])
    before = seen["near_copies"][0]
    groups = ngramjoin.jaccard_components(before, 5, 80)
    assert ids["near_copies"][1] == sorted({r.component_id for r in groups.collect()})
    cleaned = {r.doc_id: r.text for r in passages.dedup_passages(seen["passages"][0]).collect()}
    for r in seen["passages"][1].collect():
        assert r.text == cleaned[r.doc_id] and r.n_chars == len(r.text)
    assert set(ids["mixing"][1]) <= set(ids["mixing"][0])
    assert ids["encoding"][0] == ids["encoding"][1]
    whole = corpus_pipeline.run(spark, data)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_awkward_rows_and_empty_tables(spark):
    rows = [(i, t, "en", "a") for i, t in AWKWARD]
    rows += [(100 + i, "the of and to in is " * 8 + str(i), "en", None) for i in range(60)]
    for docs in (documents(spark, rows, extra=True), documents(spark, [])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = write_once(stage(spark, docs, ""))
            assert name == "encoding" or docs.columns == columns
