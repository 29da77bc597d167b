"""Language identification: held-out accuracy, what it may look at, awkward rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from graphload.llm import language
from helpers import AWKWARD, documents


def test_subwords():
    buckets, cuts = language.subwords(pa.array(["a bc", None, "Def", "..", ""]))
    assert [c.tolist() for c in cuts] == [[0, 3, 3, 6, 6, 6], [0, 1, 1, 3, 3, 3]]
    alone = language.subwords(pa.array(["Def"]))[0]
    assert [b[3:6].tolist() for b in buckets[:1]] == [alone[0].tolist()]
    # upper and lower case and the separators make no difference
    assert np.array_equal(language.subwords(pa.array(["DEF"]))[0][0], alone[0])
    assert np.array_equal(language.subwords(pa.array(["\tdef,"]))[0][0], alone[0])


def test_held_out(spark, data):
    found = language.op2_language_id(spark, "/root/testdata/sf0.01").cache()
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(known, "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98
    assert found.filter("score < 0 or score > 1").isEmpty()
    assert found.filter("rejected").count() <= 0.01 * found.count()


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows = [(i, ("the of and to " if i % 2 else "der die und das ") * 5, "en" if i % 2 else "de")
            for i in range(200)]
    docs = documents(spark, rows)
    learn = language.fold(F.col("doc_id")) != 2
    other = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("xx"))
    a, b = language.train(docs, learn), language.train(other, learn)
    assert a.languages == b.languages == ("de", "en")
    assert np.array_equal(a.buckets, b.buckets)
    found = language.predict(other, a, ["doc_id", "lang"])
    assert found.filter("lang <> 'xx' and lang <> lang_pred").isEmpty()


def test_awkward(spark):
    train = documents(spark, [(i, "the of and " * 9, "en") for i in range(60)]
                      + [(i + 100, "der die das " * 9, "de") for i in range(60)]
                      + [(500, "text", None), (None, "text", "fr"), (501, None, "fr"), (502, "", "fr")])
    model = language.train(train, F.lit(True))
    assert model.languages == ("de", "en")
    docs = documents(spark, AWKWARD, extra=True)
    found = language.predict(docs, model, docs.columns)
    assert found.columns == docs.columns + ["lang_pred", "score", "rejected"]
    rows = found.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == none
        assert not none or (r.score == 0 and r.rejected)
    nothing = language.train(documents(spark, []), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.predict(documents(spark, []), model, ["doc_id"]).count() == 0


def test_small_tables_are_calibrated_too(spark):
    """Ten documents, or one, go the same way as thousands."""
    rows = [(i, ("the of and to " if i % 2 else "der die und das ") * 5, "en" if i % 2 else "de")
            for i in range(10)]
    model = language.train(documents(spark, rows), F.lit(True))
    assert model.languages == ("de", "en") and 0 < model.level <= language.SURE
    p = model.probabilities(pa.array(["the of and the to", "der die und das"]))
    assert p.argmax(axis=1).tolist() == [1, 0]
    one = language.train(documents(spark, rows[:1]), F.lit(True))
    assert one.languages == ("de",) and one.level == language.SURE


def test_repeated_ids_neither_fill_nor_empty_the_sample(spark):
    """6000 rows of one id: alike they count once, with other texts they meet the bound."""
    same = [(7, "der die und das " * 3, "de")] * 6000
    others = [(i, f"the of and to {i}", "en") for i in range(300)]
    for text in ("der die und das", None):
        docs = documents(spark, [(i, text or f"{t} {n}", g) for n, (i, t, g) in enumerate(same)]
                         + others)
        found = language.learning_rows(docs, F.lit(True), 100, 150).groupBy("lang").count()
        counts = {r.lang: r["count"] for r in found.collect()}
        assert counts == ({"de": 1, "en": 100} if text else {"de": 75, "en": 75})
    # whatever the id, its language is learned
    for i in range(8):
        docs = documents(spark, [(i, "der die und das", "de")] * 50)
        assert language.learning_rows(docs, F.lit(True), 5, 9).count() == 1


def test_probabilities_against_a_plain_loop():
    """The mean of the embeddings of all windows of each text, one by one."""
    rng = np.random.default_rng(3)
    texts = ["The quick fox", "", None, "ééé 123 zzz", "a", "lang " * 400]
    for width, weights in ((3, None), (5, rng.normal(size=(5, 3)))):
        model = language.LanguageModel(("x", "y", "z"), rng.normal(size=(1 << language.BITS, width)),
                                       weights, rng.normal(size=3), 1.7, 0.1)
        expected = []
        for text in texts:
            buckets, _ = language.subwords(pa.array([text], pa.string()))
            own = np.concatenate(buckets)
            mean = sum((model.buckets[b] for b in own), np.zeros(width)) / max(1, len(own))
            scores = ((mean if weights is None else mean @ weights) + model.bias) / 1.7
            e = np.exp(scores - scores.max())
            expected.append(e / e.sum())
        assert np.allclose(model.probabilities(pa.array(texts)), np.array(expected))
