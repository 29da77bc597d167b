"""Filter audit: contractions against documents walked through every order one by one."""

import itertools
import random
import re

import pytest

from graphload.llm import filteraudit
from helpers import AWKWARD, documents, words

LABEL = "doc_id long, quality int, toxic int"


def fails_of(text):
    found = words(text)
    return {"A": len(found) < 100, "B": 100 * len(set(found)) < 80 * len(found),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text))}


def plain(rows, labels):
    """Every figure by running the filters over the documents, order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        fails = fails_of(text)
        fails["E"] = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        docs.append((lang or "", {f for f in fails if fails[f]}, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in own if f in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in gone),
                    sum(d[3] for d in gone)]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def compared(spark, rows, labels, extra=False):
    docs = documents(spark, [(r[0], r[1], r[2]) for r in rows], extra)
    found = filteraudit.audited(docs, spark.createDataFrame(labels, LABEL)).collect()
    got = {(r.part, r.filter_order, r.step): [r[f] for f in filteraudit.FIGURES] for r in found}
    assert len(got) == len(found)
    assert got == plain(rows, labels)


@pytest.mark.parametrize("seed", range(2))
def test_random(spark, seed):
    rng = random.Random(seed)
    pieces = ["Ab", "CD", "e", "f#", "g h", "i\tj", "K", "l%", "m n o", "é"]
    texts = [" ".join(rng.choice(pieces) + str(rng.randrange(rng.choice([2, 400])))
                      for _ in range(rng.choice([3, 60, 130]))) for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "fr", None, ""])) for i in range(90)]
    labels = [(rng.randrange(120), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
              for _ in range(150)]
    compared(spark, rows, labels)


def test_awkward(spark):
    rows = [(r[0], r[1], lang) for r in AWKWARD for lang in ("en", None)]
    labels = [(1, 1, 0), (1, 1, 0), (None, 1, 1), (4, None, 1), (77, 1, 1)]
    compared(spark, rows, labels, extra=True)
    compared(spark, rows, [])


def test_empty(spark):
    docs = documents(spark, [])
    assert filteraudit.audited(docs, spark.createDataFrame([], LABEL)).isEmpty()


def test_many_parts(spark):
    """More parts than a task contracts at once."""
    rows = [(i, "A b " * (i % 3), f"l{i % 40}") for i in range(120)]
    compared(spark, rows, [(i, i % 2, i % 3 % 2) for i in range(120)])
