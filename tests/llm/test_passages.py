"""Repeated passages: units, which occurrence stays, offsets, awkward rows."""

import random

import numpy as np
import xxhash

from graphload.llm import passages
from helpers import AWKWARD, documents


def plain(rows, unit_words, min_words):
    """Expected text of every (doc_id, text), by sorting all places of all units."""
    first = {}
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    for unknown, i, text in order:
        for n, (_, _, words) in enumerate(passages.units(text)):
            if len(words) >= unit_words:
                place = (unknown, i, text, n)
                key = " ".join(words)
                first[key] = min(first.get(key, place), place)
    out = {}
    for i, text in rows:
        if text is None:
            continue
        found = list(passages.units(text))
        again = {n for n, (_, _, w) in enumerate(found) if len(w) >= unit_words
                 and first[" ".join(w)] != (i is None, i or 0, text, n)}
        out[i, text] = passages.cleaned(text, again, unit_words, min_words)[0]
    return out


def test_units():
    text = "  One two. Three!? four\n\n five.six ...\nSeven"
    found = list(passages.units(text))
    assert [text[a:b] for a, b, _ in found] == ["One two.", "Three!?", "four", "five.six ...", "Seven"]
    assert found[0][2] == ["one", "two."]
    assert list(passages.units("")) == list(passages.units(" \n ")) == []


def test_passage_inside_other_text(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    say = lambda n: " ".join(word() for _ in range(n)) + "."
    shared = " ".join([say(20), say(3), say(25), say(15)])
    rows = []
    for i in range(30):
        own = [say(9) for _ in range(4)]
        if i % 3 == 0:
            own.insert(2, shared)
        rows.append((i, "\n".join(own) if i % 2 else " ".join(own)))
    rows.append((100, "Short line here. " + say(5) + " Short line here."))
    got = {r.doc_id: r for r in passages.dedup_passages(documents(spark, rows)).collect()}
    expected = plain(rows, passages.UNIT_WORDS, passages.MIN_WORDS)
    for i, text in rows:
        assert got[i].text == expected[i, text]
        gone = [text[s.start:s.start + s["size"]] for s in got[i].removed]
        assert gone == ([shared] if i % 3 == 0 and 0 < i < 100 else [])
        assert got[i].removed_words == sum(len(g.split()) for g in gone)
    assert shared in got[0].text


def test_random(spark):
    rng = random.Random(4)
    lines = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(12)]
    rows = [(i if rng.random() < 0.9 else None,
             "".join(rng.choice(lines) + rng.choice([". ", "\n", "!\n", " "]) for _ in range(8)))
            for i in range(60)]
    rows += rows[:9]
    found = passages.dedup_passages(documents(spark, rows), 2, 5).collect()
    assert len(found) == len(rows)
    expected = plain(rows, 2, 5)
    left = sorted((-1 if i is None else i, expected[i, t]) for i, t in rows)
    # rows without an id rank last, among each other by a hash
    assert sorted((r.doc_id, r.text) for r in found if r.doc_id is not None) == [
        x for x in left if x[0] >= 0]


def test_awkward(spark):
    docs = documents(spark, AWKWARD, extra=True)
    found = passages.dedup_passages(docs)
    assert found.columns == [c for c in docs.columns if c != "n_units"] + [
        "n_units", "removed_words", "removed"]
    rows = found.collect()
    assert len(rows) == len(AWKWARD)
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted(
        (i or 0, t or "") for i, t in AWKWARD)
    assert passages.dedup_passages(documents(spark, [])).count() == 0


def test_short_repeated_line_goes(spark):
    rows = [(i, f"Own words of text {i} here.\nRead more about this.\nLast words of {i} there.")
            for i in range(5)]
    got = {r.doc_id: r for r in passages.dedup_passages(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 5):
        assert "Read more" not in got[i].text and got[i].removed_words == 4
        assert got[i].text.split() == f"Own words of text {i} here. Last words of {i} there.".split()


def test_scripts_without_blanks(spark):
    chinese = "这一段文字在每一篇文章里都会出现而且足够长所以后面的应当去掉。"
    line = "これはどの文書にもある長い一行であり句点がなくても二度目からは消える"
    thai = "ข้อความนี้ปรากฏในทุกเอกสารและยาวพอที่จะถูกลบออก"
    hindi = "यह वाक्य हर दस्तावेज़ में आता है।"
    arabic = "هل تظهر هذه الجملة في كل وثيقة؟"
    rows = [(i, f"第{i}篇自己的话不同。{chinese}{'甲乙丙丁'[i]}写了另外一句话。\n{line}\n{thai}\n{hindi}{arabic}本文{i}")
            for i in range(4)]
    assert [rows[0][1][a:b] for a, b, _ in passages.units(rows[0][1])] == [
        "第0篇自己的话不同。", chinese, "甲写了另外一句话。", line, thai, hindi, arabic, "本文0"]
    assert [w for _, _, w in passages.units("他说：「好。」走了。")] == [["他说：「好。」"], ["走了。"]]
    got = {r.doc_id: r for r in passages.dedup_passages(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 4):
        assert "".join(got[i].text.split()) == f"第{i}篇自己的话不同。{'甲乙丙丁'[i]}写了另外一句话。本文{i}"


def test_passage_cut_inside_sentences(spark):
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    inside = say(50)
    across = say(18) + ". " + say(14) + ". " + say(9)
    signs = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    rows = [(i, f"{say(8)} {inside} {say(8)}.\n{say(5)} {across} {say(7)}.\n{say(2)}山{i}{signs}{i}川")
            for i in range(4)]
    got = {r.doc_id: r for r in passages.dedup_passages(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 4):
        gone = [rows[i][1][s.start:s.start + s["size"]] for s in got[i].removed]
        assert gone[:2] == [inside, across]
        assert gone[2:] == [signs]
    # a few words beside a repeated line are no passage
    line = say(20) + "."
    rows = [(1, f"{line} The cat {say(9)}."), (2, f"{line} The cat {say(9)}.")]
    got = {r.doc_id: r.text for r in passages.dedup_passages(documents(spark, rows)).collect()}
    assert got[2] == rows[1][1][len(line) + 1:]


def test_removed_spans_tell_all_that_went(spark):
    """The original text without the spans and the blanks behind them is the cleaned text."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    changed = 0
    for r in passages.dedup_passages(docs).collect():
        left, done = [], 0
        for span in r.removed:
            left.append(texts[r.doc_id][done:span.start])
            done = span.start + span["size"] + span.blanks
        left.append(texts[r.doc_id][done:])
        assert "".join(left) == r.text
        changed += bool(r.removed)
    assert changed > 100


def plain_windows(words):
    """Places of the windows that stand for a text, window by window and group by group."""
    w, least = passages.WINDOW, passages.WINDOW_DISTINCT
    alone = [passages.windows(np.array([xxhash.xxh3_64_intdigest(x) for x in words[i:i + w]],
                                       np.uint64), np.array([w])) for i in range(len(words) - w + 1)]
    value = [None if len(set(words[i:i + w])) < least else int(a[1].view(np.uint64)[0])
             for i, a in enumerate(alone)]
    groups = [range(i, i + passages.GROUP) for i in range(len(value) - passages.GROUP + 1)]
    chosen = set()
    for group in groups or [range(len(value))]:
        fine = [(value[i], i) for i in group if value[i] is not None]
        if fine:
            chosen.add(min(fine)[1])
    return sorted(chosen)


def test_windows_of_many_texts_at_once():
    rng = random.Random(2)
    texts = [[f"w{rng.randrange(rng.choice([5, 30, 3000]))}" for _ in range(n)]
             for n in (0, 15, 16, 20, 47, 48, 90, 3, 200, 16)]
    each = np.array([xxhash.xxh3_64_intdigest(x) for t in texts for x in t], np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    at, high, low = passages.windows(each, ends)
    begins = ends - [len(t) for t in texts]
    expected = [int(b) + i for b, t in zip(begins, texts) for i in plain_windows(t)]
    assert at.tolist() == expected and len(set(zip(high.tolist(), low.tolist()))) == len(at)


def test_growth_against_a_plain_search(spark):
    """Of random texts that share a run of 60 words or more, what goes is a common run that no
    word beside it continues, but for pieces of sentences too short for a unit."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    shared = [word() for _ in range(80)]
    rows, kept = [], {}
    for i in range(12):
        before, after = [word() for _ in range(rng.randint(0, 30))], [word() for _ in range(20)]
        first, last = (0, 80) if not i else (rng.randint(0, 20), rng.randint(68, 80))
        rows.append((i, " ".join(before + shared[first:last] + after)))
        kept[i] = " ".join(before + after) if i else rows[0][1]
    got = {r.doc_id: r for r in passages.dedup_passages(documents(spark, rows)).collect()}
    assert {i: got[i].text for i in got} == kept
