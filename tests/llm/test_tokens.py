"""Token counts and ids against the library that defines them."""

import hashlib
import random
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from graphload.llm import bpe, tokenfst
from helpers import AWKWARD, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPEC = open(PATH, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokenfst.TokenCounter(SPEC)
CODEC = bpe.Codec(SPEC)
SMALL = bpe.Codec(SPEC, leaf=8)

PARTS = [*"abcstmdrevl'  \n\t\r1290.,!?-éßñ中文　\xa0́😀АБ\x1c\x85", "'s", "'ll", "'re", "''s",
         "<|endoftext|>", "  ", "\n\n", "the ", " of", chr(0x1C89), chr(0x558), "a" * 15, "=" * 30]


def ids(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def mixed_texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def long_texts():
    rng = random.Random(11)
    pieces = ["a" * 5000, "thetionand" * 900, " " * 3000, "é" * 1500, "中文字" * 700, "=-" * 2000,
              "".join(rng.choice("0123456789") for _ in range(5000)),
              "".join(rng.choice("etaoinshr") for _ in range(9000)), "\n" * 2500]
    joints = ["", " ", "\n", "  ", " \n", "\n\n", "'s", "1", "?", "<|endoftext|>"]
    return pieces + [rng.choice(pieces)[:rng.randint(400, 3000)] + rng.choice(joints)
                     + rng.choice(joints) + rng.choice(pieces)[:1500] for _ in range(80)]


@pytest.mark.parametrize("texts", [mixed_texts(1, 3000, 60), long_texts()], ids=["mixed", "long"])
def test_counts_and_ids(texts):
    expected = ids(texts)
    assert COUNTER.counts(pa.array(texts)).tolist() == [len(e) for e in expected]
    for codec in (CODEC, SMALL):
        found = codec.encode(pa.array(texts))
        assert [f.tolist() for f in found] == expected
        assert [codec.decode(f) for f in found] == LIBRARY.decode_batch(
            expected, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from([c for p in PARTS for c in p]), max_size=50), max_size=4))
def test_any_text(texts):
    expected = ids(texts)
    array = pa.array(texts, pa.string())
    assert COUNTER.counts(array).tolist() == [len(e) for e in expected]
    assert [f.tolist() for f in SMALL.encode(array)] == expected


def test_classes_of_all_characters():
    """The splitter's class of every assigned character, three ways."""
    classes, _ = tokenfst.char_classes()
    splitter = LIBRARY.pre_tokenizer
    for code in range(0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or code > 0x323AF and unicodedata.category(c) == "Cn":
            continue
        begins = {span[0] for _, span in splitter.pre_tokenize_str(f"a{c}1{c}!{c}")}
        kind = next((k for k, at in ((tokenfst.LETTER, 1), (tokenfst.NUMBER, 3),
                                     (tokenfst.OTHER, 5)) if at not in begins), tokenfst.SPACE)
        assert c == " " or classes[code] == kind, hex(code)


def test_chunks_compose():
    """Cutting inside pieces, at any size, changes no count, and states are made anew."""
    texts = long_texts()[:9] + mixed_texts(5, 20, 400)
    expected = COUNTER.counts(pa.array(texts)).tolist()
    chunk, most = tokenfst.CHUNK, tokenfst.MOST_STATES
    try:
        for tokenfst.MOST_STATES, size in ((most, 7), (500, 64)):
            counter = tokenfst.TokenCounter(SPEC)
            cut = tokenfst.chunks
            tokenfst.chunks = lambda s, b, e: cut(s, b, e, size)
            try:
                assert counter.counts(pa.array(texts)).tolist() == expected
            finally:
                tokenfst.chunks = cut
    finally:
        tokenfst.CHUNK, tokenfst.MOST_STATES = chunk, most


def test_pairs_of_tokens():
    """The quick rule for two tokens against encoding their bytes."""
    t, rng = COUNTER.transducer, random.Random(2)
    words = list(t.bytes_of)
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(3000)]
    pairs += list(t.merges)[:500]
    for a, b in pairs:
        text = t.bytes_of[a] + t.bytes_of[b]
        assert t._apart(a, b) == (t.encode([t.single[x] for x in text]) == [a, b])


def test_joins_grow_their_window():
    piece = b"=" * 700
    left, right = CODEC._pure([piece[:333], piece[333:]])
    assert CODEC.join([(left, right), ([], right)]) == [CODEC._pure([piece])[0], right]


def test_queries_and_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    expected = [ids([text or ""])[0] for _, text in AWKWARD]
    counted = tokenfst.token_counts(docs, PATH, docs.columns)
    assert counted.columns == docs.columns + ["n_bytes", "n_tokens", "over_limit"]
    key = lambda r: (r.doc_id or 0, r.text or "")
    plain = sorted(((i or 0, t or "", e) for (i, t), e in zip(AWKWARD, expected)))
    got = sorted(counted.collect(), key=key)
    assert [(r.n_tokens, r.n_bytes, r.over_limit) for r in got] == [
        (len(e), len(t.encode()), len(e) > 512) for _, t, e in plain]
    encoded = bpe.encode(docs, PATH, ["doc_id", "text", "row"])
    assert [r.ids for r in sorted(encoded.collect(), key=key)] == [e for _, _, e in plain]
    back = bpe.decode(encoded.withColumnRenamed("text", "was"), PATH, ["was"]).collect()
    assert all((r.was or "") == r.text for r in back)
    digests = sorted(bpe.round_trip(docs, PATH, ["doc_id", "text"]).collect(), key=key)
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests] == [
        (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
         hashlib.sha256(t.encode()).hexdigest()) for _, t, e in plain]
    for empty in (tokenfst.token_counts(documents(spark, []), PATH, ["doc_id"]),
                  bpe.round_trip(documents(spark, []), PATH, ["doc_id"])):
        assert empty.count() == 0


def test_whole_table(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    expected = dict(zip(texts, ids([t or "" for t in texts.values()])))
    for query in (tokenfst.op5_token_counts, bpe.op6_bpe):
        rows = query(spark, data).collect()
        assert {r.doc_id: r.n_tokens for r in rows} == {i: len(e) for i, e in expected.items()}
