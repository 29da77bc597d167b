import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphload.functions import (
    escape_text, is_numeric_id, jtrim, prefix_id, quote_name, quote_text, unsentinel, wrap_policy,
)


def test_trim_removes_control_characters_only_at_the_ends(spark):
    texts = [" a b ", "\t\na\r\n", "\x00x\x1f", "a\u0085", " a ", "", "   ", None,
             "é ", " \u0085"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        jtrim("t"), jtrim("t", text=False)).collect()
    blanks = "".join(map(chr, range(33)))
    assert [r[0] for r in got] == [t if t is None else t.strip(blanks) for t in texts]
    assert [r[1] for r in got] == texts


def test_trim_takes_other_types(one):
    assert one(jtrim("n"), n=(12, "bigint")) == "12"


def _escaped(text):
    out = text.replace("\\", "\\\\")
    for plain, code in (("\t", "t"), ("\n", "n"), ('"', '"'), ("'", "'"), ("\r", "r"), ("\b", "b")):
        out = out.replace(plain, "\\" + code)
    return out


def test_escape_matches_brute_force(spark):
    found = []

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("ab\\\t\n\"'\r\b 中é")), max_size=30))
    def gather(text):
        found.append(text)

    gather()
    rows = spark.createDataFrame([(t,) for t in found], "t string").select(
        "t", escape_text("t").alias("e"), quote_text("t").alias("q")).collect()
    for row in rows:
        assert row.e == _escaped(row.t)
        assert row.q == '"' + _escaped(row.t) + '"'


@pytest.mark.parametrize("text, loose, strict", [
    ("123456", True, True), ("0123456", True, True), ("-123456", True, True), ("000", True, True),
    ("aaa", False, False), ("0123aaa", False, False), ("123a8", False, False),
    ("", True, False), ("-", True, False), ("--1", False, False), ("1\n", False, False),
    ("+1", False, False), ("1.5", False, False),
])
def test_numeric(one, text, loose, strict):
    assert one(is_numeric_id("t"), is_numeric_id("t", strict=True), t=(text, "string")) == (
        loose, strict)


def test_names_keep_their_symbols():
    names = ["col1", "a b", "x-y", "中文"]
    assert [quote_name(n) for n in names] == ["`col1`", "`a b`", "`x-y`", "`中文`"]
    with pytest.raises(ValueError):
        quote_name("`")


def test_marker_prefix_and_policy(one):
    assert one(unsentinel("t", "NIL"), unsentinel("t", None), t=("NIL", "string")) == ("", "NIL")
    assert one(prefix_id("n", "src"), prefix_id("n", None), n=(1, "int")) == ("src_1", "1")
    assert one(wrap_policy("t", "hash"), wrap_policy("t", "uuid"), wrap_policy("t", None),
               t=("a", "string")) == ('hash("a")', 'uuid("a")', "a")
    with pytest.raises(ValueError):
        wrap_policy(F.lit("a"), "md5")
