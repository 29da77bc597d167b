"""URL filters: parsing, rules, and scores against dense power iteration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphload.llm import urls


@pytest.mark.parametrize("url, host, path", [
    ("https://A.Example.ORG/En/1?x#y", "a.example.org", "/En/1"),
    ("http://example.com", "example.com", ""), ("x://h?q/p", "h", ""), ("x://h#/p", "h", ""),
    ("no scheme/at all", "", ""), (None, "", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"),
    ("://h/p\nq", "h", "/p\nq"), ("http://ÉX.org/", "Éx.org", "/"),
])
def test_parse(one, url, host, path):
    assert one(urls.host_of(F.col("u")), urls.path_of(F.col("u")), u=(url, "string")) == (host, path)


@pytest.mark.parametrize("host, path, rule", [
    ("a.org", "/x", "org/"), ("org", "/", "org/"), ("aorg", "/", None), ("a.org", "", None),
    ("example.org", "/es/1", "example.org/es/"), ("b.example.org", "/en/12", "example.org/en/1"),
    ("bexample.org", "/es/1", "org/"), ("example.org", "/es", "org/"), ("x.com", "/fr/", "com/fr/"),
    ("x.com", "/de/a", "com/de/"), ("x.net", "/de/a", None), ("", "", None),
])
def test_rules(one, host, path, rule):
    assert one(urls.rule_of(F.col("h"), F.col("p")), h=(host, "string"), p=(path, "string")) == rule


def dense(hosts, edges, seeds, damping=urls.DAMPING):
    at = {h: i for i, h in enumerate(hosts)}
    m, s = np.zeros((len(hosts), len(hosts))), np.zeros(len(hosts))
    for a, b, n in edges:
        m[at[b], at[a]] += n
    for h, n in seeds.items():
        s[at[h]] += n
    s /= s.sum()
    out = m.sum(axis=0)
    r = s.copy()
    for _ in range(300):
        spread = (m / np.where(out > 0, out, 1)) @ r
        r = damping * spread + (1 - damping + damping * r[out == 0].sum()) * s
    return dict(zip(hosts, r))


def test_scores(spark):
    pages = [
        (1, "http://good.com/fr/a", '<a href="http://friend.net/x">f</a><A HREF=//deep.net>d</A>'),
        (2, "http://friend.net/", "<a class=x href='https://deep.net/y'>d</a> <a href='/own'>o</a>"),
        (3, "http://farm.net/", '<a href="http://bad.com/z"> <a href="http://bad.com/q">'),
        (4, "http://bad.com/de/p", '<a href="http://worse.net/">'),
        (5, "http://worse.net/", '<a href="http://farm.net">'),
        (6, "http://deep.net/", None), (7, None, "<a href=http://bad.com/>"),
        (8, "http://alone.net/", "no links"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(frame).collect()}
    edges = [("good.com", "friend.net", 1), ("good.com", "deep.net", 1), ("friend.net", "deep.net", 1),
             ("farm.net", "bad.com", 2), ("bad.com", "worse.net", 1), ("worse.net", "farm.net", 1)]
    hosts = sorted({h for a, b, _ in edges for h in (a, b)})
    trust = dense(hosts, edges, {"good.com": 1})
    distrust = dense(hosts, [(b, a, n) for a, b, n in edges], {"bad.com": 1})
    for page, host in ((1, "good.com"), (2, "friend.net"), (3, "farm.net"), (4, "bad.com"),
                       (5, "worse.net"), (6, "deep.net")):
        assert got[page].trust == pytest.approx(trust[host], abs=1e-4)
        assert got[page].distrust == pytest.approx(distrust[host], abs=1e-4)
    assert [got[p].verdict for p in range(1, 9)] == [
        "allow", "allow", "block", "block", "block", "allow", "allow", "allow"]


def test_awkward(spark):
    schema = "page_id long, url string, html string, host string, trust int"
    rows = [(1, "http://x.org/a", "", "h", 1)] * 2 + [(None, None, None, None, None),
                                                       (2, "x" * 50000, "y" * 200000, "", 0)]
    got = urls.judge(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [
        (0, "allow"), (1, "allow"), (1, "allow"), (2, "allow")]
    assert urls.judge(spark.createDataFrame([], schema)).count() == 0
