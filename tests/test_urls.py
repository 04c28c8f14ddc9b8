"""The Column form against the Python form and against values of the standard's own rules."""

import random

from pyspark.sql import functions as F

from quarry.functions.urls import beyond_ascii_host, resolve_href, resolve_url
from quarry.operators.pages import absolute_links

GOLDEN = [
    ("a//b", "https://x.org/c/d", "https://x.org/c/a//b"),
    ("p?", "https://x.org/", "https://x.org/p?"),
    ("#", "https://x.org/a?q#f", "https://x.org/a?q#"),
    ("", "https://x.org/a?q#f", "https://x.org/a?q"),
    ("?n", "https://x.org/a/b?q", "https://x.org/a/b?n"),
    ("http:foo", "http://x.org/a/b", "http://x.org/a/foo"),
    ("http:foo", "https://x.org/a/b", "http://foo/"),
    ("https:///y.org/p", "https://x.org/", "https://y.org/p"),
    ("\\\\Y.org\\p", "https://x.org/", "https://y.org/p"),
    ("../../../c/./%2E%2e/e/..", "https://x.org/a/b", "https://x.org/"),
    ("HTTPS://U:p@Y.ORG:0443/ü b?ü'#ü`", None, "https://U:p@y.org/%C3%BC%20b?%C3%BC%27#%C3%BC%60"),
    ("//@y.org:8080", "http://x.org", "http://y.org:8080/"),
    ("https://[::1]:443/x", "", "https://[::1]/x"),
    ("mailto:A@b", "https://x.org/", "mailto:A@b"),
    (" /a\tb\n ", "https://x.org/q", "https://x.org/ab"),
    ("\U0001f600", "https://x.org/q/", "https://x.org/q/%F0%9F%98%80"),
    ("https://x y/", "https://x.org/", None), ("https://x:99999/", "https://x.org/", None), ("https://x:1a/", "https://x.org/", None),
    ("http://[bad", "https://x.org/", None), ("/a", None, None), ("/a", "data", None), ("a", "mailto:x", None), (None, "https://x.org/", None),
    ("https://", "http://x.org/", None),
]


def _rows(spark, pairs):
    df = spark.createDataFrame([(k, h, b) for k, (h, b) in enumerate(pairs)], "k int, h string, b string")
    got = df.select("k", resolve_href(F.col("h"), F.col("b")).alias("u"), beyond_ascii_host(F.col("h"), F.col("b")).alias("far")).collect()
    return {r.k: r for r in got}


def test_standard_values(spark):
    got = _rows(spark, [(h, b) for h, b, _ in GOLDEN])
    for k, (h, b, url) in enumerate(GOLDEN):
        assert resolve_url(h, b) == url, (h, b)
        assert got[k].u == url, (h, b)


def test_column_equals_python(spark):
    rng = random.Random(7)
    heads = ["", "/", "//", "///", "http:", "https://", "HTTP://", "ftp://", "wss:\\\\", "mailto:", "data:", "x", "..", ".", "?", "#", " ", "\\"]
    bits = ["a", "B c", "..", ".", "%2e", "%2E.", "", "/", "//", "?", "#", ":", "@", ":80", ":443", ":", "y.org", "ü", "😀", "[", "]", "[::1]", "\\", "\t", "'", "`",
            "{}", "%zz", "<", "|", "^", "~", "&amp", ";x", "=1", "+"]
    bases = [None, "", "https://x.org", "http://x.org/a/b;c?q=1#f", "https://U@x.org:8443/a//b/../c/", "mailto:x", "/rel", "ftp:\\\\f.org\\d", "https://ü.org/p"]
    pairs = [(rng.choice(heads) + "".join(rng.choice(bits) for _ in range(rng.randrange(7))), rng.choice(bases)) for _ in range(4000)]
    got = _rows(spark, pairs)
    near = 0
    for k, (h, b) in enumerate(pairs):
        if got[k].far:
            assert got[k].u is None, (h, b)
        else:
            near += 1
            assert got[k].u == resolve_url(h, b), (h, b)
    assert near > 3000 and sum(r.u is not None for r in got.values()) > 1500


def test_absolute_links_need_python_for_foreign_hosts_only(spark):
    rows = [(1, "/a b", "https://x.org/"), (2, "https://bücher.example/ü", None), (3, "https://xü /", None), (4, None, "https://x.org/"), (5, "/c", "https://bücher.example/")]
    stored = spark.createDataFrame(rows, "id int, raw_href string, page_url string")
    got = {r.id: r.url for r in absolute_links(stored, base="page_url").collect()}
    assert got == {1: "https://x.org/a%20b", 2: "https://xn--bcher-kva.example/%C3%BC", 3: None, 4: None, 5: "https://xn--bcher-kva.example/c"}
    plan = absolute_links(stored, base="page_url", foreign_hosts=False)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
    assert absolute_links(stored.limit(0), base="page_url").collect() == []
