"""Parser and URL fidelity: linear time, CDATA, ext-link, ECMAScript whitespace, dot segments, IDN, raw spaces."""

import time

from conftest import one
from pyspark.sql import functions as F

from quarry.functions import markup as M
from quarry.functions import text as X
from quarry.functions.urls import resolve_url
from quarry.operators.copies import usable_jats
from quarry.operators.pages import dataset_links, parse_pages
from quarry.sources.keywords import keyword_lines


def test_parse_time_grows_with_length():
    nested = lambda n: "<div><a href='/x'>t</a>" * n + "</div>" * n
    siblings = lambda n: "<table><tr><td>1</td></tr></table>" * n
    stray = lambda n: "<p>" * 1 + "<i>" * n + "</b>" * n

    def seconds(make, n):
        page, t = make(n), time.process_time()
        root = M.parse(page)
        M.html_tables(root), M.anchors(root, "https://e.org/")
        return time.process_time() - t

    for make in (nested, siblings, stray):
        seconds(make, 500)
        small = min(seconds(make, 3000) for _ in range(3))
        assert min(seconds(make, 6000) for _ in range(3)) < 3 * small + 0.05


def test_cdata_is_text_in_full_text_only():
    t = M.jats_tables(M.parse("<article><table-wrap><table><tr><td><![CDATA[x < y]]></td><td>b</td></tr></table></table-wrap></article>", True))
    assert t[0]["grid"] == [["x < y", "b"]]


def test_ecmascript_whitespace():
    assert M.norm_ws("\x1ca\x85b  c﻿") == "\x1ca\x85b c"


def test_caption_is_not_cut():
    long = "word " * 200
    t = M.html_tables(M.parse(f"<p>{long}</p><table><tr><td>1</td></tr></table>"))
    assert t[0]["caption"] == long.strip()


def test_urls():
    r = lambda h: resolve_url(h, "https://x.org/a/b?q")
    assert r("https://x.org/a/../b") == "https://x.org/b"
    assert r("../../c/./d/%2E%2e/e") == "https://x.org/c/e"
    assert r("https://bücher.example/ü") == "https://xn--bcher-kva.example/%C3%BC"
    assert r("https:\\\\y.org\\p") == "https://y.org/p" and r("#z") == "https://x.org/a/b?q#z"
    assert r("http://[bad") is None


def test_file_name_of_url_with_raw_space(spark):
    name = lambda u: one(spark, X.file_name_from_url(F.col("u")), u=u)
    assert name("https://x.org/d/my file.csv") == "my file.csv"
    assert name("https://x.org/d/a%20b.csv?x=1") == "a b.csv" and name("no url") == ""


def test_ext_link_in_html(spark):
    page = spark.createDataFrame([("https://e.org/", '<p><ext-link xlink:href="https://zenodo.org/records/5">data</ext-link></p>')], "url string, html string")
    got = dataset_links(parse_pages(page.withColumn("id", F.lit(1)), keep=["id", "url"]), ["id"]).collect()
    assert [(r.url, r.text) for r in got] == [("https://zenodo.org/records/5", "data")]


def test_stub_full_text_is_not_usable(spark):
    rows = [("a", '<article><counts><fig-count count="0"/></counts></article>'), ("b", "<article><fig id='1'>x</fig></article>"), ("c", "<article><table-wrap/></article>"), ("d", None)]
    assert {r.id for r in usable_jats(spark.createDataFrame(rows, "id string, body string")).collect()} == {"b", "c"}


def test_keyword_lines_with_cr_and_tabs(spark):
    df = spark.createDataFrame([(1, "LNG price\r\n\r\n\t# tabbed comment\r\n  fuel \t\r\n#x")], "i int, t string")
    assert [(r.line_no, r.keyword) for r in keyword_lines(df, "t", ["i"]).collect()] == [(0, "LNG price"), (3, "fuel")]


def test_plain_tags_take_one_pattern_and_no_walk(monkeypatch):
    """A tag as most are written isn't tokenized twice, and what is in an element is a stretch of the page's lists."""
    def slow(*a):
        raise AssertionError("the general way")
    page = '<body class="x"><table><tr><th>a<td>1 &lt; 2</td></table><script>if (a < b) "<p>"</script><a href="/q" title="t">go</a><p>end'
    want = M.html_tables(M.parse(page)), M.anchors(M.parse(page), "https://e.org/x")
    with monkeypatch.context() as m:
        m.setattr(M.HTMLParser, "parse_starttag", slow)
        root = M.parse(page)
    assert (M.html_tables(root), M.anchors(root, "https://e.org/x")) == want
    assert want[0][0]["grid"] == [["a", "1 < 2"]] and want[1][0]["url"] == "https://e.org/q" and want[1][0]["raw_text"] == "go"
    assert [n.tag for n in root.iter()] == ["body", "table", "tr", "th", "td", "script", "a", "p"]
    assert root.find("td").text() == "1 < 2" and root.find("a").find("td") is None and root.text().endswith('if (a < b) "<p>"goend')
    assert [n.tag for n in root.find("table").iter({"th", "td"})] == ["th", "td"] and list(root.find("script").iter()) == []
    for tag in ('<A HREF="/q">', "<a href='/q'>", '<a href="/q&amp;r">', "<a  href=/q >", '<a href="/q"/>'):
        assert M.anchors(M.parse(tag + "x</A >"), "https://e.org/x")[0]["url"].startswith("https://e.org/q")


def test_plain_and_odd_tags_mixed(monkeypatch):
    """Plain tags by one pattern give the page that the tokenizer gives alone, whatever stands between them."""
    import random
    rng = random.Random(11)
    parts = ["<table>", "<TD>", "</td >", "<td>", "<tr>", "</table>", "<!-- <table> -->", "<!-->", "<!-- a -- b -->", "<!doctype html>", "<?p?>", "<script>", "</script>", "<title>", "</title>",
             '<a title="<b>" href="/x">', '<a href="/a&amp;b">', "</a>", "<p it's>", "</p x='1'>", "&lt;", "&", "a < b", "<br/>", '<figure class="table caption">', "</figure>", "<h3>", "<article>", "text", "<"]
    pages = [("".join(rng.choices(parts, k=rng.randrange(14))), bool(k % 2)) for k in range(3000)]

    def read():
        return [(M.html_tables(r), M.html_figures(r, "https://e.org/"), M.anchors(r, "https://e.org/x"), r.text(), [(n.tag, n.attrs, n.first, n.last) for n in r.iter()])
                for r in (M.parse(p, xml) for p, xml in pages)]
    mixed = read()
    stepped = []
    step = M.HTMLParser.goahead

    def alone(self, end):
        stepped.append(end)
        return step(self, end)
    monkeypatch.setattr(M._Builder, "goahead", alone)
    assert read() == mixed and stepped


def test_a_plain_page_takes_no_step_of_the_tokenizer(monkeypatch):
    steps = []
    for name in ("parse_starttag", "parse_endtag", "parse_comment"):
        monkeypatch.setattr(M._Builder, name, lambda self, i, name=name: steps.append(name) or -1, raising=False)
    root = M.parse('<html><body title="<table>"><!-- <table> --><table><tr><td class="a">1</td><td>2</td></tr></table></body></html>')
    assert [n.tag for n in root.iter()] == ["html", "body", "table", "tr", "td", "td"] and not steps
