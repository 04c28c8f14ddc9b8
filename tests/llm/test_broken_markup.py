"""Markup that never closes, deep records, ids with several vectors: linear time and defined results."""

import random
import re
import time

import pytest
from quarry.llm import ann, chat, extract, langid
from quarry.llm.dom import Page

_DROPPED = re.compile(r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[!/?a-zA-Z][^>]*>", re.S | re.I)
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)
_MARKED = re.compile(r"<(article|main)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)

PIECES = ["<script>", "</script >", "<style ", "<!--", "-->", ">", "<a b='", "\"", "'", "<article>", "<main x>", "</article>", "</MAIN >", "<p>", "text ", "< ", "<html lang=de>", "<HTML ", " lang = 'fr'", "</template>", "<template>", "\n"]


def test_scanners_are_the_patterns():
    rng = random.Random(9)
    for _ in range(20_000):
        page = "".join(rng.choices(PIECES, k=rng.randrange(12)))
        assert langid.page_text(page) == _DROPPED.sub(" ", page)
        found = _DECLARED.search(page)
        assert langid.declared_language(page) == (found[1].lower() if found else None), page
        marked = _MARKED.search(page)
        assert extract.marked_article(page) == (marked and (marked[1], page[: marked.start()], marked[2], page[marked.end() :])), page


@pytest.mark.parametrize("piece", ["<script ", "<script>", "<!-- ", "<a b='", "<a b=\"x", "<article>", "<article ", "<html ", "</script", "<a \">\" ", "< ", "<b ' <i \" "])
def test_time_grows_with_length(piece):
    for read in (langid.page_text, langid.declared_language, extract.marked_article, Page):
        took = []
        for n in (100_000, 400_000):
            page = "<script></script>" + piece * (n // len(piece))
            t = time.perf_counter()
            read(page)
            took.append(time.perf_counter() - t)
        assert took[1] < 0.3 + 4 * 2.3 * took[0], (read, piece, took)


def test_tags_after_unpaired_quotes():
    page = Page("<div><p>one</p><p class=\"x>two</p><p>three</p></div>")
    assert [text for _, text in page.runs][:1] == ["one"] and "three" in " ".join(t for _, t in page.runs)
    assert [t for _, t in Page("a <b").runs] == ["a <b"] and [t for _, t in Page("x <!-- y").runs] == ["x"]


def test_deep_records_are_raw():
    for record in ("[" * 200_000, '{"a":' * 900 + "1" + "}" * 900, '{"messages":' + "[" * 5000 + "]" * 5000 + "}", '{"messages": []}', '{"role": "user", "text": ' + "[" * 3000 + "]" * 3000 + "}"):
        turns = chat.turns_of(record)
        assert turns == [("raw", record)] or turns[0][0] == "user"


def test_ids_with_several_vectors_and_lengths(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (3, [0.0, 3.0]), (3, [1.0, 0.0]), (4, [-1.0, -1.0]), (40, [1.0, 1.0, 1.0]), (5, [2.0, 0.0, 0.0]), (60, [1.0, 2.0, 3.0, 4.0])]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got == {20: [(1, 3, 3.0), (2, 1, 2.0), (3, 4, -1.0)], 40: [(1, 5, 2.0)]}


def test_many_vectors_of_one_id(spark):
    """Thirty ids of ten vectors each: an id stands once in a list, with its nearest vector."""
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(6)]) for k in range(30) for _ in range(10)]
    got = [r for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() if r.query_id == 20]
    want = {}
    for k, v in rows:
        if k != 20:
            want[k] = max([want.get(k, -1e9), *(sum(a * b for a, b in zip(v, q)) for j, q in rows if j == 20)])
    best = sorted((-s, k) for k, s in want.items())[:20]
    assert [(r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r["rank"])] == [(k, round(-s, 9)) for s, k in best]
