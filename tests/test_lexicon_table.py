"""A lexicon as a table: equal to the pattern form, term by term, and fit for many terms."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.lexicon import Lexicon, matched_penalties, matched_terms
from quarry.operators import lexicon_table as L
from quarry.operators.scoring import RELEVANCE_COLUMNS, score_candidates
from quarry.plans.fixtures import CORPUS_LEXICON
from quarry.sources.tables import documents_as_candidates

TERMS = ["fuel oil", "fuel", "oil", "jet a-1", "a-1", "c++", ".net", "lng", "café", "a - b", "oil price", "fuel oil price", "x.y", "1", "net.", "(oil)"]


def texts():
    rng = random.Random(7)
    bits = ["fuel", "FUEL", "oil", "Oil", "jet", "a-1", "a", "b", "c++", ".net", "net", "lng", "long", "café", "price", "x.y", "x", "1", "(oil)",
            " ", " ", "  ", "\n", " ", "-", " - ", ",", ".", "+", "é", "K", "(", ")"]
    return ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(1500)] + ["", None, "oil " * 2000, "c++", ".net", "c++c++", "..net"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_equal_to_the_pattern(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(L, "BROADCAST_CHARS", -1)
    df = spark.createDataFrame(list(enumerate(texts())), "id int, text string").repartition(4)
    lexicon = spark.createDataFrame([("f", k, t, "term") for k, t in enumerate(TERMS)] + [("f", 99, " Fuel ", "term"), ("f", 98, " ", "term")], L.LEXICON_SCHEMA)
    got = {r.id: r.terms for r in L.matched_by_facet(df, lexicon, ["id"]).collect()}
    want = {r.id: r.t for r in df.select("id", matched_terms(F.col("text"), TERMS).alias("t")).collect()}
    assert {k: got.get(k, []) for k in want} == want
    assert sum(map(len, want.values())) > 1500


def test_stems(spark):
    df = spark.createDataFrame(list(enumerate(["transcriptomic fuel", "a strategy", "long-strat", "Rheological!", "xrheolog", "", "strat"])), "id int, text string")
    terms, stems = ["fuel", "strategy"], ["transcriptom", "rheolog", "strat"]
    lexicon = spark.createDataFrame([("p", k, t, "term") for k, t in enumerate(terms)] + [("p", 2 + k, s, "stem") for k, s in enumerate(stems)], L.LEXICON_SCHEMA)
    got = {r.id: r.terms for r in L.matched_by_facet(df, lexicon, ["id"]).collect()}
    want = {r.id: r.t for r in df.select("id", matched_penalties(F.col("text"), terms, stems).alias("t")).collect()}
    assert {k: got.get(k, []) for k in want} == want


@pytest.mark.parametrize("lexicon", [CORPUS_LEXICON, Lexicon.reference()])
def test_score_is_the_patterns(spark, lexicon):
    docs = documents_as_candidates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    extra = spark.createDataFrame([("Bangladesh LNG import dataset", ""), ("Jet A-1 demand", "Mongla"), ("Spent fuel storage in Bangladesh", None), ("", "the que")], "title string, abstract string")
    df = docs.select("item_ord", "title", "abstract").unionByName(extra.select((-F.monotonically_increasing_id() - 1).alias("item_ord"), "title", "abstract"))
    rows = lambda d: sorted(tuple(map(str, r)) for r in d.select("item_ord", *RELEVANCE_COLUMNS).collect())
    assert rows(L.score_by_table(df, L.lexicon_rows(spark, lexicon), "item_ord")) == rows(score_candidates(df, lexicon))


def test_many_terms(spark):
    rng = random.Random(1)
    words = ["w%d" % k for k in range(3000)]
    terms = list({" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(52_000)})[:50_000]
    lexicon = spark.createDataFrame([("f", k, t, "term") for k, t in enumerate(terms)], L.LEXICON_SCHEMA)
    docs = [(k, " ".join(rng.choices(words, k=60))) for k in range(200)]
    got = {r.id: set(r.terms) for r in L.matched_by_facet(spark.createDataFrame(docs, "id int, text string"), lexicon, ["id"]).collect()}
    known = set(terms)
    for k, text in docs:
        own = text.split()
        assert got.get(k, set()) == {g for n in (1, 2, 3) for i in range(len(own) - n + 1) if (g := " ".join(own[i : i + n])) in known}


def test_refused_terms(spark):
    for rows in ([("f", 0, "++", "term")], [("f", 0, "a-b", "stem")]):
        with pytest.raises(ValueError):
            L.index_lexicon(spark.createDataFrame(rows, L.LEXICON_SCHEMA))
    empty = spark.createDataFrame([], L.LEXICON_SCHEMA)
    df = spark.createDataFrame([(1, "a b")], "id int, text string")
    assert L.matched_by_facet(df, empty, ["id"]).collect() == []


def test_runs_of_words_are_read_by_patterns(spark):
    """Without edges and stems a text's keys come from one pattern a size, with what stands between the words."""
    from quarry.operators import lexicon_table as L
    rows = [("f", 0, "a b", "term"), ("f", 1, "b-c d", "term"), ("f", 2, "d", "term"), ("f", 3, "c d e", "term")]
    index = L.index_lexicon(spark.createDataFrame(rows, L.LEXICON_SCHEMA))
    assert "regexp_extract_all" in str(L._keys(index)) and "lambda" not in str(L._keys(index)).lower()
    texts = spark.createDataFrame([(0, "A  b-C\td"), (1, "ab b - c d e"), (2, ""), (3, None), (4, "d"), (5, "a b a b")], "i int, text string")
    got = {(r.i, r.term) for r in L.lexicon_hits(texts, index, ["i"]).collect()}
    assert got == {(0, "a b"), (0, "b-c d"), (0, "d"), (1, "d"), (1, "c d e"), (4, "d"), (5, "a b")}
