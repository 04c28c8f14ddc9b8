"""C11 goldens with the reference lexicon, P1 == regex property, keep-best properties."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions.lexicon import Lexicon, matched_terms
from quarry.operators.discover import keep_best, with_dedupe_key
from quarry.operators.scoring import gate, score_candidates

GOLDENS = [
    ("Bangladesh LNG import dataset", "", 86, ["bangladesh"], ["lng"], ["import"], [], True, True),
    ("Cost benefit analysis of cassava production in Sherpur district of Bangladesh", "fertilizer use",
     60, ["bangladesh"], ["fertilizer"], ["cost"], [], False, False),
    ("Cost benefit analysis of cassava production in Sherpur district of Bangladesh", "",
     50, ["bangladesh"], [], ["cost"], [], False, False),
    ("Olive oil demand in South Asia", "", 5, ["south asia"], [], ["demand"], ["olive oil"], False, False),
    ("Spent fuel storage in Bangladesh", "", 31, ["bangladesh"], ["fuel storage"], ["storage"], ["spent fuel"],
     False, True),
    ("A long strategy to adapt", "", 0, [], [], [], [], False, False),
    ("Fuel  oil price", "", 46, [], ["fuel oil"], ["price"], [], False, True),
    ("fuel-oil price", "", 20, [], [], ["price"], [], False, False),
    ("Transcriptomic response to diesel price in Dhaka", "", 31, ["dhaka"], ["diesel"], ["price"],
     ["transcriptom"], False, True),
    ("Diesel price in Dhaka", "rheological nuclear tests", 61, ["dhaka"], ["diesel"], ["price"],
     ["nuclear", "rheolog"], False, True),
    ("Jet A-1 demand", "Mongla", 58, ["mongla"], ["jet a-1"], ["demand"], [], False, True),
]


def test_reference_goldens(spark):
    df = spark.createDataFrame([(i, g[0], g[1]) for i, g in enumerate(GOLDENS)], "i int, title string, abstract string")
    got = {r["i"]: r for r in score_candidates(df, Lexicon.reference()).collect()}
    for i, g in enumerate(GOLDENS):
        r = got[i]
        assert (r.score, r.geography, r.commodity, r.measure, r.penalties, r.has_dataset_hint,
                r.commodity_in_title) == tuple(g[2:]), g[0]


def test_gates_drop_cassava(spark):
    df = spark.createDataFrame([(g[0], g[1]) for g in GOLDENS[:3]], "title string, abstract string")
    assert gate(score_candidates(df, Lexicon.reference())).count() == 1


def _regex_hits(text, terms):
    out = []
    for t in terms:
        body = r"\s+".join(re.escape(w) for w in t.split(" "))
        if re.search(r"(^|[^a-z0-9])" + body + r"([^a-z0-9]|$)", text, re.I | re.ASCII):
            out.append(t)
    return out


def test_tokenised_matcher_equals_regex(spark):
    rnd = random.Random(7)
    lx = Lexicon.reference()
    terms = [t for t in lx.commodity + lx.measure if "-" not in t]
    vocab = sorted({w for t in terms for w in t.split(" ")}) + ["x", "Oil", "É", "data"]
    seps = [" ", "  ", "\n", ", ", "-", "é", "."]
    texts = ["".join(rnd.choice(vocab).upper() if rnd.random() < .2 else rnd.choice(vocab)) + "".join(
        rnd.choice(seps) + rnd.choice(vocab) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.h for r in df.select("i", matched_terms(F.col("t"), terms).alias("h")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _regex_hits(t, terms), t


def test_keep_best_ties_first_seen(spark):
    rows = [(0, 0, 0, 3, "k", 50, "late"), (0, 0, 0, 1, "k", 50, "first"), (0, 0, 1, 0, "k", 49, "low")]
    df = spark.createDataFrame(rows, "keyword_ord int, variant_ord int, source_ord int, item_ord long, "
                                     "dedupe_key string, score int, tag string")
    assert [r.tag for r in keep_best(df).collect()] == ["first"]
    # same result whatever the partitioning
    assert [r.tag for r in keep_best(df.repartition(3)).collect()] == ["first"]


def test_flagship_counts(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() == 18
    assert E.queries()["f02_gated"](spark, "/root/testdata/sf0.001").count() == 35
