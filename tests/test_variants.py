"""C28 goldens with the reference lexicon (the line itself always first)."""

from pyspark.sql import functions as F

from quarry.functions.variants import query_variants

GOLDENS = {
    "Energy Scenario of Bangladesh": [],
    "LNG": [],
    "Bangladesh petroleum annual report imports sales capacity":
        ["bangladesh petroleum capacity", "bangladesh petroleum imports", "bangladesh petroleum sales"],
    "Mongla fuel depot terminal capacity Bangladesh":
        ["mongla fuel depot capacity", "mongla fuel depot terminal", "mongla fuel depot"],
    "supply chain dataset fuel logistics": ["fuel logistics supply chain", "fuel logistics"],
}


def test_variant_goldens(spark):
    df = spark.createDataFrame([(k,) for k in GOLDENS], "keyword string")
    got = {r.keyword: r.v for r in df.select("keyword", query_variants(F.col("keyword")).alias("v")).collect()}
    for k, rest in GOLDENS.items():
        assert got[k] == [k] + rest, k


def test_diesel_line(spark):
    df = spark.createDataFrame([("Bangladesh high speed diesel import value price cost",)], "keyword string")
    v = df.select(query_variants(F.col("keyword")).alias("v")).first().v
    assert v[1] == "bangladesh high speed diesel import" and len(v) == 4
