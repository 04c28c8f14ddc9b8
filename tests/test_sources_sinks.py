"""Readers and sinks: article index in both layouts, several keyword files, responses and dead letters, dumps, one commit."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.functions import constants as K
from quarry.functions.lexicon import Lexicon
from quarry.operators.search import expand_variants
from quarry.sources import responses as R
from quarry.sources import sinks
from quarry.sources.keywords import read_keywords
from quarry.sources.normalise import normalise_datacite, normalise_responses
from quarry.sources.works import read_works, write_works


def articles():
    return [{c: (60 + k if c == "score" else f'{c} "{k}"\nnext, é') for c in K.ARTICLE_JSON_COLUMNS} for k in range(3)]


def test_articles_as_one_pretty_array(spark, tmp_path):
    """The layout the command-line tool writes: an indented array over many lines."""
    rows = articles()
    (tmp_path / "articles.json").write_text("\n " + json.dumps(rows, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    got = sinks.read_articles(spark, str(tmp_path / "articles.json")).withColumnRenamed("search_url", "searchUrl").collect()
    assert sorted((r.asDict() for r in got), key=lambda r: r["score"]) == rows


def test_articles_as_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame(articles(), ", ".join(f"{c} {'int' if c == 'score' else 'string'}" for c in K.ARTICLE_JSON_COLUMNS))
    sinks.write_articles_json(df.withColumnRenamed("searchUrl", "search_url"), str(tmp_path / "out"))
    got = sinks.read_articles(spark, str(tmp_path / "out")).withColumnRenamed("search_url", "searchUrl").collect()
    assert sorted((r.asDict() for r in got), key=lambda r: r["score"]) == articles()


def test_broken_and_missing_indexes(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"score": 61, "title": "a"}\n{"score": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        sinks.read_articles(spark, str(tmp_path / "bad.json")).collect()
    kept = sinks.read_articles(spark, str(tmp_path / "bad.json"), corrupt="keep").collect()
    assert sorted((r.score or 0, r.corrupt_record is None) for r in kept) == [(0, False), (61, True)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_articles(spark, str(tmp_path / "none.json"))
    (tmp_path / "empty.json").write_text("[]")
    assert sinks.read_articles(spark, str(tmp_path / "empty.json")).collect() == []


def test_keywords_of_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# x\none\n\ntwo\r\n")
    (tmp_path / "b.txt").write_text("three\n  four ")
    (tmp_path / "c.txt").write_text("# nothing\n")
    rows = read_keywords(spark, str(tmp_path)).orderBy("keyword_ord").collect()
    assert [(r.keyword_ord, r.keyword) for r in rows] == [(0, "one"), (1, "two"), (2, "three"), (3, "four")]
    assert [r.keyword for r in read_keywords(spark, str(tmp_path), 3).orderBy("keyword_ord").collect()] == ["one", "two", "three"]


def response(source, body, k=0):
    return (k, "q", 0, "q", source, "https://s.ex.org/?q=q", body)


def test_dead_letters(spark, tmp_path):
    bodies = [("OpenAlex", '{"results":[{"title":"t","doi":"d"}]}', None), ("OpenAlex", '{"results":[]}', None), ("OpenAlex", "{}", None), ("OpenAlex", '{"results":null}', None),
              ("OpenAlex", '{"results":{"a":1}}', "items are no array"), ("Zenodo", '{"hits":{"hits":3}}', "items are no array"), ("Zenodo", "[1]", "items are no array"),
              ("Zenodo", '{"hits":', "not JSON"), ("Crossref", "<html>rate limited</html>", "not JSON"), ("DataCite", None, "missing body"), ("DataCite", " \n", "missing body"),
              ("Scientific Data", "<html>", None), ("IEEE DataPort", "", "missing body"), ("Elsewhere", "{}", "unknown source"), (None, "{}", "unknown source")]
    df = spark.createDataFrame([response(s, b, k) for k, (s, b, _) in enumerate(bodies)], R.RESPONSE_SCHEMA)
    dead = {r.keyword_ord: r.problem for r in R.dead_letters(df).collect()}
    assert dead == {k: p for k, (_, _, p) in enumerate(bodies) if p}
    good = R.good_responses(df)
    assert {r.keyword_ord for r in good.collect()} == set(range(len(bodies))) - set(dead)
    assert [r.title for r in normalise_responses(good, ["OpenAlex"]).collect()] == ["t"]
    # landed by source: a selection reads its folders only
    at = str(tmp_path / "landed")
    R.land_responses(df.filter("source IS NOT NULL"), at)
    some = R.read_search_responses(spark, at, "openalex, zenodo")
    assert {r.source for r in some.collect()} == {"OpenAlex", "Zenodo"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "lower(source" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_wrong_schema_is_refused(spark):
    with pytest.raises(ValueError, match="body: missing"):
        R.checked_schema(spark.createDataFrame([(1, "a")], "keyword_ord int, source string"))
    with pytest.raises(ValueError, match="keyword_ord: bigint, not int"):
        R.checked_schema(spark.createDataFrame([response("OpenAlex", "{}")], "keyword_ord long, keyword string, variant_ord int, variant string, source string, search_url string, body string"))


def test_publisher_of_any_kind(spark):
    publishers = [({"name": "Org"}, "Org"), ("Plain", "Plain"), (None, ""), ({"name": None, "id": 1}, '{"id":1,"name":null}'), ('{"name": "text"}', '{"name": "text"}'), ({"name": ""}, ""), ("", "")]
    body = json.dumps({"data": [{"attributes": {"titles": [{"title": f"t{k}"}], "publisher": p, "doi": "d"}} for k, (p, _) in enumerate(publishers)]
                                + [{"attributes": {"titles": [{"title": "t7"}], "publisher": ["a", "b"]}}, {"attributes": {"titles": [{"title": "t8"}]}}]})
    got = {r.title: r.journal for r in normalise_datacite(spark.createDataFrame([response("DataCite", body)], R.RESPONSE_SCHEMA)).collect()}
    want = {f"t{k}": w for k, (_, w) in enumerate(publishers)} | {"t7": '["a","b"]', "t8": ""}
    assert {k: v if k != "t3" else json.dumps(json.loads(v), sort_keys=True, separators=(",", ":")) for k, v in got.items()} == want


def test_dump_filters_reach_the_scan(spark, tmp_path):
    issn = K.DATA_JOURNAL_ISSNS
    works = [(1, [issn[0], issn[1], issn[0]], "journal-article", "Text"), (2, ["9"], "journal-article", None), (3, None, "book", "DATASET"), (4, [], None, "dataset"), (5, ["9", issn[2]], "book", "x"),
             (6, ["9", issn[2], None], "journal-article", "Dataset")]
    at = str(tmp_path / "works")
    write_works(spark.createDataFrame(works, "id int, issn array<string>, type string, resource_type string"), at)
    ids = lambda source: sorted(r.id for r in read_works(spark, at, source).collect())
    assert [ids(s) for s in ("Crossref Data Journals", "Crossref", "DataCite", "OpenAlex")] == [[1, 6], [1, 2, 6], [3, 4, 6], [1, 2, 3, 4, 5, 6]]
    plan = read_works(spark, at, "Crossref Data Journals")._jdf.queryExecution().executedPlan().toString()
    assert "work_type" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "In(issn_key" in plan.split("PushedFilters: ")[1]
    assert "resource_kind" in read_works(spark, at, "DataCite")._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_one_commit(spark, tmp_path):
    at = str(tmp_path / "set")
    with pytest.raises(ValueError):
        sinks.published(spark, at, "tables")
    frame = lambda rows: spark.createDataFrame(rows, "article_id string, v int")
    seen = lambda name: sorted(tuple(r) for r in sinks.published(spark, at, name).collect())
    assert sinks.publish(spark, at, {"tables": frame([("a", 1), ("b", 2)]), "figures": frame([("a", 3)])}) == 1
    broken = frame([("c", 9)]).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(spark, at, {"tables": frame([("z", 0)]), "figures": broken})
    assert seen("tables") == [("a", 1), ("b", 2)] and seen("figures") == [("a", 3)]
    # article a again, now without figures; article c for the first time
    rerun = frame([("a", 0), ("c", 0)])
    assert sinks.publish(spark, at, {"tables": frame([("a", 5), ("c", 6)]), "figures": frame([("c", 7)])}, rerun) == 2
    assert seen("tables") == [("a", 5), ("b", 2), ("c", 6)] and seen("figures") == [("c", 7)]
    sinks.publish(spark, at, {"tables": frame([("a", 5)]), "figures": frame([])})
    assert seen("tables") == [("a", 5)] and seen("figures") == []


def test_probe_limits_are_arguments(spark):
    lexicon = Lexicon.of(["dhaka", "khulna"], ["oil", "gas", "coal"], ["price", "cost", "import", "demand"])
    df = spark.createDataFrame([("dhaka khulna oil gas coal price cost import demand",)], "keyword string")
    assert expand_variants(df, lexicon=lexicon).count() == 1 + 6
    assert expand_variants(df, lexicon=lexicon, max_geography=2, max_commodity=3, max_measure=4).count() == 1 + 24
