"""Keyword file reader (S01/S03), CSV sink quoting (Q15), deposit mappers and file resolution."""

import json

from pyspark.sql import functions as F

from quarry.operators.deposits import resolve_files, supplement_links, zenodo_files
from quarry.sources.keywords import read_keywords
from quarry.sources.sinks import write_csv


def test_read_keywords(spark, tmp_path):
    p = tmp_path / "keywords.txt"
    p.write_text("# comment\n\n  LNG  \nBangladesh diesel price\n# x\nfuel depot\n")
    rows = read_keywords(spark, str(p)).orderBy("keyword_ord").collect()
    assert [(r.keyword_ord, r.keyword) for r in rows] == [(0, "LNG"), (1, "Bangladesh diesel price"), (2, "fuel depot")]
    assert read_keywords(spark, str(p), limit=2).count() == 2


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([('x"y', "p,q", " a ", None)], "a string, b string, c string, d string")
    out = tmp_path / "out"
    write_csv(df, str(out), ["a", "b", "c", "d"], single_file=True)
    text = "".join(f.read_text() for f in out.glob("part-*"))
    assert text == 'a,b,c,d\n"x""y","p,q", a ,\n'


def test_supplements_and_deposit_files(spark):
    body = json.dumps({"message": {"relation": {
        "is-supplemented-by": [{"id": "10.17632/63pxv64h75.4"}, {"id": ""}],
        "references": [{"id": "10.1/x"}]}}})
    s = supplement_links(spark.createDataFrame([("10.1/a", body)], "doi string, body string")).collect()
    assert [(r.url, r.text) for r in s] == [("https://doi.org/10.17632/63pxv64h75.4", "crossref is-supplemented-by")]
    dep = json.dumps({"files": [{"key": "a.csv", "links": {"self": "https://zenodo.org/api/f/a.csv"}},
                                {"filename": "b.txt", "links": {"download": "https://zenodo.org/api/f/b"}},
                                {"key": "c", "links": {}}]})
    deposits = spark.createDataFrame([("zenodo", "123", "", dep)], "repo string, deposit_id string, version string, body string")
    files = zenodo_files(deposits, ["repo", "deposit_id", "version"])
    assert [(r.url, r.file_name) for r in files.orderBy("fo").collect()] == \
        [("https://zenodo.org/api/f/a.csv", "a.csv"), ("https://zenodo.org/api/f/b", "b.txt")]
    links = spark.createDataFrame(
        [("art", 1, "https://doi.org/10.5281/zenodo.123", "https://zenodo.org/records/123"),
         ("art", 2, "https://ex.org/data.csv", "https://ex.org/data.csv")],
        "article_id string, link_number int, url string, resolved_url string")
    got = resolve_files(links, files).orderBy("link_number", "file_index")
    assert [(r.link_number, r.file_index, r.url, r.source) for r in got.collect()] == [
        (1, 1, "https://zenodo.org/api/f/a.csv", "zenodo_api"), (1, 2, "https://zenodo.org/api/f/b", "zenodo_api"),
        (2, 1, "https://ex.org/data.csv", "direct_url")]
