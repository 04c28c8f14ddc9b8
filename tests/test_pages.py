"""Page parser goldens (FIXTURES HTML and JATS samples), bundles, copy choice, streaming."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from quarry.operators.copies import choose_copy
from quarry.operators.figures import pick_images, unpack_bundles
from quarry.operators.pages import (dataset_links, extract_figures, extract_tables, landing_files,
                                    parse_pages)

HTML = """<html><body>
<div class="table-wrap"><p class="caption">Table 1. Imports</p>
<table><tr><th>Year</th><th>LNG</th></tr><tr><td>2023</td><td>5.1</td></tr></table></div>
<table><tr><td>layout</td></tr></table>
<p>Depots by port</p><table><tr><th colspan="2">Port</th></tr><tr><td>Mongla</td><td> 12 </td></tr><tr></tr></table>
<figure><img data-src="/img/f1.png"><figcaption>Fig. 1 Tanks</figcaption></figure><figure></figure>
<a href="https://zenodo.org/records/123">Data</a><a href="https://doi.org/10.5281/zenodo.123">again</a>
<a href="https://github.com/ncbi/x">code</a><a href="https://github.com/u/r">GitHub</a><a href="/files/a.CSV?x=1">file</a>
</body></html>"""

JATS = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD" "x.dtd">
<article xmlns:xlink="http://www.w3.org/1999/xlink"><body>
<table-wrap><label>Table 1</label><caption><p>LNG <italic>imports</italic></p></caption>
<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></table-wrap>
<table-wrap><label>Table 2</label><graphic xlink:href="t2"/></table-wrap>
<fig><label>Fig. 1</label><caption><p>Tanks</p></caption><graphic xlink:href="gr1"/></fig>
<ext-link xlink:href="https://data.mendeley.com/datasets/63pxv64h75/4">deposit</ext-link></body></article>"""


def _parsed(spark, body, xml=False):
    df = spark.createDataFrame([(1, "https://ex.org/p/1", body, "PMC1")], "id int, url string, html string, pmcid string")
    return parse_pages(df, xml=xml, keep=["id", "url", "pmcid"])


def test_html_page(spark):
    p = _parsed(spark, HTML)
    t = extract_tables(p, ["id"]).orderBy("table_number").collect()
    assert [(r.table_number, r.dom_index, r.rows, r.columns, r.caption) for r in t] == \
        [(1, 0, 2, 2, "Table 1. Imports"), (2, 2, 2, 2, "Depots by port")]
    assert t[1].grid == [["Port"], ["Mongla", "12"]]
    f = extract_figures(p, ["id"]).collect()
    assert [(r.figure_number, r.caption, r.image_url) for r in f] == [(1, "Fig. 1 Tanks", "https://ex.org/img/f1.png")]
    links = dataset_links(p, ["id"]).orderBy("link_ord").collect()
    assert [(r.url, r.text) for r in links] == [("https://zenodo.org/records/123", "Data"),
                                                ("https://doi.org/10.5281/zenodo.123", "again")]
    files = landing_files(p, ["id"]).orderBy("file_ord").collect()
    assert [r.url for r in files] == ["https://zenodo.org/records/123", "https://ex.org/files/a.CSV?x=1"]


def test_jats_page(spark):
    p = _parsed(spark, JATS, xml=True)
    t = extract_tables(p, ["id"]).collect()
    assert [(r.caption, r.rows, r.columns) for r in t] == [("Table 1 LNG imports", 2, 2)]
    f = extract_figures(p, ["id"], pmcid="pmcid").collect()
    assert [(r.caption, r.image_url) for r in f] == \
        [("Fig. 1 Tanks", "https://pmc.ncbi.nlm.nih.gov/articles/PMC1/bin/gr1.jpg")]
    links = dataset_links(p, ["id"]).collect()
    assert [(r.url, r.text) for r in links] == [("https://data.mendeley.com/datasets/63pxv64h75/4", "deposit")]


def test_bundles_and_best_rendition(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n in ["x/gr1.gif", "x/GR1.JPG", "x/gr10.png"]:
            z.writestr(n, n.encode())
    (tmp_path / "PMC1.zip").write_bytes(buf.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    raw = spark.read.format("binaryFile").load(str(tmp_path / "*.zip"))
    entries = unpack_bundles(raw).withColumn("pmcid", F.regexp_extract("bundle", r"([^/]*)\.zip$", 1))
    assert entries.count() == 3
    figs = spark.createDataFrame([("PMC1", 1, "gr1")], "pmcid string, figure_number int, graphic string")
    best = pick_images(figs, entries, ["pmcid", "figure_number"]).collect()
    assert [r.image_name for r in best] == ["GR1.JPG"]


def test_choose_copy(spark):
    rows = [("a", 0, "static", "u0", 0, None), ("a", 1, "static", "u1", 0, None),      # no tables: last wins
            ("b", 0, "static", "u0", 0, None), ("b", 1, "static", "u1", 1, None),      # only 1 has a table
            ("c", 0, "static", "u0", 1, None), ("c", 1, "static", "u1", 1, None),      # first with a table
            ("d", 0, "static", "u0", 0, None), ("d", 1, "browser", "u1", 0, "boom")]   # 1 failed: last loaded
    df = spark.createDataFrame(rows, "article_id string, cand_ord int, mode string, final_url string, "
                                     "n_tables int, error string")
    got = {r.article_id: (r.cand_ord, [e.message for e in r.errors]) for r in choose_copy(df).collect()}
    assert got == {"a": (1, []), "b": (1, []), "c": (0, []), "d": (0, ["boom"])}


def test_streaming_score(spark, tmp_path):
    from quarry.functions.lexicon import Lexicon
    from quarry.streaming.score_stream import scored_stream, write_scored
    src = tmp_path / "in"
    df = spark.createDataFrame([("Bangladesh LNG import dataset", "", "https://x/1", "")],
                               "title string, abstract string, url string, doi string")
    df.write.parquet(str(src))
    q = write_scored(scored_stream(spark, str(src), df.schema, Lexicon.reference()),
                     str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.score, r.dedupe_key) for r in out] == [(86, "title:bangladesh lng import dataset")]
    assert os.path.isdir(tmp_path / "ckpt")
