"""Catalog: records assembly and analyst queries.

Articles are the synthesised supplier pages (one article per page): their
tables and figures come from the page parser, and each article carries one
dataset link (downloaded for even nations, no public file for odd ones).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.deposits import unique_links
from ..operators.pages import extract_figures, extract_tables, parse_pages
from ..operators.records import (FLAT, articles_with_data, assemble_records, downloaded_links,
                                 extraction_summary, flatten_records, join_evidence, shared_deposits,
                                 substantial_tables, thin_tables)
from ..shared import stored
from . import synth
from .catalog import register
from .q_extract import UNIQUE_LINKS_SQL, _links
from .q_pages import SUPPLIER_ROWS_SQL

IDS = ["n_nationkey", "chunk"]
def _aid():
    return F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"), F.lit("-"), F.col("chunk").cast("string"))


def _records(spark, sf):
    _AID = _aid()
    pages = synth.supplier_pages(spark, sf)
    parsed = stored(parse_pages(pages, keep=IDS + ["url"]), "parsed")
    names = pages.select(*IDS, F.col("html").alias("_h"))
    title = F.concat(F.lit("Suppliers of "), F.regexp_extract("_h", "(?:<caption>|<p>)([^<]*?)(?: suppliers)?</", 1))
    articles = parsed.select(*IDS, "url").join(names, IDS).select(
        _AID.alias("article_id"), F.lit("").alias("doi"), title.alias("title"),
        F.lit("Scientific Data").alias("source"), F.lit(60).alias("score"), F.lit("dataset").alias("kind"),
        F.lit("").alias("commodity"), F.lit("").alias("measure"), F.col("url"),
        F.lit(True).alias("attempted"), F.lit(True).alias("loaded"), F.lit("static").alias("mode"),
        F.col("url").alias("final_url"))
    tables = extract_tables(parsed, IDS).select(
        _AID.alias("article_id"), "table_number", "caption", "rows", "columns",
        F.concat(F.lit("data/tables/"), _AID, F.lit("-t"), F.col("table_number").cast("string"), F.lit(".csv"))
        .alias("file"))
    figures = extract_figures(parsed, IDS).select(_AID.alias("article_id"), "figure_number", "caption",
                                                  "image_url", F.lit("").alias("file"))
    even = F.col("n_nationkey") % 2 == 0
    zen = F.concat(F.lit("https://zenodo.org/records/"), F.col("n_nationkey").cast("string"))
    links = parsed.select(
        _AID.alias("article_id"), F.lit(1).alias("link_number"), zen.alias("url"), zen.alias("resolved_url"),
        F.lit("nation data").alias("text"),
        F.when(even, F.lit("downloaded")).otherwise(F.lit("no_public_file_found")).alias("download_status"),
        F.when(even, F.lit(1)).otherwise(F.lit(0)).alias("n_files"), F.lit(0).alias("n_errors"),
        F.when(even, F.concat(F.lit("data/dataset-files/"), _AID, F.lit("-f1-x.csv"))).otherwise(F.lit(""))
        .alias("downloaded_files"), F.lit("").alias("download_error"))
    return assemble_records(articles, tables, figures, links)


PAGES_SQL = f"""
SELECT n_nationkey, chunk, 'nation-' || n_nationkey || '-' || chunk AS aid, min(n_name) AS n_name, count(*) AS n,
  'https://ex.org/nation/' || n_nationkey || '/' || chunk AS url
FROM ({SUPPLIER_ROWS_SQL}) GROUP BY n_nationkey, chunk"""

FLAT_SQL = f"""
WITH p AS ({PAGES_SQL}),
b AS (SELECT *, 'Suppliers of ' || n_name AS title, CASE WHEN n >= 2 THEN 1 ELSE 0 END AS nt FROM p)
SELECT 0 AS record_ord, aid AS recordId, '' AS parentRecordId, 'article' AS recordType, 'article' AS evidenceType,
  '' AS doi, title, 'Scientific Data' AS source, '60' AS score, 'dataset' AS kind, '' AS commodity, '' AS measure,
  '' AS file, url, '' AS resolvedUrl, url AS articleUrl, '' AS caption, '' AS rows, '' AS columns, '' AS text,
  'loaded' AS status FROM b
UNION ALL
SELECT 1, aid || '-table-1', aid, 'evidence', 'table', '', title, 'Scientific Data', '60', 'dataset', '', '',
  'data/tables/' || aid || '-t1.csv', '', '', url,
  CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || ' suppliers' END, CAST(n AS VARCHAR), '2', 'table 1',
  'extracted' FROM b WHERE nt = 1
UNION ALL
SELECT 1 + nt, aid || '-figure-1', aid, 'evidence', 'figure', '', title, 'Scientific Data', '60', 'dataset', '', '',
  '', 'https://ex.org/img/' || n_nationkey || '.png', '', url, 'Fig. ' || n_nationkey || ' ' || n_name, '', '',
  'figure 1', 'extracted' FROM b
UNION ALL
SELECT 2 + nt, aid || '-dataset-1', aid, 'evidence', 'dataset_link', '', title, 'Scientific Data', '60', 'dataset',
  '', '', CASE WHEN n_nationkey % 2 = 0 THEN 'data/dataset-files/' || aid || '-f1-x.csv' ELSE '' END,
  'https://zenodo.org/records/' || n_nationkey, 'https://zenodo.org/records/' || n_nationkey, url, '', '', '',
  'nation data', CASE WHEN n_nationkey % 2 = 0 THEN 'downloaded' ELSE 'no_public_file_found' END FROM b"""


def _flat(spark, sf):
    return flatten_records(_records(spark, sf))


@register("u03_flatten", f"SELECT * FROM ({FLAT_SQL})")
def u03_flatten(spark, sf):
    return _flat(spark, sf).select("record_ord", *FLAT)


@register("a03_summary", f"""
WITH p AS ({PAGES_SQL})
SELECT count(*) AS pages_loaded, 0 AS pages_failed, count(*) FILTER (WHERE n >= 2) AS tables,
  count(*) AS figure_captions, 0 AS figure_images, count(*) AS dataset_links,
  count(*) FILTER (WHERE n_nationkey % 2 = 0) AS downloaded_files, count(*) AS records FROM p""")
def a03_summary(spark, sf):
    s = extraction_summary(_records(spark, sf))
    return s.select(*[F.col(c).cast("long").alias(c) for c in s.columns])


def _ranked_sql(direction: str) -> str:
    return f"""SELECT recordId, rows, row_number() OVER (ORDER BY CAST(rows AS INT) {direction}, recordId) - 1 AS rank
FROM ({FLAT_SQL}) WHERE evidenceType = 'table'"""


@register("t08_thin_tables", _ranked_sql("ASC"))
def t08_thin_tables(spark, sf):
    return thin_tables(_flat(spark, sf)).select("recordId", "rows", "rank")


@register("t07_substantial_tables", _ranked_sql("DESC"))
def t07_substantial_tables(spark, sf):
    return substantial_tables(_flat(spark, sf)).select("recordId", "rows", "rank")


@register("t09_downloaded_links", f"""
SELECT recordId, url FROM ({FLAT_SQL}) WHERE evidenceType = 'dataset_link' AND status = 'downloaded'""")
def t09_downloaded_links(spark, sf):
    return downloaded_links(_flat(spark, sf)).select("recordId", "url")


@register("j12_evidence_join", f"""
WITH f AS ({FLAT_SQL})
SELECT e.recordId, e.parentRecordId, e.evidenceType, a.title AS article_title, a.status AS article_status
FROM f e JOIN f a ON e.parentRecordId = a.recordId WHERE e.recordType = 'evidence' AND a.recordType = 'article'""")
def j12_evidence_join(spark, sf):
    return join_evidence(_flat(spark, sf)).select("recordId", "parentRecordId", "evidenceType", "article_title",
                                                  "article_status")


@register("j13_articles_with_data", f"""
WITH f AS ({FLAT_SQL})
SELECT recordId FROM f WHERE recordType = 'article' AND recordId IN
  (SELECT parentRecordId FROM f WHERE evidenceType = 'dataset_link' AND file <> '')""")
def j13_articles_with_data(spark, sf):
    return articles_with_data(_flat(spark, sf)).select("recordId")


@register("u07_shared_deposits", f"""
WITH u AS ({UNIQUE_LINKS_SQL}),
p AS (SELECT DISTINCT identity, article_id FROM u),
m AS (SELECT identity, count(*) AS n_articles FROM p GROUP BY identity HAVING count(*) > 1)
SELECT p.identity, p.article_id, m.n_articles FROM p JOIN m USING (identity)""")
def u07_shared_deposits(spark, sf):
    return shared_deposits(unique_links(_links(spark, sf))).select("identity", "article_id", "n_articles")
