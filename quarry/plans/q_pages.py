"""Catalog: page parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.pages import (absolute_links, dataset_links, extract_anchors, extract_figures, extract_tables,
                               landing_files, parse_pages, parse_search_results, table_cells)
from ..sources.tables import read_table
from . import oracles as O
from . import synth
from .catalog import register
from .q_scalars import safe_file_name_sql

q = O.q

# HTML character references that occur in the corpus pages, decoded once
# (&amp; last so '&amp;quot;' stays '&quot;').
_HTML_REFS = [("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"),
              ("&#39;", "'"), ("&amp;", "&")]


def html_unescape_sql(x: str) -> str:
    for a, b in _HTML_REFS:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def encode_path_sql(p: str) -> str:
    """WHATWG path percent-encoding: url_encode, then restore the characters paths keep."""
    x = f"url_encode({p})"
    for ch in "/!$&'()*+,:;=@[]^|":
        x = f"replace({x}, {q('%' + format(ord(ch), '02X'))}, {q(ch)})"
    return f"replace({x}, '%25', '%')"


ANCHORS_SQL = f"""
SELECT page_id, url AS page_url, i - 1 AS ord, hrefs[i] AS raw_href,
       {O.norm_ws_sql(html_unescape_sql('texts[i]'))} AS text,
       regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || {encode_path_sql('hrefs[i]')} AS url
FROM (SELECT page_id, url, hrefs, texts, generate_subscripts(hrefs, 1) AS i
      FROM (SELECT page_id, url,
                   regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                   regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages))"""


def _parsed_pages(spark, sf):
    return parse_pages(read_table(spark, sf, "pages", rebalance=True), keep=["page_id", "url"])


@register("x01_anchors", f"SELECT page_id, ord, raw_href, text, url FROM ({ANCHORS_SQL})")
def x01_anchors(spark, sf):
    return extract_anchors(_parsed_pages(spark, sf), ["page_id"]).select("page_id", "ord", "raw_href", "text", "url")


# how hrefs that stand for one URL are written, by the anchor's place in its page
_HREF_FORMS = """CASE ord % 6 WHEN 0 THEN h
  WHEN 1 THEN concat(upper(origin), CASE WHEN substr(origin, 1, 5) = 'https' THEN ':443' ELSE ':80' END, h)
  WHEN 2 THEN concat('/x/%2E%2e', h, '/.') WHEN 3 THEN translate(h, '/', {backslash})
  WHEN 4 THEN concat('?q=', substr(h, 2)) ELSE concat(substr(h, 2), '#', substr(h, 2)) END"""
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


@register("c30_absolute_urls", f"""
WITH a AS (SELECT page_id, url, {_ORIGIN} AS origin, regexp_extract(url, '^([^?#]*)', 1) AS place, hrefs[i] AS h, i - 1 AS ord
           FROM (SELECT *, generate_subscripts(hrefs, 1) AS i
                 FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages))),
b AS (SELECT *, {_HREF_FORMS.format(backslash="chr(92)")} AS raw_href, {encode_path_sql('substr(h, 2)')} AS e FROM a)
SELECT page_id, ord, raw_href,
  CASE ord % 6 WHEN 2 THEN origin || '/' || e || '/' WHEN 4 THEN CASE WHEN place = origin THEN place || '/' ELSE place END || '?q=' || e
    WHEN 5 THEN CASE WHEN place = origin THEN place || '/' ELSE regexp_extract(place, '^(.*/)', 1) END || e || '#' || e
    ELSE origin || '/' || e END AS url
FROM b""")
def c30_absolute_urls(spark, sf):
    pages = read_table(spark, sf, "pages", rebalance=True)
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))
    anchors = pages.select("page_id", F.col("url").alias("page_url"), F.expr(_ORIGIN).alias("origin"), F.posexplode(hrefs).alias("ord", "h"))
    anchors = anchors.select("page_id", "ord", "page_url", F.expr(_HREF_FORMS.format(backslash="char(92)")).alias("raw_href"))
    return absolute_links(anchors, base="page_url", foreign_hosts=False).select("page_id", "ord", "raw_href", "url")


# test host list / link words that occur in the corpus pages
TEST_HOSTS = ["/de", "/the"]
TEST_WORDS = ["the", "de"]


@register("x06_dataset_links", f"""
WITH a AS (SELECT * FROM ({ANCHORS_SQL})
           WHERE ({' OR '.join(f"strpos(raw_href, {q(h)}) > 0" for h in TEST_HOSTS)})
             AND NOT regexp_matches(raw_href, 'mendeley\\.com/import')
             AND NOT regexp_matches(raw_href, '(?i)github\\.com/ncbi')
             AND NOT regexp_matches(text, '(?i)^(ncbi on github|github|gitlab|twitter|facebook|linkedin|follow ncbi)$')),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY ord) = 1)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS link_ord, url, text FROM f""")
def x06_dataset_links(spark, sf):
    return dataset_links(_parsed_pages(spark, sf), ["page_id"], TEST_HOSTS)


@register("x10_landing_files", f"""
WITH a AS (SELECT * FROM ({ANCHORS_SQL})
           WHERE regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])(the|de)([^A-Za-z0-9_]|$)')),
f AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY ord) = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS file_ord FROM f)
SELECT page_id, file_ord, url,
  coalesce(nullif(regexp_extract(url_decode(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '([^/]*)/*$', 1), ''),
           {safe_file_name_sql('text', "'dataset-file'")}) AS file_name,
  'html_link' AS source
FROM n WHERE file_ord < 9""")
def x10_landing_files(spark, sf):
    return landing_files(_parsed_pages(spark, sf), ["page_id"], words=TEST_WORDS) \
        .select("page_id", "file_ord", "url", "file_name", "source")


@register("n06_search_results", f"""
WITH a AS (SELECT * FROM ({ANCHORS_SQL})),
s AS (SELECT page_id, ord, 0 AS grp, text, url FROM a WHERE strpos(raw_href, '/de') > 0
      UNION ALL SELECT page_id, ord, 1 AS grp, text, url FROM a WHERE strpos(raw_href, '/the') > 0)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY grp, ord) - 1 AS item_ord, text AS title, url FROM s""")
def n06_search_results(spark, sf):
    return parse_search_results(_parsed_pages(spark, sf), ["page_id"], ["a[href*='/de']"], ["/the"])


SUPPLIER_ROWS_SQL = """
SELECT n_nationkey, CAST(floor(s_suppkey / 200) AS INTEGER) AS chunk, n_name, s_suppkey, s_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

TABLES_SQL = f"""
SELECT n_nationkey, chunk, 1 AS table_number, 0 AS dom_index,
  CASE WHEN n_nationkey % 2 = 0 THEN min(n_name) ELSE min(n_name) || ' suppliers' END AS caption,
  count(*) AS rows, 2 AS columns
FROM ({SUPPLIER_ROWS_SQL}) GROUP BY n_nationkey, chunk HAVING count(*) >= 2"""


def _supplier_parsed(spark, sf):
    return parse_pages(synth.supplier_pages(spark, sf), keep=["n_nationkey", "chunk", "url"])


@register("x02_tables", TABLES_SQL)
def x02_tables(spark, sf):
    t = extract_tables(_supplier_parsed(spark, sf), ["n_nationkey", "chunk"])
    return t.select("n_nationkey", "chunk", "table_number", "dom_index", "caption",
                    F.col("rows").cast("long").alias("rows"), "columns")


@register("x13_cells", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY n_nationkey, chunk ORDER BY s_suppkey) - 1 AS row_no,
                  count(*) OVER (PARTITION BY n_nationkey, chunk) AS n FROM ({SUPPLIER_ROWS_SQL}))
SELECT n_nationkey, chunk, 1 AS table_number, row_no, 0 AS col_no, s_name AS cell FROM r WHERE n >= 2
UNION ALL
SELECT n_nationkey, chunk, 1, row_no, 1, CAST(s_suppkey AS VARCHAR) FROM r WHERE n >= 2""")
def x13_cells(spark, sf):
    ids = ["n_nationkey", "chunk"]
    return table_cells(extract_tables(_supplier_parsed(spark, sf), ids), ids)


@register("x05_figures", f"""
SELECT DISTINCT n_nationkey, chunk, 1 AS figure_number, 'Fig. ' || n_nationkey || ' ' || n_name AS caption,
  'https://ex.org/img/' || n_nationkey || '.png' AS image_url
FROM ({SUPPLIER_ROWS_SQL})""")
def x05_figures(spark, sf):
    ids = ["n_nationkey", "chunk"]
    return extract_figures(_supplier_parsed(spark, sf), ids).select(*ids, "figure_number", "caption", "image_url")
