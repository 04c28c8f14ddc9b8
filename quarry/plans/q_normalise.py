"""Catalog: source normalisers N01-N05, U01 union and the discover plan over responses."""

from __future__ import annotations

from ..functions import constants as K
from ..sources.normalise import (CANDIDATE_COLUMNS, html_candidates, normalise_crossref, normalise_datacite,
                                 normalise_openalex, normalise_responses, normalise_zenodo)
from . import oracles as O
from . import synth
from .catalog import register
from .discover import discover
from .fixtures import CORPUS_LEXICON
from .q_scalars import strip_html_sql

q = O.q
OUT = ["source", "keyword_ord", "item_ord", "title", "abstract", "journal", "doi", "published", "url", "kind"]
_SRC_ORD = "CASE source " + " ".join(f"WHEN {q(n)} THEN {i}" for i, n in enumerate(K.ALL_SOURCES)) + " END"


def _item_ord(key: str) -> str:
    return f"row_number() OVER (PARTITION BY floor({key} / 50) ORDER BY {key}) - 1"


N01_SQL = f"""
SELECT 'OpenAlex' AS source, CAST(floor(doc_id / 50) AS INTEGER) AS keyword_ord, {_item_ord('doc_id')} AS item_ord,
  {strip_html_sql("split_part(coalesce(text, ''), chr(10), 1)")} AS title,
  {O.norm_ws_sql("CASE WHEN strpos(coalesce(text, ''), chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END")} AS abstract,
  coalesce(source, '') AS journal,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE '10.9999/doc.' || doc_id END AS doi,
  CASE WHEN doc_id % 3 = 0 THEN CAST(2000 + doc_id % 20 AS VARCHAR)
       ELSE '2021-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') END AS published,
  CASE WHEN doc_id % 7 = 0 THEN 'https://ex.org/' || doc_id ELSE 'https://doi.org/10.9999/doc.' || doc_id END AS url,
  coalesce(lang, '') AS kind,
  'https://api.openalex.org/works?search=q' || CAST(floor(doc_id / 50) AS INTEGER) AS search_url
FROM documents"""

N02_SQL = f"""
SELECT CASE WHEN CAST(floor(o_orderkey / 50) AS BIGINT) % 2 = 0 THEN 'Crossref' ELSE 'Crossref Data Journals' END AS source,
  CAST(floor(o_orderkey / 50) AS INTEGER) AS keyword_ord, {_item_ord('o_orderkey')} AS item_ord,
  {strip_html_sql("'<i>' || o_orderpriority || '</i> &amp; order ' || o_orderkey")} AS title,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {strip_html_sql("'<p>status ' || o_orderstatus || '</p>'")} END AS abstract,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS journal,
  '10.5555/o.' || o_orderkey AS doi,
  concat_ws('-', year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS published,
  CASE WHEN o_orderkey % 2 = 0 THEN 'https://ex.org/o/' || o_orderkey ELSE 'https://doi.org/10.5555/o.' || o_orderkey END AS url,
  'journal-article' AS kind,
  'https://api.crossref.org/works?q=' || CAST(floor(o_orderkey / 50) AS INTEGER) AS search_url
FROM orders"""

N04_SQL = f"""
SELECT 'DataCite' AS source, CAST(floor(p_partkey / 50) AS INTEGER) AS keyword_ord, {_item_ord('p_partkey')} AS item_ord,
  {strip_html_sql('p_name')} AS title,
  CASE WHEN p_partkey % 2 = 0 THEN {strip_html_sql("'<b>' || p_brand || '</b>'")} ELSE {strip_html_sql('p_type')} END AS abstract,
  p_brand AS journal, '10.5061/p.' || p_partkey AS doi, CAST(p_size AS VARCHAR) AS published,
  'https://doi.org/10.5061/p.' || p_partkey AS url, 'dataset' AS kind,
  'https://api.datacite.org/dois?q=' || CAST(floor(p_partkey / 50) AS INTEGER) AS search_url
FROM part"""

N05_SQL = f"""
SELECT 'Zenodo' AS source, CAST(floor(s_suppkey / 50) AS INTEGER) AS keyword_ord, {_item_ord('s_suppkey')} AS item_ord,
  {strip_html_sql('s_name')} AS title, 'nation ' || s_nationkey AS abstract,
  CASE WHEN s_suppkey % 3 = 0 THEN 'J' || s_nationkey WHEN s_suppkey % 3 = 1 THEN 'Pub' || s_nationkey ELSE 'Zenodo' END AS journal,
  CASE WHEN s_suppkey % 2 = 0 THEN '10.5281/zenodo.' || s_suppkey
       WHEN s_suppkey % 4 = 1 THEN '10.5281/zenodo.9' || s_suppkey ELSE '' END AS doi,
  '2020-01-01' AS published,
  CASE WHEN s_suppkey % 2 = 0 THEN 'https://doi.org/10.5281/zenodo.' || s_suppkey
       WHEN s_suppkey % 4 = 1 THEN 'https://doi.org/10.5281/zenodo.9' || s_suppkey
       ELSE 'https://zenodo.org/records/' || s_suppkey END AS url,
  'dataset' AS kind,
  'https://zenodo.org/api/records?q=' || CAST(floor(s_suppkey / 50) AS INTEGER) AS search_url
FROM supplier"""

# Scientific Data: each anchor is picked by its heading, by its path and by the preferred path;
# IEEE DataPort: by its path, by its box and by the preferred path.
N06_SQL = """
WITH c AS (SELECT *, CAST(floor(c_custkey / 50) AS INTEGER) AS r,
             row_number() OVER (PARTITION BY floor(c_custkey / 50) ORDER BY c_custkey) - 1 AS pos,
             count(*) OVER (PARTITION BY floor(c_custkey / 50)) AS n FROM customer)
SELECT CASE WHEN r % 2 = 0 THEN 'Scientific Data' ELSE 'IEEE DataPort' END AS source, r AS keyword_ord,
  grp * n + pos AS item_ord, CASE WHEN r % 2 = 0 THEN c_name || ' & data' ELSE c_name END AS title,
  '' AS abstract, '' AS journal, '' AS doi, '' AS published,
  'https://results.example.org/' || CASE WHEN r % 2 = 0 THEN 'articles/s' ELSE 'documents/d' END || c_custkey AS url,
  '' AS kind, 'https://results.example.org/search/list?q=' || r AS search_url
FROM c, (SELECT unnest([0, 1, 2]) AS grp)"""

_COLS = ", ".join(OUT)


@register("n06_html_candidates", f"SELECT {_COLS} FROM ({N06_SQL})")
def n06_html_candidates(spark, sf):
    return html_candidates(synth.html_responses(spark, sf)).select(*OUT)


@register("n01_openalex", f"SELECT {_COLS} FROM ({N01_SQL})")
def n01_openalex(spark, sf):
    return normalise_openalex(synth.openalex_responses(spark, sf)).select(*OUT)


@register("n02_crossref", f"SELECT {_COLS} FROM ({N02_SQL})")
def n02_crossref(spark, sf):
    r = synth.crossref_responses(spark, sf)
    return normalise_responses(r, ["Crossref", "Crossref Data Journals"]).select(*OUT)


@register("n04_datacite", f"SELECT {_COLS} FROM ({N04_SQL})")
def n04_datacite(spark, sf):
    return normalise_datacite(synth.datacite_responses(spark, sf)).select(*OUT)


@register("n05_zenodo", f"SELECT {_COLS} FROM ({N05_SQL})")
def n05_zenodo(spark, sf):
    return normalise_zenodo(synth.zenodo_responses(spark, sf)).select(*OUT)


UNION_SQL = f"""
SELECT keyword_ord, '' AS keyword, 0 AS variant_ord, '' AS variant, {_SRC_ORD} AS source_ord, source,
       item_ord, title, abstract, journal, doi, published, url, kind, search_url
FROM ({N01_SQL} UNION ALL {N02_SQL} UNION ALL {N04_SQL} UNION ALL {N05_SQL} UNION ALL SELECT * FROM ({N06_SQL}))"""


@register("u01_union_sources", f"SELECT {', '.join(CANDIDATE_COLUMNS)} FROM ({UNION_SQL})")
def u01_union_sources(spark, sf):
    return normalise_responses(synth.search_responses(spark, sf)).select(*CANDIDATE_COLUMNS)


@register("discover_responses", O.discover_sql(CORPUS_LEXICON, UNION_SQL))
def discover_responses(spark, sf):
    """Full discover: landed responses -> normalise -> score -> gate -> keep best."""
    cands = normalise_responses(synth.search_responses(spark, sf))
    return discover(cands, CORPUS_LEXICON, ranked=False)
