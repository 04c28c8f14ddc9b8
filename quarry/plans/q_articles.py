"""Catalog: lookups, copies, supplements, deposits, indexes (J01-J04, U05, W04 with full text, X07-X09, J09, X11,
F16, F18, X12, S10-S13, T10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import copies as C
from ..operators import deposits as D
from ..operators.discover import cap_results
from ..operators.pages import extract_tables, parse_pages
from ..operators.records import assemble_records
from ..sources import sinks
from ..sources.normalise import normalise_responses, source_filter
from ..sources.tables import read_table
from . import oracles as O
from . import synth
from .catalog import register
from .q_normalise import UNION_SQL
from .q_pages import TABLES_SQL
from .q_records import FLAT_SQL, _records

q = O.q


# -- J01 / J02 / U05 / J04 / W04 / A06 ----------------------------------------------------
# An article per order: every fourth has no DOI.  Lookups are landed twice, the later answer being another one.

def _articles(spark, sf):
    k = F.col("o_orderkey")
    s = k.cast("string")
    return read_table(spark, sf, "orders").select(
        k.alias("article"), F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("10.5555/o."), s)).alias("doi"),
        F.when(k % 13 == 0, F.lit("https://www.sciencedirect.com/x")).otherwise(F.concat(F.lit("https://ex.org/o/"), s))
        .alias("url"))


def _doi_lookups(spark, sf):
    k = F.col("o_orderkey")
    s = k.cast("string")
    pmc = F.when(k % 3 == 0, F.concat(F.lit('{"resultList":{"result":[{"pmcid":"PMC'), s, F.lit('"},{"pmcid":"other"}]}}'))) \
        .otherwise(F.lit('{"resultList":{"result":[]}}'))
    oa = F.when(k % 5 == 0, F.concat(F.lit('{"best_oa_location":{"landing_page_url":"https://oa.ex.org/'), s, F.lit('"}}'))) \
        .when(k % 5 == 1, F.concat(F.lit('{"best_oa_location":null,"open_access":{"oa_url":"https://oa2.ex.org/'), s,
                                   F.lit('"}}'))).otherwise(F.lit("{}"))
    late = F.lit('{"resultList":{"result":[{"pmcid":"LATE"}]},"open_access":{"oa_url":"https://late.ex.org"}}')
    doi = F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("10.5555/o."), s))
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(o).alias("landed_ord"), body.alias("body"))
            for kind, first in (("europepmc_search", pmc), ("openalex_work", oa)) for o, body in ((1, first), (2, late))]
    return read_table(spark, sf, "orders").select(doi.alias("doi"), F.inline(F.array(*rows)))


_ARTICLES_SQL = """
SELECT o_orderkey AS article, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '10.5555/o.' || o_orderkey END AS doi,
  CASE WHEN o_orderkey % 13 = 0 THEN 'https://www.sciencedirect.com/x' ELSE 'https://ex.org/o/' || o_orderkey END AS url,
  CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0 THEN 'PMC' || o_orderkey ELSE '' END AS pmcid,
  CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN 'https://oa.ex.org/' || o_orderkey
       WHEN o_orderkey % 5 = 1 THEN 'https://oa2.ex.org/' || o_orderkey ELSE '' END AS oa_url
FROM orders"""


@register("j01_lookups", _ARTICLES_SQL)
def j01_lookups(spark, sf):
    return C.attach_lookups(_articles(spark, sf), _doi_lookups(spark, sf))


def _page_copies(spark, sf):
    """The record URL of most orders is landed static and rendered, the open-access page rendered, PMC's static."""
    k = F.col("o_orderkey")
    s = k.cast("string")
    record, oa, pmc = (F.concat(F.lit(x), s, F.lit(y)) for x, y in (
        ("https://ex.org/o/", ""), ("https://oa.ex.org/", ""), (K.PMC_ARTICLE_BASE + "PMC", "/")))

    def copy(when, url, mode, n_tables, final_url=None, error=None):
        return F.when(when, F.struct(url.alias("url"), F.lit(mode).alias("mode"),
                                     (url if final_url is None else final_url).alias("final_url"),
                                     n_tables.cast("int").alias("n_tables"),
                                     (F.lit(None) if error is None else error).cast("string").alias("error")))
    made = F.array(
        copy(k % 11 != 0, record, "static", k % 2),
        copy(k % 11 != 0, record, "browser", k % 5, F.when(k % 7 == 0, F.lit("https://ieeexplore.ieee.org/d")).otherwise(record)),
        copy(k % 10 == 0, oa, "browser", k % 3, None, F.when(k % 20 == 0, F.lit("timeout"))),
        copy(k % 9 == 0, pmc, "browser", F.lit(0)))
    return read_table(spark, sf, "orders").select(F.inline(F.filter(made, lambda x: x.isNotNull())))


def _jats(spark, sf):
    """Full text of the articles in PMC: with a table, with a figure, or a stub that only counts them."""
    k = F.col("o_orderkey")
    body = F.when(k % 18 == 0, F.lit("<article><table-wrap><table/></table-wrap></article>")) \
        .when(k % 18 == 9, F.lit('<article><fig id="f1"/></article>')) \
        .otherwise(F.lit('<article><counts><fig-count count="0"/></counts></article>'))
    own = read_table(spark, sf, "orders").filter(k % 6 == 3)
    return own.select(k.alias("article"), F.concat(F.lit("PMC"), k.cast("string")).alias("pmcid"), body.alias("body"))


_COPIES_SQL = f"""
WITH a AS ({_ARTICLES_SQL}),
u AS (SELECT article, unnest(u) AS url, generate_subscripts(u, 1) - 1 AS cand_ord FROM (
        SELECT article, list_filter([CASE WHEN pmcid <> '' THEN {q(K.PMC_ARTICLE_BASE)} || pmcid || '/' ELSE '' END, oa_url, url],
               lambda x: x <> '' AND strpos(x, 'sciencedirect.com') = 0) AS u FROM a)),
p AS (SELECT 'https://ex.org/o/' || o_orderkey AS url, 'static' AS mode, o_orderkey % 2 AS n,
        'https://ex.org/o/' || o_orderkey AS final_url, NULL AS error FROM orders WHERE o_orderkey % 11 <> 0
      UNION ALL SELECT 'https://ex.org/o/' || o_orderkey, 'browser', o_orderkey % 5,
        CASE WHEN o_orderkey % 7 = 0 THEN 'https://ieeexplore.ieee.org/d' ELSE 'https://ex.org/o/' || o_orderkey END, NULL
        FROM orders WHERE o_orderkey % 11 <> 0
      UNION ALL SELECT 'https://oa.ex.org/' || o_orderkey, 'browser', o_orderkey % 3, 'https://oa.ex.org/' || o_orderkey,
        CASE WHEN o_orderkey % 20 = 0 THEN 'timeout' END FROM orders WHERE o_orderkey % 10 = 0
      UNION ALL SELECT {q(K.PMC_ARTICLE_BASE)} || 'PMC' || o_orderkey || '/', 'browser', 0,
        {q(K.PMC_ARTICLE_BASE)} || 'PMC' || o_orderkey || '/', NULL FROM orders WHERE o_orderkey % 9 = 0),
e AS (SELECT u.article, u.cand_ord, u.url, p.mode, p.n, p.final_url,
        CASE WHEN p.url IS NULL THEN 'no landed copy' WHEN p.error IS NOT NULL THEN p.error
             WHEN strpos(p.final_url, 'ieeexplore.ieee.org') > 0 THEN 'redirected to blocked host: ' || p.final_url END AS error
      FROM u LEFT JOIN p ON p.url = u.url AND (p.mode = 'browser' OR p.n > 0)
      QUALIFY row_number() OVER (PARTITION BY u.article, u.cand_ord ORDER BY coalesce(p.mode, '') DESC) = 1),
b AS (SELECT * FROM e WHERE error IS NULL QUALIFY row_number() OVER (PARTITION BY article
      ORDER BY n > 0 DESC, CASE WHEN n > 0 THEN cand_ord ELSE -cand_ord END) = 1),
j AS (SELECT o_orderkey AS article, {q(K.EUROPEPMC_ARTICLE_BASE)} || 'PMC' || o_orderkey AS final_url FROM orders
      WHERE o_orderkey % 6 = 3 AND o_orderkey % 18 = 9),
m AS (SELECT a.article, string_agg(e.url || ' ' || e.error, '; ' ORDER BY e.cand_ord) AS errs
      FROM a JOIN e USING (article) LEFT JOIN b USING (article)
      WHERE e.error IS NOT NULL AND (b.article IS NULL OR b.n = 0 OR e.cand_ord < b.cand_ord) GROUP BY 1),
c AS (SELECT article, count(*) AS n FROM u GROUP BY 1)
SELECT a.article, CASE WHEN j.article IS NULL THEN b.cand_ord END AS cand_ord,
  CASE WHEN j.article IS NOT NULL THEN 'europepmc_xml' ELSE coalesce(b.mode, '') END AS mode,
  coalesce(j.final_url, b.final_url, '') AS final_url, j.article IS NOT NULL OR b.article IS NOT NULL AS loaded,
  CASE WHEN j.article IS NOT NULL THEN '' WHEN b.article IS NOT NULL THEN coalesce(m.errs, '')
       ELSE concat_ws('; ', m.errs, ' no reachable copy (' || coalesce(c.n, 0) || ' candidate(s))') END AS errors
FROM a LEFT JOIN b USING (article) LEFT JOIN j USING (article) LEFT JOIN m USING (article) LEFT JOIN c USING (article)"""


@register("j04_copies", _COPIES_SQL)
def j04_copies(spark, sf):
    """Lookups -> candidate URLs -> landed copies -> the chosen copy, full text first."""
    found = C.candidate_urls(C.attach_lookups(_articles(spark, sf), _doi_lookups(spark, sf)))
    landed = C.attach_copies(found, _page_copies(spark, sf), "article")
    eff = C.effective_copies(landed, ["article", "cand_ord", "candidate_url"])
    jats = C.usable_jats(_jats(spark, sf)).select("article", C.europepmc_url(F.col("pmcid")).alias("final_url"))
    chosen = C.choose_copy(eff, "article", url_col="candidate_url", jats=jats)
    errors = F.array_join(F.transform("errors", lambda e: F.concat(e["url"], F.lit(" "), e["message"])), "; ")
    return chosen.select("article", "cand_ord", "mode", "final_url", "loaded", errors.alias("errors"))


# -- J03 / F15 --------------------------------------------------------------------------------

@register("j03_supplements", """
SELECT '10.5555/o.' || o_orderkey AS doi, row_number() OVER (PARTITION BY o_orderkey ORDER BY i) - 1 AS link_ord, url, text
FROM (SELECT DISTINCT ON (o_orderkey, url) o_orderkey, i, url, text FROM (
  SELECT o_orderkey, 0 AS i, 'https://doi.org/10.6084/m9.figshare.' || o_orderkey AS url, 'crossref is-supplemented-by' AS text FROM orders
  UNION ALL SELECT o_orderkey, 1, 'https://zenodo.org/records/' || o_orderkey % 100, 'crossref is-supplemented-by' FROM orders
  UNION ALL SELECT o_orderkey, 2, 'https://doi.org/10.6084/m9.figshare.' || (o_orderkey - o_orderkey % 2), 'crossref hasRelatedData' FROM orders)
  ORDER BY o_orderkey, url, i)""")
def j03_supplements(spark, sf):
    k = F.col("o_orderkey")
    s = k.cast("string")
    body = F.concat(
        F.lit('{"message":{"relation":{"is-cited-by":[{"id":"10.1/x"}],"is-supplemented-by":[{"id":"10.6084/m9.figshare.'), s,
        F.lit('"},{"id":"https://zenodo.org/records/'), (k % 100).cast("string"), F.lit('"},{"id":""}],"hasRelatedData":[{"id":"10.6084/m9.figshare.'),
        (k - k % 2).cast("string"), F.lit('"}]}}}'))
    works = read_table(spark, sf, "orders").select(F.concat(F.lit("10.5555/o."), s).alias("doi"), body.alias("body"))
    return D.supplement_links(works)


# -- X07-X09 / J09 / X11 / T04 / F16 -------------------------------------------------------------

def _deposits(spark, sf):
    k = F.col("p_partkey")
    s = k.cast("string")
    p = read_table(spark, sf, "part")
    z = p.select(s.alias("deposit_id"), F.concat(
        F.lit('{"files":[{"key":"z'), s, F.lit('.csv","size":10,"links":{"self":"https://zenodo.org/f/'), s,
        F.lit('/1"}},{"filename":"","links":{"download":"https://zenodo.org/f/'), s, F.lit('/two.csv"}},{"key":"none"}]}')).alias("body"))
    f = p.select(s.alias("deposit_id"), F.concat(
        F.lit('{"files":[{"name":"f.xlsx","size":7,"download_url":"https://figshare.com/f/'), s, F.lit('"}]}')).alias("body"))
    v = p.select(k, F.explode(F.array(F.lit("1"), F.lit("2"))).alias("version"))
    m = v.select(F.concat(F.lit("m"), s).alias("deposit_id"), "version", F.concat(
        F.lit('[{"filename":"a.csv","size":1,"content_details":{"download_url":"https://data.mendeley.com/f/'), s, F.lit("/"), F.col("version"),
        F.lit('"}}]')).alias("body"))
    return D.deposit_files(z, f, m)


def _metadata(spark, sf):
    """Of every second deposit, naming its fifth or second version."""
    k = F.col("p_partkey").cast("string")
    last = F.when(F.col("p_partkey") % 4 == 0, F.lit("5")).otherwise(F.lit("2"))
    return read_table(spark, sf, "part").filter(F.col("p_partkey") % 2 == 0).select(
        F.concat(F.lit("m"), k).alias("deposit_id"), F.concat(F.lit('{"doi":{"id":"10.17632/m'), k, F.lit("."), last, F.lit('"}}')).alias("body"))


@register("x07_deposit_files", """
SELECT 'zenodo' AS repo, p_partkey || '' AS deposit_id, '' AS version, 0 AS fo, 'https://zenodo.org/f/' || p_partkey || '/1' AS url,
  'z' || p_partkey || '.csv' AS file_name, 10 AS size, 'zenodo_api' AS source FROM part
UNION ALL SELECT 'zenodo', p_partkey || '', '', 1, 'https://zenodo.org/f/' || p_partkey || '/two.csv', 'two.csv', NULL, 'zenodo_api' FROM part
UNION ALL SELECT 'figshare', p_partkey || '', '', 0, 'https://figshare.com/f/' || p_partkey, 'f.xlsx', 7, 'figshare_api' FROM part
UNION ALL SELECT 'mendeley', 'm' || p_partkey, v, 0, 'https://data.mendeley.com/f/' || p_partkey || '/' || v, 'a.csv', 1,
  'mendeley_api' FROM part, (SELECT unnest(['1', '2']) AS v)""")
def x07_deposit_files(spark, sf):
    return _deposits(spark, sf).select("repo", "deposit_id", "version", "fo", "url", "file_name", "size", "source")


@register("x09_versions", """
SELECT l_orderkey AS article_id, l_linenumber AS link_number, 'm' || l_partkey AS deposit_id,
  CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber || '' WHEN l_partkey % 4 = 0 THEN '5' WHEN l_partkey % 2 = 0 THEN '2' ELSE '1' END AS version
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)""")
def x09_versions(spark, sf):
    named = F.concat(F.lit("https://data.mendeley.com/datasets/m"), F.col("l_partkey").cast("string"),
                     F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("/"), F.col("l_linenumber").cast("string"))).otherwise(F.lit("")))
    links = read_table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p"), F.col("l_orderkey").alias("article_id"), F.col("l_linenumber").alias("link_number"), named.alias("url")).distinct()
    keys = D.mendeley_keys(links, _metadata(spark, sf), ["p", "article_id", "link_number"])
    return keys.select("article_id", "link_number", "deposit_id", "version")


@register("x11_files", """
WITH l AS (SELECT DISTINCT l_orderkey AS article_id, l_linenumber AS link_number, l_partkey AS p FROM lineitem),
v AS (SELECT *, CASE WHEN link_number = 4 THEN '2' WHEN p % 4 = 0 THEN '5' WHEN p % 2 = 0 THEN '2' ELSE '1' END AS version FROM l WHERE link_number IN (4, 5)),
c AS (SELECT p, article_id, link_number, 0 AS o, 'https://ex.org/d/' || p || '.csv' AS url, p || '.csv' AS file_name, NULL AS size,
        'direct_url' AS source FROM l WHERE link_number = 6
      UNION ALL SELECT p, article_id, link_number, 0, 'https://zenodo.org/f/' || p || '/1', 'z' || p || '.csv', 10, 'zenodo_api' FROM l WHERE link_number IN (1, 7)
      UNION ALL SELECT p, article_id, link_number, 1, 'https://zenodo.org/f/' || p || '/two.csv', 'two.csv', NULL, 'zenodo_api' FROM l WHERE link_number IN (1, 7)
      UNION ALL SELECT p, article_id, link_number, 0, 'https://figshare.com/f/' || p, 'f.xlsx', 7, 'figshare_api' FROM l WHERE link_number = 2
      UNION ALL SELECT p, article_id, link_number, 0, 'https://data.mendeley.com/f/' || p || '/' || version, 'a.csv', 1, 'mendeley_api' FROM v WHERE version <> '5'
      UNION ALL SELECT p, article_id, link_number, i, 'https://ex.org/land/' || p || '/' || i, 'l' || i, NULL, 'html_link'
        FROM (SELECT p, article_id, link_number FROM l WHERE link_number = 3 UNION ALL SELECT p, article_id, link_number FROM v WHERE version = '5'),
             (SELECT unnest(range(5)) AS i))
SELECT p, article_id, link_number, CAST(o + 1 AS INT) AS file_index, url, file_name, size, source FROM c""")
def x11_files(spark, sf):
    """Files of links, all of them: direct, of the deposit and version that either spelling names, or from the landing page.

    Line 4 names a version and is spelled as a page, then as a DOI; line 5 names none, so that it is the
    metadata's (a fifth version isn't landed: its links fall back) or the first; lines 1 and 7 share a deposit.
    """
    p, n = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    page, doi = F.lit("https://data.mendeley.com/datasets/m"), F.lit("https://doi.org/10.17632/m")
    url = F.when(n == 6, F.concat(F.lit("https://ex.org/d/"), p, F.lit(".csv"))) \
        .when(n.isin(1, 7), F.concat(F.lit("https://zenodo.org/records/"), p)) \
        .when(n == 2, F.concat(F.lit("https://figshare.com/articles/dataset/t/"), p)) \
        .when(n == 4, F.concat(page, p, F.lit("/2"))).when(n == 5, F.concat(doi, p)) \
        .otherwise(F.concat(F.lit("https://ex.org/land/"), p))
    resolved = F.when(n == 4, F.concat(doi, p, F.lit(".2"))).when(n == 5, F.concat(page, p)).otherwise(url)
    links = read_table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber").distinct().select(
        F.col("l_partkey").alias("p"), F.col("l_orderkey").alias("article_id"), n.alias("link_number"), url.alias("url"), resolved.alias("resolved_url"))
    i = F.col("file_ord").cast("string")
    page_of = F.concat(F.lit("https://ex.org/land/"), F.col("p").cast("string"), F.lit("/"), i)
    landing = links.select("p", "article_id", "link_number", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("file_ord")).select(
        "p", "article_id", "link_number", "file_ord", page_of.alias("url"), F.concat(F.lit("l"), i).alias("file_name"),
        F.lit(None).cast("long").alias("size"), F.lit("html_link").alias("source"))
    return D.resolve_files(links, _deposits(spark, sf), landing, ["p", "article_id", "link_number"], metadata=_metadata(spark, sf))


@register("f16_landing", """
SELECT event_id FROM events WHERE event_id % 10 <> 0 AND event_type IN ('view', 'click') AND event_id % 7 <> 0""")
def f16_landing(spark, sf):
    k, t = F.col("event_id"), F.col("event_type")
    landed = read_table(spark, sf, "events").select(
        "event_id", F.when(k % 10 == 0, F.lit(404)).otherwise(F.lit(200)).alias("http_status"),
        F.when(t == "view", F.lit("text/HTML; charset=utf-8")).when(t == "click", F.lit("application/xhtml+xml"))
        .when(t == "error", F.lit("text/htmlx")).otherwise(F.lit("application/pdf")).alias("content_type"),
        F.when(k % 7 == 0, F.lit(5 * 1024 * 1024 + 1)).otherwise(5 * 1024 * 1024).alias("content_length"))
    return D.usable_landing(landed, max_bytes=K.LANDING_PAGE_MAX_BYTES).select("event_id")


@register("f18_source_filter", f"""
SELECT 'Crossref Data Journals' AS source, o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0
UNION ALL SELECT 'Crossref', o_orderkey FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'DataCite', o_orderkey FROM orders WHERE o_orderkey % 5 = 0""")
def f18_source_filter(spark, sf):
    k = F.col("o_orderkey")
    works = read_table(spark, sf, "orders").select(
        k, F.when(k % 3 == 0, F.array(F.lit("0000-0000"), F.lit(K.DATA_JOURNAL_ISSNS[1]))).otherwise(F.array(F.lit("1111-1111"))).alias("issn"),
        F.when(k % 2 == 0, F.lit("journal-article")).otherwise(F.lit("book")).alias("type"),
        F.when(k % 5 == 0, F.lit("Dataset")).otherwise(F.lit("Text")).alias("resource_type"))
    parts = [source_filter(works, n).select(F.lit(n).alias("source"), "o_orderkey") for n in ("Crossref Data Journals", "Crossref", "DataCite")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("t10_cap", f"""
SELECT source, keyword_ord, count(*) AS n FROM ({UNION_SQL}) WHERE item_ord < 20 GROUP BY 1, 2""")
def t10_cap(spark, sf):
    """The result cap is the operator's feature: twenty per response here."""
    kept = cap_results(normalise_responses(synth.search_responses(spark, sf)), 20)
    return kept.groupBy("source", "keyword_ord").agg(F.count(F.lit(1)).alias("n"))


# -- A05 with slug collisions, X12 ---------------------------------------------------------------

@register("a05_nested", """
WITH a AS (SELECT o_orderkey AS position, 'order-' || o_custkey % 10 AS article_id FROM orders),
t AS (SELECT l_orderkey AS position, count(*) AS n, min(l_linenumber) AS first, sum(l_partkey) AS parts FROM
        (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY 1)
SELECT position, article_id, coalesce(n, 0) AS n_tables, coalesce(parts, 0) AS parts FROM a LEFT JOIN t USING (position)""")
def a05_nested(spark, sf):
    """Ten slugs for all orders: an article keeps its own tables only."""
    k = F.col("o_orderkey")
    articles = C.article_records(read_table(spark, sf, "orders").select(
        k.alias("position"), F.concat(F.lit("Order "), (F.col("o_custkey") % 10).cast("string")).alias("doi"), F.lit("").alias("title"),
        F.lit(True).alias("attempted"), F.lit(True).alias("loaded"), F.lit("static").alias("mode"), F.lit("u").alias("final_url")))
    tables = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("position"), F.col("l_linenumber").alias("table_number"), F.col("l_partkey").alias("part")).distinct()
    none = tables.limit(0)
    nested = assemble_records(articles, tables, none.withColumnRenamed("table_number", "figure_number"),
                              none.withColumnRenamed("table_number", "link_number"), key="position")
    parts = F.aggregate("extraction.tables", F.lit(0).cast("long"), lambda a, t: a + t["part"])
    return nested.select("position", "article_id", F.size("extraction.tables").cast("long").alias("n_tables"), parts.alias("parts"))


# -- S10-S13 ---------------------------------------------------------------------------------------

_TABLE_SQL = f"""SELECT file, doi, title, source, CAST(score AS INT) AS score, 1 AS tableNumber, caption, CAST(rows AS INT) AS rows,
  CAST(columns AS INT) AS columns, articleUrl FROM ({FLAT_SQL}) WHERE evidenceType = 'table'"""


@register("s11_table_index", _TABLE_SQL)
def s11_table_index(spark, sf):
    return sinks.table_index(_records(spark, sf))


@register("s12_figure_index", f"""
SELECT doi, title, 1 AS figureNumber, caption, file, url AS imageUrl, articleUrl FROM ({FLAT_SQL}) WHERE evidenceType = 'figure'""")
def s12_figure_index(spark, sf):
    return sinks.figure_index(_records(spark, sf))


@register("s13_dataset_index", f"""
SELECT doi, title, text AS linkText, url AS datasetUrl, resolvedUrl, file AS downloadedFiles, status AS downloadStatus, articleUrl
FROM ({FLAT_SQL}) WHERE evidenceType = 'dataset_link'""")
def s13_dataset_index(spark, sf):
    return sinks.dataset_index(_records(spark, sf)).drop("downloadError")


@register("s10_grids", f"""
WITH t AS ({TABLES_SQL}), r AS (SELECT n_nationkey, CAST(floor(s_suppkey / 200) AS INTEGER) AS chunk, s_suppkey, s_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT 'n' || n_nationkey || '-' || chunk AS table_id, string_agg(s_name || ',' || s_suppkey, chr(10) ORDER BY s_suppkey) || chr(10) AS csv
FROM r SEMI JOIN t USING (n_nationkey, chunk) GROUP BY 1""")
def s10_grids(spark, sf):
    parsed = parse_pages(synth.supplier_pages(spark, sf), keep=["n_nationkey", "chunk", "url"])
    key = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("-"), F.col("chunk").cast("string"))
    tables = extract_tables(parsed, ["n_nationkey", "chunk"]).withColumn("table_id", key)
    return sinks.grid_rows(tables).select("table_id", "csv")
