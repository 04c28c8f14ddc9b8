"""Catalog: extract stage — targets, copy choice, links, file outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators.copies import choose_copy, effective_copies, select_targets
from ..operators.deposits import add_record_link, download_outcomes, link_status, unique_links
from ..sources.tables import read_table
from . import oracles as O
from .catalog import register
from .q_normalise import UNION_SQL
from .q_scalars import identity_sql, repo_url_sql, safe_file_name_sql
from .fixtures import CORPUS_LEXICON

q = O.q


# -- T02 / X12 -----------------------------------------------------------------------

@register("t02_targets", f"""
WITH d AS ({O.discover_sql(CORPUS_LEXICON, UNION_SQL)}),
t AS (SELECT *, (CASE WHEN source IN ({', '.join(q(s) for s in K.DATA_SOURCE_NAMES)}) THEN 2 ELSE 0 END)
   + (CASE WHEN lower(kind) = 'dataset' THEN 2 ELSE 0 END)
   + (CASE WHEN regexp_matches(title, '(?i)(^|[^A-Za-z0-9_])data(set)?([^A-Za-z0-9_]|$)') THEN 1 ELSE 0 END) AS yield_rank
  FROM d WHERE url <> '' AND score >= 60
   AND NOT ({' OR '.join(f"strpos(url, {q(h)}) > 0" for h in K.BLOCKED_HOSTS)})
  )
SELECT dedupe_key, score, yield_rank, source, title,
  row_number() OVER (ORDER BY yield_rank DESC, score DESC, title COLLATE en, dedupe_key) - 1 AS position FROM t""")
def t02_targets(spark, sf):
    from .q_normalise import discover_responses
    t = select_targets(discover_responses(spark, sf), order=["dedupe_key"])
    return t.select("dedupe_key", "score", "yield_rank", "source", "title", "position")


# -- W04 --------------------------------------------------------------------------------
# Per order: 3 candidate URLs, each landed as a static and a rendered copy.

def _copies(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    c = o.select("o_orderkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("cand_ord"))
    c = c.select("o_orderkey", "cand_ord", F.explode(F.array(F.lit("static"), F.lit("browser"))).alias("mode"))
    o_ = F.col("cand_ord")
    url = F.concat(F.lit("https://ex.org/a/"), k.cast("string"), F.lit("/"), o_.cast("string"))
    static = F.col("mode") == "static"
    return c.select(
        F.col("o_orderkey").cast("string").alias("article_id"), "cand_ord", "mode",
        F.when(~static & ((k + 2 * o_) % 5 == 0), F.lit("https://www.sciencedirect.com/x")).otherwise(url)
        .alias("final_url"),
        F.when(static, F.when((k + o_) % 3 == 0, 1).otherwise(0)).otherwise(F.when((k + o_) % 2 == 0, 2).otherwise(0))
        .alias("n_tables"),
        F.when(~static & ((k * 7 + o_) % 4 == 0), F.lit("timeout")).alias("error"))


W04_SQL = """
WITH c AS (SELECT o_orderkey, cand_ord FROM orders, (SELECT unnest([0, 1, 2]) AS cand_ord)),
e AS (SELECT o_orderkey, cand_ord,
  CASE WHEN (o_orderkey + cand_ord) % 3 = 0 THEN 'static' ELSE 'browser' END AS mode,
  CASE WHEN (o_orderkey + cand_ord) % 3 = 0 THEN 1 WHEN (o_orderkey + cand_ord) % 2 = 0 THEN 2 ELSE 0 END AS n_tables,
  CASE WHEN (o_orderkey + cand_ord) % 3 <> 0 AND (o_orderkey + 2 * cand_ord) % 5 = 0
       THEN 'https://www.sciencedirect.com/x' ELSE 'https://ex.org/a/' || o_orderkey || '/' || cand_ord END AS final_url,
  CASE WHEN (o_orderkey + cand_ord) % 3 <> 0 AND (o_orderkey * 7 + cand_ord) % 4 = 0 THEN 'timeout' END AS error
  FROM c),
l AS (SELECT *, error IS NULL AND strpos(final_url, 'sciencedirect.com') = 0 AND strpos(final_url, 'ieeexplore.ieee.org') = 0 AS ok FROM e),
b AS (SELECT * FROM l WHERE ok QUALIFY row_number() OVER (PARTITION BY o_orderkey
      ORDER BY n_tables > 0 DESC, CASE WHEN n_tables > 0 THEN cand_ord ELSE -cand_ord END) = 1)
SELECT CAST(o.o_orderkey AS VARCHAR) AS article_id, b.cand_ord, coalesce(b.mode, '') AS mode,
       coalesce(b.final_url, '') AS final_url, b.cand_ord IS NOT NULL AS loaded,
       -- candidates tried before the chosen one; all of them and a last entry where none loaded
       (SELECT count(*) FROM l WHERE l.o_orderkey = o.o_orderkey AND NOT l.ok
          AND (b.cand_ord IS NULL OR b.n_tables = 0 OR l.cand_ord < b.cand_ord)) + (b.cand_ord IS NULL)::INT AS n_errors
FROM orders o LEFT JOIN b ON b.o_orderkey = o.o_orderkey"""


@register("w04_choose_copy", W04_SQL)
def w04_choose_copy(spark, sf):
    eff = effective_copies(_copies(spark, sf), ["article_id", "cand_ord"])
    ch = choose_copy(eff)
    return ch.select("article_id", "cand_ord", "mode", "final_url", "loaded",
                     F.size("errors").cast("long").alias("n_errors"))


# -- U04 / W05 / J08 ---------------------------------------------------------------------
# Per order: one link per line item, alternating the two Mendeley spellings.

_LINK_URL_SQL = """CASE WHEN l_linenumber % 2 = 1
  THEN 'https://doi.org/10.17632/' || lower(hex(l_partkey % 50)) || '.' || l_linenumber
  ELSE 'https://data.mendeley.com/datasets/' || lower(hex(l_partkey % 50)) || '/' || l_linenumber END"""


def _links(spark, sf):
    li = read_table(spark, sf, "lineitem")
    h = F.lower(F.hex(F.col("l_partkey") % 50))
    n = F.col("l_linenumber").cast("string")
    url = F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("https://doi.org/10.17632/"), h, F.lit("."), n)) \
        .otherwise(F.concat(F.lit("https://data.mendeley.com/datasets/"), h, F.lit("/"), n))
    return li.select(F.col("l_orderkey").cast("string").alias("article_id"),
                     F.col("l_linenumber").alias("link_ord"), url.alias("url"),
                     F.concat(F.lit("link "), n).alias("text"))


def _records(spark, sf):
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://data.mendeley.com/datasets/"), F.lower(F.hex(k % 50))))
    url = url.when(k % 3 == 1, F.concat(F.lit("https://ex.org/paper/"), k.cast("string"))) \
        .otherwise(F.concat(F.lit("https://zenodo.org/records/"), k.cast("string")))
    kind = F.when(k % 2 == 0, F.lit("Dataset")).otherwise(F.lit("journal-article"))
    return o.select(k.cast("string").alias("article_id"), url.alias("url"), kind.alias("kind"))


_RECORDS_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS article_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'https://data.mendeley.com/datasets/' || lower(hex(o_orderkey % 50))
       WHEN o_orderkey % 3 = 1 THEN 'https://ex.org/paper/' || o_orderkey
       ELSE 'https://zenodo.org/records/' || o_orderkey END AS url,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Dataset' ELSE 'journal-article' END AS kind FROM orders"""

UNIQUE_LINKS_SQL = f"""
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS article_id, l_linenumber AS link_ord, {_LINK_URL_SQL} AS url,
                  'link ' || l_linenumber AS text FROM lineitem),
i AS (SELECT *, {identity_sql('url')} AS identity FROM l)
SELECT article_id, identity, link_ord, url, text FROM i
QUALIFY row_number() OVER (PARTITION BY article_id, identity ORDER BY link_ord) = 1"""


@register("u04_unique_links", UNIQUE_LINKS_SQL)
def u04_unique_links(spark, sf):
    return unique_links(_links(spark, sf)).select("article_id", "identity", "link_ord", "url", "text")


@register("j08_record_link", f"""
WITH u AS ({UNIQUE_LINKS_SQL}),
r AS (SELECT article_id, -1 AS link_ord, url, 'record URL' AS text, {identity_sql('url')} AS identity
      FROM ({_RECORDS_SQL}) WHERE {repo_url_sql('url')} OR strpos(lower(kind), 'dataset') > 0)
SELECT article_id, identity, link_ord, url, text FROM u
UNION ALL
SELECT article_id, identity, link_ord, url, text FROM r
WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.article_id = r.article_id AND u.identity = r.identity)""")
def j08_record_link(spark, sf):
    links = unique_links(_links(spark, sf)).select("article_id", "identity", "link_ord", "url", "text")
    return add_record_link(links, _records(spark, sf))


# -- C20 / J11 / A08 ----------------------------------------------------------------------
# Each event is one file candidate; three consecutive events form one dataset link.

def _file_cands(spark, sf):
    e = read_table(spark, sf, "events")
    k = F.col("event_id")
    link = F.floor(k / 3)
    url = F.concat(F.lit("https://files.ex.org/"), k.cast("string"),
                   F.when(k % 2 == 0, F.lit("/data.csv")).otherwise(F.lit("/get")))
    return e.select(link.alias("link_id"), (k % 3 + 1).cast("int").alias("file_index"), url.alias("url"),
                    F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("f"), k.cast("string"))).alias("file_name"),
                    F.concat(F.lit("rec-"), link.cast("string")).alias("record_id"))


def _file_responses(spark, sf):
    e = read_table(spark, sf, "events")
    k, t = F.col("event_id"), F.col("event_type")
    url = F.concat(F.lit("https://files.ex.org/"), k.cast("string"),
                   F.when(k % 2 == 0, F.lit("/data.csv")).otherwise(F.lit("/get")))
    ct = (F.when(t == "view", F.lit("text/html")).when(t == "purchase", F.lit("text/csv"))
          .when(t == "signup", F.lit("application/json")).when(t == "click", F.lit("application/zip"))
          .otherwise(F.lit("text/plain")))
    return e.select(url.alias("url"), url.alias("final_url"),
                    F.when(k % 11 == 0, F.lit(None)).when(t == "error", F.lit(500)).otherwise(F.lit(200))
                    .alias("http_status"),
                    ct.alias("content_type"),
                    F.when(t == "click", F.lit(30000000)).otherwise(1000 + k % 100).cast("long").alias("content_length"),
                    F.when(k % 4 == 0, F.concat(F.lit('attachment; filename="d'), k.cast("string"), F.lit('.xlsx"')))
                    .alias("content_disposition"),
                    (1000 + k % 100).cast("long").alias("byte_length"), F.lit(None).cast("string").alias("error"))


OUTCOME_SQL = f"""
WITH c AS (SELECT event_id, event_type, CAST(floor(event_id / 3) AS BIGINT) AS link_id, CAST(event_id % 3 + 1 AS INTEGER) AS file_index,
  'https://files.ex.org/' || event_id || CASE WHEN event_id % 2 = 0 THEN '/data.csv' ELSE '/get' END AS url,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE 'f' || event_id END AS file_name,
  'rec-' || CAST(floor(event_id / 3) AS BIGINT) AS record_id FROM events),
r AS (SELECT *, event_id % 11 = 0 AS missing,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status,
  CASE event_type WHEN 'view' THEN 'text/html' WHEN 'purchase' THEN 'text/csv' WHEN 'signup' THEN 'application/json'
    WHEN 'click' THEN 'application/zip' ELSE 'text/plain' END AS ct,
  CASE WHEN event_type = 'click' THEN 30000000 ELSE 1000 + event_id % 100 END AS clen,
  CASE WHEN event_id % 4 = 0 THEN 'd' || event_id || '.xlsx' ELSE '' END AS disp_name,
  1000 + event_id % 100 AS blen FROM c),
n AS (SELECT *, coalesce(nullif(disp_name, ''), nullif(file_name, ''),
    nullif(regexp_extract(url, '([^/]*)/*$', 1), ''), 'dataset-file-' || file_index) AS raw FROM r),
s AS (SELECT *, {safe_file_name_sql('raw', "'dataset-file-' || file_index")} AS sname FROM n),
w AS (SELECT *, CASE WHEN regexp_extract(sname, '^.+(\\.[^.]*)$', 1) <> '' THEN sname
    ELSE sname || coalesce(nullif(CASE WHEN strpos(lower(ct), 'text/csv') > 0 THEN '.csv'
      WHEN strpos(lower(ct), 'application/json') > 0 THEN '.json' WHEN strpos(lower(ct), 'application/zip') > 0 THEN '.zip'
      WHEN strpos(lower(ct), 'text/plain') > 0 THEN '.txt' ELSE '' END, ''), '.dat') END AS safe FROM s)
SELECT link_id, file_index, url, record_id,
  CASE WHEN missing THEN 'no HTTP status'
       WHEN http_status < 200 OR http_status > 299 THEN 'HTTP ' || http_status
       WHEN strpos(lower(ct), 'text/html') > 0 AND lower(regexp_extract(safe, '^.+(\\.[^.]*)$', 1)) NOT IN
            ({', '.join(q(e) for e in K.DATA_FILE_EXTENSIONS)}) THEN 'resolved to HTML, not a data file' END AS error,
  safe AS name
FROM w"""


@register("c20_download_outcome", f"""
SELECT link_id, file_index, url, error, CASE WHEN error IS NULL THEN
  'data/dataset-files/' || record_id || '-f' || file_index || '-' || name END AS file FROM ({OUTCOME_SQL})""")
def c20_download_outcome(spark, sf):
    o = download_outcomes(_file_cands(spark, sf), _file_responses(spark, sf))
    return o.select("link_id", "file_index", "url", "error", "file")


@register("a08_link_status", f"""
WITH o AS (SELECT link_id, file_index, error, CASE WHEN error IS NULL THEN
  'data/dataset-files/' || record_id || '-f' || file_index || '-' || name END AS file FROM ({OUTCOME_SQL}))
SELECT link_id, CAST(count(*) FILTER (WHERE error IS NULL) AS BIGINT) AS n_files,
  CAST(count(*) FILTER (WHERE error IS NOT NULL) AS INTEGER) AS n_errors,
  CASE WHEN count(*) FILTER (WHERE error IS NULL) > 0 THEN 'downloaded' ELSE 'failed' END AS download_status,
  coalesce(string_agg(file, '; ' ORDER BY file_index) FILTER (WHERE error IS NULL), '') AS downloaded_files,
  coalesce(string_agg(error, '; ' ORDER BY file_index) FILTER (WHERE error IS NOT NULL), '') AS download_error
FROM o GROUP BY link_id""")
def a08_link_status(spark, sf):
    cands = _file_cands(spark, sf)
    outcomes = download_outcomes(cands, _file_responses(spark, sf))
    links = cands.select("link_id").distinct()
    return link_status(links, outcomes, ["link_id"]).drop("files", "errors")
