"""Catalog: scalar functions and predicates (C01-C26, F05-F14, S17) over whole tables.

Inputs that the driver tables do not hold literally (DOIs, deposit URLs,
content types, date parts) are *derived* from table keys by one projection
that both the Spark query and its DuckDB twin spell out; the operator under
test is then applied by Spark and re-specified independently in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..operators.discover import filter_sources
from ..sources.tables import read_table
from . import oracles as O
from .catalog import register

q = O.q
ENTITY_RE = r"(?i)&(#x?[0-9a-f]+|[a-z]+);"


def decode_entities_sql(x: str) -> str:
    m = "p[2]"
    named = " ".join(f"WHEN lower({m}) = {q('&' + n + ';')} THEN {q(v)}" for n, v in
                     [("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"),
                      ("nbsp", " ")])
    hexv = f"('0x' || coalesce(nullif(regexp_extract(lower({m}), '^&#x0*([0-9a-f]{{1,6}});$', 1), ''), '0'))::INTEGER"
    decv = f"coalesce(nullif(regexp_extract({m}, '^&#0*([0-9]{{1,7}})', 1), ''), '0')::INTEGER"
    dec = (f"CASE {named} "
           f"WHEN regexp_matches(lower({m}), '^&#x0*[0-9a-f]{{0,6}};$') AND {hexv} <= 1114111 "
           f"AND NOT ({hexv} BETWEEN 55296 AND 57343) THEN chr({hexv}) "
           f"WHEN regexp_matches({m}, '^&#0*[0-9]{{0,7}}([^0-9]|$)') AND regexp_matches({m}, '^&#[0-9]') "
           f"AND {decv} <= 1114111 AND NOT ({decv} BETWEEN 55296 AND 57343) THEN chr({decv}) "
           f"ELSE {m} END")
    return (f"(CASE WHEN strpos(coalesce({x}, ''), '&') = 0 THEN coalesce({x}, '') ELSE "
            f"array_to_string(list_transform(list_zip(regexp_split_to_array(coalesce({x}, ''), {q(ENTITY_RE)}), "
            f"regexp_extract_all(coalesce({x}, ''), {q(ENTITY_RE)})), "
            f"lambda p: coalesce(p[1], '') || coalesce({dec}, '')), '') END)")


def strip_html_sql(x: str) -> str:
    return O.norm_ws_sql(f"regexp_replace({decode_entities_sql(decode_entities_sql(x))}, '<[^>]*>', ' ', 'g')")


# -- C01 / C05 ---------------------------------------------------------------

@register("c01_norm_ws", f"SELECT doc_id, {O.norm_ws_sql('text')} AS text FROM documents")
def c01_norm_ws(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", T.norm_ws("text").alias("text"))


@register("c05_strip_html", f"SELECT page_id, {strip_html_sql('html')} AS text FROM pages")
def c05_strip_html(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", T.strip_html("html").alias("text"))


# -- C07 ---------------------------------------------------------------------

@register("c07_crossref_date", """
SELECT o_orderkey,
  concat_ws('-', year(o_orderdate),
            CASE WHEN o_orderstatus = 'F' THEN NULL ELSE month(o_orderdate) END,
            CASE WHEN o_orderstatus = 'P' THEN NULL ELSE day(o_orderdate) END) AS published
FROM orders""")
def c07_crossref_date(spark, sf):
    o = read_table(spark, sf, "orders")
    parts = F.array(F.year("o_orderdate"),
                    F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.month("o_orderdate")),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.dayofmonth("o_orderdate")))
    return o.select("o_orderkey", T.crossref_date(parts).alias("published"))


# -- C08 / C09 / C26 -------------------------------------------------------------

def _doi_spelling_spark(k):
    k = F.col(k)
    return (F.when(k % 3 == 0, F.concat(F.lit("https://doi.org/10.5281/Zenodo."), k.cast("string")))
            .when(k % 3 == 1, F.concat(F.lit("10.6084/m9.figshare."), k.cast("string"), F.lit(".v"),
                                       (k % 4).cast("string")))
            .otherwise(F.concat(F.lit("10.1016/j.dib.2024."), k.cast("string"))))


_DOI_SPELLING_SQL = """CASE WHEN o_orderkey % 3 = 0 THEN 'https://doi.org/10.5281/Zenodo.' || o_orderkey
  WHEN o_orderkey % 3 = 1 THEN '10.6084/m9.figshare.' || o_orderkey || '.v' || (o_orderkey % 4)
  ELSE '10.1016/j.dib.2024.' || o_orderkey END"""


@register("c09_normalize_doi", f"""
SELECT o_orderkey, d AS doi,
  CASE WHEN d = '' THEN '' ELSE 'https://doi.org/' || regexp_replace(d, '^https?://doi\\.org/', '') END AS doi_url,
  regexp_replace(regexp_replace(lower(d), '^https?://doi\\.org/', ''), '\\.v?[0-9]+$', '') AS normalized,
  'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || o_orderkey || '/' AS pmc_url,
  'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || o_orderkey || '/bin/gr' || o_orderkey ||
     CASE WHEN o_orderkey % 2 = 0 THEN '.jpg' ELSE '.PNG' END AS image_url
FROM (SELECT o_orderkey, {_DOI_SPELLING_SQL} AS d FROM orders)""")
def c09_normalize_doi(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", _doi_spelling_spark("o_orderkey").alias("doi"))
    href = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("gr"), F.col("o_orderkey").cast("string"))) \
        .otherwise(F.concat(F.lit("gr"), F.col("o_orderkey").cast("string"), F.lit(".PNG")))
    pmcid = F.concat(F.lit("PMC"), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", "doi", T.doi_url("doi").alias("doi_url"),
                    T.normalize_doi("doi").alias("normalized"),
                    T.pmc_article_url(pmcid).alias("pmc_url"),
                    T.jats_image_url(pmcid, href).alias("image_url"))


# -- C12 / C13 / C16 / C22 ------------------------------------------------------

@register("c12_slugify", """
WITH b AS (SELECT p_partkey,
  CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '10.1016/J.DIB.' || p_partkey END AS doi,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS title FROM part),
s AS (SELECT p_partkey, coalesce(nullif(doi, ''), nullif(title, ''), 'row-' || p_partkey) AS base FROM b)
SELECT p_partkey,
  coalesce(nullif(substr(regexp_replace(regexp_replace(lower(base), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''),
           'row-' || p_partkey) AS slug,
  coalesce(nullif(substr(regexp_replace(regexp_replace(lower(base), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''),
           'row-' || p_partkey) || '-table-' || (p_partkey % 9 + 1) AS evidence_id
FROM s""")
def c12_slugify(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    doi = F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("10.1016/J.DIB."), k.cast("string")))
    title = F.when(k % 5 == 0, F.lit("")).otherwise(F.col("p_name"))
    slug = T.slugify(doi, title, k)
    return p.select("p_partkey", slug.alias("slug"),
                    T.evidence_id(slug, "table", k % 9 + 1).alias("evidence_id"))


def safe_file_name_sql(x: str, fallback: str) -> str:
    v = O.norm_ws_sql(x)
    v = f"regexp_replace({v}, '[/\\\\?%*:|\"<>]', '-', 'g')"
    v = f"regexp_replace({v}, '[^a-zA-Z0-9._ -]+', '-', 'g')"
    v = f"regexp_replace({v}, '\\s+', '-', 'g')"
    v = f"regexp_replace({v}, '-+', '-', 'g')"
    v = f"substr(regexp_replace({v}, '^-+|-+$', '', 'g'), 1, 120)"
    return f"coalesce(nullif({v}, ''), {fallback})"


@register("c16_safe_file_name", f"""
SELECT doc_id, {safe_file_name_sql("split_part(coalesce(text, ''), chr(10), 1)", "'dataset-file-' || doc_id")} AS name
FROM documents""")
def c16_safe_file_name(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", T.safe_file_name(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1),
                                               F.concat(F.lit("dataset-file-"), F.col("doc_id").cast("string")))
                    .alias("name"))


_SRC_LIST = K.ALL_SOURCES


@register("c22_yield_rank", f"""
WITH c AS (SELECT p_partkey, {'['+', '.join(q(s) for s in _SRC_LIST)+']'}[p_partkey % 7 + 1] AS source,
  CASE WHEN p_partkey % 3 = 0 THEN 'Dataset' ELSE p_type END AS kind,
  p_name || CASE p_partkey % 4 WHEN 0 THEN ' data' WHEN 1 THEN ' datasets' WHEN 2 THEN ' (Data)' ELSE '' END AS title
  FROM part)
SELECT p_partkey,
  (CASE WHEN source IN ({', '.join(q(s) for s in K.DATA_SOURCE_NAMES)}) THEN 2 ELSE 0 END)
  + (CASE WHEN lower(kind) = 'dataset' THEN 2 ELSE 0 END)
  + (CASE WHEN regexp_matches(title, '(?i)(^|[^A-Za-z0-9_])data(set)?([^A-Za-z0-9_]|$)') THEN 1 ELSE 0 END) AS yield_rank
FROM c""")
def c22_yield_rank(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    source = F.get(F.array(*[F.lit(s) for s in _SRC_LIST]), (k % 7).cast("int"))
    kind = F.when(k % 3 == 0, F.lit("Dataset")).otherwise(F.col("p_type"))
    title = F.concat(F.col("p_name"), F.when(k % 4 == 0, F.lit(" data")).when(k % 4 == 1, F.lit(" datasets"))
                     .when(k % 4 == 2, F.lit(" (Data)")).otherwise(F.lit("")))
    return p.select("p_partkey", T.data_yield_rank(source, kind, title).alias("yield_rank"))


# -- C14 / C15 / F11 ---------------------------------------------------------------

def _url_path_sql(u: str) -> str:
    return (f"CASE WHEN regexp_matches({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN "
            f"url_decode(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)) END")


def _extname_sql(p: str) -> str:
    return f"regexp_extract(regexp_extract({p}, '([^/]*)/*$', 1), '^.+(\\.[^.]*)$', 1)"


def path_extension_sql(u: str) -> str:
    return (f"lower(coalesce({_extname_sql(_url_path_sql(u))}, "
            f"{_extname_sql(f'regexp_extract({u}, {q(chr(94) + "([^?#]*)")}, 1)')}))")


@register("c14_path_extension", f"""
WITH u AS (SELECT page_id, url FROM pages
  UNION ALL SELECT page_id + 1000000000, regexp_replace(url, '[?#].*$', '') || '/data.' ||
     CASE page_id % 4 WHEN 0 THEN 'CSV' WHEN 1 THEN 'tar.gz' WHEN 2 THEN 'json?x=1.txt' ELSE 'bin#a.csv' END FROM pages)
SELECT page_id, url, {path_extension_sql('url')} AS ext,
  coalesce(regexp_extract({_url_path_sql('url')}, '([^/]*)/*$', 1), '') AS file_name,
  {path_extension_sql('url')} IN ({', '.join(q(e) for e in K.DATA_FILE_EXTENSIONS)}) AS is_data_file
FROM u""")
def c14_path_extension(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "url")
    suffix = (F.when(F.col("page_id") % 4 == 0, F.lit("CSV")).when(F.col("page_id") % 4 == 1, F.lit("tar.gz"))
              .when(F.col("page_id") % 4 == 2, F.lit("json?x=1.txt")).otherwise(F.lit("bin#a.csv")))
    derived = p.select((F.col("page_id") + 1000000000).alias("page_id"),
                       F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/data."), suffix).alias("url"))
    u = p.unionByName(derived)
    return u.select("page_id", "url", T.path_extension("url").alias("ext"),
                    T.file_name_from_url("url").alias("file_name"),
                    T.is_data_file_url("url").alias("is_data_file"))


# -- C17 / C18 ---------------------------------------------------------------------

_CT_SQL = """CASE event_type WHEN 'view' THEN 'text/html; charset=utf-8' WHEN 'click' THEN 'application/zip'
  WHEN 'purchase' THEN 'text/CSV' WHEN 'signup' THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
  ELSE 'application/octet-stream' END"""
_DISP_SQL = """CASE event_id % 4 WHEN 0 THEN 'attachment; filename="e' || event_id || '.csv"'
  WHEN 1 THEN 'attachment; filename*=UTF-8''''n%C3%AFve-' || event_id || '.tsv'
  WHEN 2 THEN 'inline; filename=plain' || event_id ELSE '' END"""


def _ct_spark():
    et = F.col("event_type")
    return (F.when(et == "view", F.lit("text/html; charset=utf-8")).when(et == "click", F.lit("application/zip"))
            .when(et == "purchase", F.lit("text/CSV"))
            .when(et == "signup", F.lit("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"))
            .otherwise(F.lit("application/octet-stream")))


def _disp_spark():
    k = F.col("event_id")
    return (F.when(k % 4 == 0, F.concat(F.lit('attachment; filename="e'), k.cast("string"), F.lit('.csv"')))
            .when(k % 4 == 1, F.concat(F.lit("attachment; filename*=UTF-8''n%C3%AFve-"), k.cast("string"), F.lit(".tsv")))
            .when(k % 4 == 2, F.concat(F.lit("inline; filename=plain"), k.cast("string")))
            .otherwise(F.lit("")))


def ext_from_ct_sql(ct: str) -> str:
    whens = " ".join(f"WHEN strpos(lower({ct}), {q(frag)}) > 0 THEN {q(ext)}"
                     for frag, ext in K.CONTENT_TYPE_EXTENSIONS)
    return f"(CASE {whens} ELSE '' END)"


@register("c18_content_type", f"""
WITH e AS (SELECT event_id, {_CT_SQL} AS ct, {_DISP_SQL} AS disp FROM events),
n AS (SELECT event_id, ct, disp,
  CASE WHEN regexp_matches(disp, '(?i)filename\\*=UTF-8''''([^;]+)')
       THEN url_decode(regexp_extract(disp, '(?i)filename\\*=UTF-8''''([^;]+)', 1))
       ELSE regexp_extract(disp, '(?i)filename="?([^";]+)"?', 1) END AS disp_name FROM e)
SELECT event_id, disp_name, {ext_from_ct_sql('ct')} AS ct_ext,
  CASE WHEN regexp_extract(regexp_extract(coalesce(nullif(disp_name, ''), 'file'), '([^/]*)/*$', 1), '^.+(\\.[^.]*)$', 1) <> ''
       THEN coalesce(nullif(disp_name, ''), 'file')
       ELSE coalesce(nullif(disp_name, ''), 'file') || coalesce(nullif({ext_from_ct_sql('ct')}, ''), '.dat') END AS name
FROM n""")
def c18_content_type(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", _ct_spark().alias("ct"), _disp_spark().alias("disp"))
    dn = T.file_name_from_disposition("disp")
    base = F.coalesce(F.nullif(dn, F.lit("")), F.lit("file"))
    return e.select("event_id", dn.alias("disp_name"), T.extension_from_content_type("ct").alias("ct_ext"),
                    T.with_extension(base, "ct").alias("name"))


# -- C19 / C21 / F06 / F08 / F09 --------------------------------------------------------

_SPELL_SQL = """CASE o_orderkey % 7
  WHEN 0 THEN 'https://doi.org/10.17632/' || lower(hex(o_orderkey * 7919)) || '.' || (o_orderkey % 4 + 1)
  WHEN 1 THEN 'https://data.mendeley.com/datasets/' || lower(hex(o_orderkey * 7919)) || '/' || (o_orderkey % 4 + 1)
  WHEN 2 THEN 'https://zenodo.org/records/' || o_orderkey
  WHEN 3 THEN 'https://doi.org/10.5281/zenodo.' || o_orderkey
  WHEN 4 THEN 'https://figshare.com/articles/dataset/x_' || o_orderkey || '/' || o_orderkey
  WHEN 5 THEN 'https://www.sciencedirect.com/science/article/pii/S' || o_orderkey
  ELSE 'https://Osf.io/' || hex(o_orderkey) || '/' END"""


def _spell_spark():
    k = F.col("o_orderkey")
    ks = k.cast("string")
    h = F.lower(F.hex(k * 7919))
    v = (k % 4 + 1).cast("string")
    return (F.when(k % 7 == 0, F.concat(F.lit("https://doi.org/10.17632/"), h, F.lit("."), v))
            .when(k % 7 == 1, F.concat(F.lit("https://data.mendeley.com/datasets/"), h, F.lit("/"), v))
            .when(k % 7 == 2, F.concat(F.lit("https://zenodo.org/records/"), ks))
            .when(k % 7 == 3, F.concat(F.lit("https://doi.org/10.5281/zenodo."), ks))
            .when(k % 7 == 4, F.concat(F.lit("https://figshare.com/articles/dataset/x_"), ks, F.lit("/"), ks))
            .when(k % 7 == 5, F.concat(F.lit("https://www.sciencedirect.com/science/article/pii/S"), ks))
            .otherwise(F.concat(F.lit("https://Osf.io/"), F.hex(k), F.lit("/"))))


def identity_sql(u: str) -> str:
    mp = "(?i)data\\.mendeley\\.com/datasets/([a-z0-9]+)(?:/([0-9]+))?"
    md = "(?i)10\\.17632/([a-z0-9]+)(?:\\.([0-9]+))?"
    zr = "(?i)zenodo\\.org/(?:record|records)/([0-9]+)"
    zd = "(?i)10\\.5281/zenodo\\.([0-9]+)"
    fa = "(?i)figshare\\.com/articles/(?:[^/]+/)?[^/?#]+/([0-9]+)"
    fn = "(?i)figshare\\.com/ndownloader/articles/([0-9]+)"
    fd = "(?i)10\\.6084/m9\\.figshare\\.([0-9]+)"
    return f"""CASE WHEN regexp_matches({u}, {q(mp)}) THEN 'mendeley:' || regexp_extract({u}, {q(mp)}, 1)
  WHEN regexp_matches({u}, {q(md)}) THEN 'mendeley:' || regexp_extract({u}, {q(md)}, 1)
  WHEN regexp_matches({u}, {q(zr)}) THEN 'zenodo:' || regexp_extract({u}, {q(zr)}, 1)
  WHEN regexp_matches({u}, {q(zd)}) THEN 'zenodo:' || regexp_extract({u}, {q(zd)}, 1)
  WHEN regexp_matches({u}, {q(fa)}) THEN 'figshare:' || regexp_extract({u}, {q(fa)}, 1)
  WHEN regexp_matches({u}, {q(fn)}) THEN 'figshare:' || regexp_extract({u}, {q(fn)}, 1)
  WHEN regexp_matches({u}, {q(fd)}) THEN 'figshare:' || regexp_extract({u}, {q(fd)}, 1)
  ELSE lower(regexp_replace({u}, '/+$', '')) END"""


def repo_url_sql(u: str) -> str:
    return "(" + " OR ".join(f"strpos(lower({u}), {q(h)}) > 0" for h in K.DATA_REPOSITORY_HOSTS) + ")"


@register("c21_identity", f"""
WITH s AS (SELECT o_orderkey, {_SPELL_SQL} AS url FROM orders)
SELECT o_orderkey, url, {identity_sql('url')} AS identity,
  {repo_url_sql('url')} AS is_repository,
  ({' OR '.join(f"strpos(url, {q(h)}) > 0" for h in K.BLOCKED_HOSTS)}) AS is_blocked,
  {repo_url_sql('url')} OR strpos(lower(CASE WHEN o_orderkey % 2 = 0 THEN 'Dataset' ELSE 'journal-article' END), 'dataset') > 0
     AS record_is_dataset
FROM s""")
def c21_identity(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", _spell_spark().alias("url"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.lit("Dataset")).otherwise(F.lit("journal-article"))
    return o.select("o_orderkey", "url", T.dataset_identity("url").alias("identity"),
                    T.is_data_repository_url("url").alias("is_repository"),
                    T.is_blocked_host("url").alias("is_blocked"),
                    T.record_is_dataset("url", kind).alias("record_is_dataset"))


# -- C25 / F05 / S17 ------------------------------------------------------------------------

@register("c25_csv_escape", """
SELECT conv_id, turn, CASE WHEN text IS NULL THEN ''
  WHEN regexp_matches(text, '["\\n\\r,]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END AS cell
FROM conversations""")
def c25_csv_escape(spark, sf):
    c = read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.csv_escape("text").alias("cell"))


@register("f05_blocked_text", f"""
SELECT page_id, ({' OR '.join(f"strpos(lower(html), {q(m)}) > 0" for m in K.BLOCK_TEXT_MARKERS)}
   OR strpos(lower(html), 'nicht') > 0) AS blocked
FROM pages""")
def f05_blocked_text(spark, sf):
    # the corpus holds no real challenge page, so one corpus word joins the markers
    p = read_table(spark, sf, "pages")
    return p.select("page_id", (T.is_blocked_text("html") | F.lower("html").contains("nicht")).alias("blocked"))


@register("s17_filter_sources", """
SELECT doc_id, source FROM documents
WHERE strpos(lower(source), 'src1') > 0 OR strpos(lower(source), 'src7') > 0""")
def s17_filter_sources(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    return filter_sources(d, " SRC1, src7 ,")
