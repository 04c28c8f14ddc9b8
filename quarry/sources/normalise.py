"""Landed search responses -> one candidate schema (M6 + ordinals).

Input: ``search_responses(keyword_ord, keyword, variant_ord, variant, source,
search_url, body)``, one row per landed response.  A body is parsed by the one
schema of its source (P7, a CASE on ``source``), every item becomes the same
struct, and ``posexplode`` gives ``item_ord``, its position in the response.
All narrow: no shuffle, any number of responses.

Missing-value rules: ``a || b`` (skip null and '') is
``coalesce(nullif(a,''), b)``; ``a ?? b`` (skip null only) is ``coalesce``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import crossref_date, doi_url, reconstruct_abstract, strip_html
from ..operators.pages import parse_pages, parse_search_results

PROVENANCE = ["keyword_ord", "keyword", "variant_ord", "variant", "source_ord", "source"]
CANDIDATE_COLUMNS = PROVENANCE + ["item_ord", "title", "abstract", "journal", "doi", "published",
                                  "url", "kind", "search_url"]

OPENALEX_SCHEMA = """results ARRAY<STRUCT<id: STRING, doi: STRING, title: STRING, display_name: STRING,
  abstract_inverted_index: MAP<STRING, ARRAY<INT>>, publication_date: STRING, publication_year: STRING,
  type: STRING, primary_location: STRUCT<landing_page_url: STRING, source: STRUCT<display_name: STRING>>>>"""

_DATE_PARTS = "STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>"
CROSSREF_SCHEMA = f"""message STRUCT<items: ARRAY<STRUCT<title: ARRAY<STRING>, abstract: STRING,
  `container-title`: ARRAY<STRING>, DOI: STRING, URL: STRING, published: {_DATE_PARTS},
  `published-print`: {_DATE_PARTS}, `published-online`: {_DATE_PARTS}>>>"""

# publisher is an object ({"name": ...}) or a plain string: a VARIANT, which tells a string that looks like
# an object from one.
DATACITE_SCHEMA = """data ARRAY<STRUCT<attributes: STRUCT<titles: ARRAY<STRUCT<title: STRING>>,
  descriptions: ARRAY<STRUCT<description: STRING, descriptionType: STRING>>, publisher: VARIANT,
  doi: STRING, publicationYear: STRING, url: STRING>>>"""

ZENODO_SCHEMA = """hits STRUCT<hits: ARRAY<STRUCT<doi: STRING, links: STRUCT<self_html: STRING>,
  metadata: STRUCT<title: STRING, description: STRING, journal: STRUCT<title: STRING>, publisher: STRING,
  doi: STRING, publication_date: STRING, resource_type: STRUCT<type: STRING>>>>>"""


def _nz(c: Column) -> Column:
    """`||` operand: '' behaves like null."""
    return F.nullif(c, F.lit(""))


def _as_struct(fields):
    return lambda it: F.struct(*[F.coalesce(v.cast("string"), F.lit("")).alias(k) for k, v in fields(it).items()])


def _candidates(responses: DataFrame, specs: dict) -> DataFrame:
    """One pass: each body is parsed by its own source's schema, its items become one struct type.

    ``specs``: source -> (schema, path of the item array, item -> fields).
    """
    items = None
    for name, (schema, path, fields) in specs.items():
        arr = F.from_json("body", schema)
        for p in path:
            arr = arr[p]
        one = F.transform(arr, _as_struct(fields))
        items = F.when(F.col("source") == name, one) if items is None else items.when(F.col("source") == name, one)
    own = responses.filter(F.col("source").isin(list(specs)))
    rows = own.select(*[c for c in responses.columns if c != "body"], F.posexplode(items).alias("item_ord", "it"))
    return _finish(rows, {k: F.col(f"it.{k}") for k in FIELDS})


FIELDS = ["title", "abstract", "journal", "doi", "published", "url", "kind"]


def _finish(df: DataFrame, fields: dict) -> DataFrame:
    src_ord = F.lit(-1)
    for i, n in enumerate(K.ALL_SOURCES):
        src_ord = F.when(F.col("source") == n, F.lit(i)).otherwise(src_ord)
    base = {c: F.col(c) if c in df.columns else F.lit(None).cast("string") for c in PROVENANCE}
    if "source_ord" not in df.columns:
        base["source_ord"] = src_ord
    return df.select(*[base[c].alias(c) for c in PROVENANCE], F.col("item_ord").cast("long").alias("item_ord"),
                     *[fields[k].alias(k) for k in FIELDS],
                     F.coalesce(F.col("search_url"), F.lit("")).alias("search_url"))


def _openalex(it: Column) -> dict:
    """N01."""
    raw_doi = F.coalesce(it["doi"], F.lit(""))
    return {
        "title": strip_html(F.coalesce(_nz(it["title"]), it["display_name"])),
        "abstract": reconstruct_abstract(it["abstract_inverted_index"]),
        "journal": it["primary_location"]["source"]["display_name"],
        "doi": F.regexp_replace(raw_doi, r"^https?://doi\.org/", ""),
        "published": F.coalesce(_nz(it["publication_date"]), it["publication_year"]),
        "url": F.coalesce(_nz(it["doi"]), _nz(it["primary_location"]["landing_page_url"]), _nz(it["id"])),
        "kind": it["type"],
    }


def _crossref(it: Column) -> dict:
    """N02 / N03 (same mapping, different request filter)."""
    parts = F.coalesce(F.get(it["published"]["date-parts"], 0),
                       F.get(it["published-print"]["date-parts"], 0),
                       F.get(it["published-online"]["date-parts"], 0))
    return {
        "title": strip_html(F.get(it["title"], 0)),
        "abstract": strip_html(it["abstract"]),
        "journal": F.get(it["container-title"], 0),
        "doi": it["DOI"],
        "published": F.when(parts.isNull(), F.lit("")).otherwise(crossref_date(parts)),
        "url": F.coalesce(_nz(it["URL"]), doi_url(it["DOI"])),
        "kind": F.lit("journal-article"),
    }


def _datacite(it: Column) -> dict:
    """N04."""
    a = it["attributes"]
    descs = a["descriptions"]
    abstract = F.coalesce(F.get(F.filter(descs, lambda x: x["descriptionType"] == "Abstract"), 0)["description"],
                          F.get(descs, 0)["description"])
    pub = a["publisher"]
    journal = F.coalesce(F.try_variant_get(pub, "$.name", "string"), F.try_variant_get(pub, "$", "string"))
    return {
        "title": strip_html(F.get(a["titles"], 0)["title"]),
        "abstract": strip_html(abstract),
        "journal": journal,
        "doi": a["doi"],
        "published": a["publicationYear"],
        "url": F.coalesce(_nz(a["url"]), doi_url(a["doi"])),
        "kind": F.lit("dataset"),
    }


def _zenodo(it: Column) -> dict:
    """N05."""
    m = it["metadata"]
    doi = F.coalesce(it["doi"], m["doi"])
    return {
        "title": strip_html(m["title"]),
        "abstract": strip_html(m["description"]),
        "journal": F.coalesce(m["journal"]["title"], m["publisher"], F.lit("Zenodo")),
        "doi": doi,
        "published": m["publication_date"],
        "url": F.coalesce(_nz(doi_url(doi)), _nz(it["links"]["self_html"])),
        "kind": m["resource_type"]["type"],
    }


# Registry in source order (defines source_ord), API sources first.
REGISTRY = {
    "OpenAlex": (OPENALEX_SCHEMA, ["results"], _openalex),
    "Crossref Data Journals": (CROSSREF_SCHEMA, ["message", "items"], _crossref),
    "Crossref": (CROSSREF_SCHEMA, ["message", "items"], _crossref),
    "DataCite": (DATACITE_SCHEMA, ["data"], _datacite),
    "Zenodo": (ZENODO_SCHEMA, ["hits", "hits"], _zenodo),
}


def normalise_openalex(responses: DataFrame, source: str = "OpenAlex") -> DataFrame:
    """N01."""
    return _candidates(responses, {source: REGISTRY["OpenAlex"]})


def normalise_crossref(responses: DataFrame, source: str = "Crossref") -> DataFrame:
    """N02 / N03."""
    return _candidates(responses, {source: REGISTRY["Crossref"]})


def normalise_datacite(responses: DataFrame, source: str = "DataCite") -> DataFrame:
    """N04."""
    return _candidates(responses, {source: REGISTRY["DataCite"]})


def normalise_zenodo(responses: DataFrame, source: str = "Zenodo") -> DataFrame:
    """N05."""
    return _candidates(responses, {source: REGISTRY["Zenodo"]})


def html_candidates(responses: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Candidates of HTML result pages, each source by its own selectors, base = the search URL."""
    names = [n for n in K.HTML_SOURCES if sources is None or n in sources]
    own = responses.filter(F.col("source").isin(names))
    keep = [c for c in responses.columns if c != "body"]
    parsed = parse_pages(own, body="body", base="search_url", keep=keep)
    rows = parse_search_results(parsed, keep, by_source={n: K.HTML_SOURCE_SELECTORS[n] for n in names})
    blank = F.lit("")
    return _finish(rows, {k: F.col(k) if k in ("title", "url") else blank for k in FIELDS})


def normalise_responses(responses: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Bag union of every enabled source's candidates.

    One pass over the JSON responses and one over the HTML pages, as a page
    goes through the parser's Python task and a JSON body must not.
    """
    specs = {n: spec for n, spec in REGISTRY.items() if sources is None or n in sources}
    pages = [n for n in K.HTML_SOURCES if sources is None or n in sources]
    parts = ([_candidates(responses, specs)] if specs else []) + ([html_candidates(responses, pages)] if pages else [])
    return reduce(lambda a, b: a.unionByName(b), parts)


def source_filter(works: DataFrame, source: str) -> DataFrame:
    """the predicate a source's requests carry, on a landed dump of works.

    Expects ``issn`` ARRAY<STRING> and ``type`` (Crossref), or ``resource_type`` (DataCite).
    """
    if source == "Crossref Data Journals":
        return works.filter(F.arrays_overlap("issn", F.array(*[F.lit(x) for x in K.DATA_JOURNAL_ISSNS]))
                            & (F.col("type") == "journal-article"))
    if source == "Crossref":
        return works.filter(F.col("type") == "journal-article")
    if source == "DataCite":
        return works.filter(F.lower("resource_type") == "dataset")
    return works
