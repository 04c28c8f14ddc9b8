"""Landed search responses synthesised from the driver tables (Spark jobs).

The reference reads JSON search responses from five metadata services.  To
test the normalisers on real volumes, each relational table is rendered as
the response shape of one service; the oracle is the table itself.  Items
are grouped 50 per response (the default results-per-search), so every
group is bounded; building the OpenAlex inverted index is a per-row sort,
not a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import JSWS
from ..sources.tables import read_table

ITEMS_PER_RESPONSE = 50


def _jstr(c: Column) -> Column:
    """JSON string literal of a column (null -> null)."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def inverted_index_json(text: Column) -> Column:
    """token -> positions JSON object of whitespace-split text, built per row.

    The text is escaped as one string, and its escaped tokens are sorted: escaping knows no neighbours.
    """
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), JSWS + "+", " "))
    escaped = F.transform(F.array(F.to_json(F.array(words))), lambda j: j.substr(F.lit(3), F.length(j) - 4))[0]

    def body(p):
        return F.array_join(F.transform(p, lambda x, i: F.when(
            i == 0, F.concat(F.lit('"'), x["t"], F.lit('":['), x["i"].cast("string")))
            .when(F.get(p, i - 1)["t"] == x["t"], F.concat(F.lit(","), x["i"].cast("string")))
            .otherwise(F.concat(F.lit('],"'), x["t"], F.lit('":['), x["i"].cast("string")))), "")

    def index(e):
        pairs = F.sort_array(F.transform(F.split(e, " "), lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
        return F.transform(F.array(pairs), body)[0]
    inner = F.transform(F.array(escaped), lambda e: F.when(e != "", F.concat(F.lit("{"), index(e), F.lit("]}"))).otherwise(F.lit("{}")))
    return inner[0]


def _responses(items: DataFrame, key: str, source: Column, wrap_pre: str, wrap_post: str,
               url_base: str) -> DataFrame:
    g = items.groupBy(F.floor(F.col(key) / ITEMS_PER_RESPONSE).alias("resp"))
    agg = g.agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col("item").alias("item"))))
                .alias("its"), F.first(source).alias("source"))
    return agg.select(
        F.col("resp").cast("int").alias("keyword_ord"), F.lit("").alias("keyword"),
        F.lit(0).alias("variant_ord"), F.lit("").alias("variant"), "source",
        F.concat(F.lit(url_base), F.col("resp").cast("string")).alias("search_url"),
        F.concat(F.lit(wrap_pre), F.array_join(F.transform("its", lambda x: x["item"]), ","),
                 F.lit(wrap_post)).alias("body"))


def openalex_responses(spark, sf) -> DataFrame:
    d = read_table(spark, sf, "documents", rebalance=True)
    k = F.col("doc_id")
    text = F.coalesce(F.col("text"), F.lit(""))
    first = F.substring_index(text, "\n", 1)
    rest = F.when(F.instr(text, "\n") > 0, F.expr("substr(coalesce(text, ''), instr(coalesce(text, ''), '\n') + 1)")) \
        .otherwise(F.lit(""))
    base = F.to_json(F.struct(
        F.concat(F.lit("https://openalex.org/W"), k.cast("string")).alias("id"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("https://doi.org/10.9999/doc."), k.cast("string")))
        .alias("doi"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(first).alias("title"),
        first.alias("display_name"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("2021-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))).alias("publication_date"),
        (F.lit(2000) + k % 20).alias("publication_year"),
        F.col("lang").alias("type"),
        F.struct(F.concat(F.lit("https://ex.org/"), k.cast("string")).alias("landing_page_url"),
                 F.struct(F.col("source").alias("display_name")).alias("source")).alias("primary_location"),
    ))
    item = F.concat(F.regexp_replace(base, r"\}$", ""), F.lit(',"abstract_inverted_index":'),
                    inverted_index_json(rest), F.lit("}"))
    return _responses(d.select("doc_id", item.alias("item")), "doc_id", F.lit("OpenAlex"),
                      '{"results":[', "]}", "https://api.openalex.org/works?search=q")


def crossref_responses(spark, sf) -> DataFrame:
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    parts = F.array(F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")))
    item = F.to_json(F.struct(
        F.array(F.concat(F.lit("<i>"), F.col("o_orderpriority"), F.lit("</i> &amp; order "), k.cast("string")))
        .alias("title"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("<p>status "), F.col("o_orderstatus"), F.lit("</p>")))
        .alias("abstract"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.array(F.col("o_orderstatus"))).alias("container-title"),
        F.concat(F.lit("10.5555/o."), k.cast("string")).alias("DOI"),
        F.when(k % 2 == 0, F.concat(F.lit("https://ex.org/o/"), k.cast("string"))).otherwise(F.lit("")).alias("URL"),
        F.when(k % 4 != 0, F.struct(parts.alias("date-parts"))).alias("published"),
        F.when(k % 4 == 0, F.struct(parts.alias("date-parts"))).alias("published-print"),
    ))
    src = F.when(F.floor(k / ITEMS_PER_RESPONSE) % 2 == 0, F.lit("Crossref")).otherwise(F.lit("Crossref Data Journals"))
    return _responses(o.select("o_orderkey", item.alias("item"), src.alias("src")), "o_orderkey", F.col("src"),
                      '{"message":{"items":[', "]}}", "https://api.crossref.org/works?q=")


def datacite_responses(spark, sf) -> DataFrame:
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    descs = F.when(k % 2 == 0, F.array(
        F.struct(F.col("p_type").alias("description"), F.lit("Other").alias("descriptionType")),
        F.struct(F.concat(F.lit("<b>"), F.col("p_brand"), F.lit("</b>")).alias("description"),
                 F.lit("Abstract").alias("descriptionType")))) \
        .otherwise(F.array(F.struct(F.col("p_type").alias("description"), F.lit("Other").alias("descriptionType"))))
    base = F.to_json(F.struct(
        F.array(F.struct(F.col("p_name").alias("title"))).alias("titles"),
        descs.alias("descriptions"),
        F.concat(F.lit("10.5061/p."), k.cast("string")).alias("doi"),
        F.col("p_size").alias("publicationYear"),
        F.lit("").alias("url"),
    ))
    publisher = F.when(k % 2 == 0, F.concat(F.lit('{"name":'), _jstr(F.col("p_brand")), F.lit("}"))) \
        .otherwise(_jstr(F.col("p_brand")))
    attrs = F.concat(F.regexp_replace(base, r"\}$", ""), F.lit(',"publisher":'), publisher, F.lit("}"))
    item = F.concat(F.lit('{"attributes":'), attrs, F.lit("}"))
    return _responses(p.select("p_partkey", item.alias("item")), "p_partkey", F.lit("DataCite"),
                      '{"data":[', "]}", "https://api.datacite.org/dois?q=")


def zenodo_responses(spark, sf) -> DataFrame:
    s = read_table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    n = F.col("s_nationkey").cast("string")
    item = F.to_json(F.struct(
        F.when(k % 2 == 0, F.concat(F.lit("10.5281/zenodo."), k.cast("string"))).alias("doi"),
        F.struct(F.concat(F.lit("https://zenodo.org/records/"), k.cast("string")).alias("self_html")).alias("links"),
        F.struct(
            F.col("s_name").alias("title"),
            F.concat(F.lit("<p>nation "), n, F.lit("</p>")).alias("description"),
            F.when(k % 3 == 0, F.struct(F.concat(F.lit("J"), n).alias("title"))).alias("journal"),
            F.when(k % 3 == 1, F.concat(F.lit("Pub"), n)).alias("publisher"),
            F.when(k % 4 == 1, F.concat(F.lit("10.5281/zenodo.9"), k.cast("string"))).alias("doi"),
            F.lit("2020-01-01").alias("publication_date"),
            F.struct(F.lit("dataset").alias("type")).alias("resource_type"),
        ).alias("metadata"),
    ))
    return _responses(s.select("s_suppkey", item.alias("item")), "s_suppkey", F.lit("Zenodo"),
                      '{"hits":{"hits":[', "]}}", "https://zenodo.org/api/records?q=")


def html_responses(spark, sf) -> DataFrame:
    """Result pages of the two HTML sources, 50 customers each: headings of articles, or result boxes with
    relative links that climb a folder; a link to elsewhere on every page."""
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    key, name = k.cast("string"), F.col("c_name")
    source = F.when(F.floor(k / ITEMS_PER_RESPONSE) % 2 == 0, F.lit("Scientific Data")).otherwise(F.lit("IEEE DataPort"))
    item = F.when(source == "Scientific Data", F.concat(
        F.lit('<article><h3><a href="/articles/s'), key, F.lit('"> '), name, F.lit(" &amp;  data</a></h3></article>"))) \
        .otherwise(F.concat(F.lit('<div class="search-result"><a href="../documents/d'), key, F.lit('">'), name,
                            F.lit("</a></div>")))
    pre = '<html><body><a href="/about">About</a>'
    return _responses(c.select("c_custkey", item.alias("item"), source.alias("src")), "c_custkey", F.col("src"),
                      pre, "</body></html>", "https://results.example.org/search/list?q=")


def search_responses(spark, sf) -> DataFrame:
    """The synthesised response sets of all seven sources as one ``search_responses`` table."""
    out = openalex_responses(spark, sf)
    for f in (crossref_responses, datacite_responses, zenodo_responses, html_responses):
        out = out.unionByName(f(spark, sf))
    return out


PAGE_CHUNK = 200


def supplier_pages(spark, sf) -> DataFrame:
    """One HTML page per (nation, supplier-key block of 200): a data table of the
    block's suppliers (caption inside for even nations, a preceding <p> for odd),
    a 1x1 layout table, one figure and one empty figure.  ``nation`` is the fixed
    25-row dimension, so broadcasting it is size-bounded by definition."""
    s = read_table(spark, sf, "supplier")
    n = read_table(spark, sf, "nation")
    rows = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        "n_nationkey", "n_name", (F.floor(F.col("s_suppkey") / PAGE_CHUNK)).cast("int").alias("chunk"),
        "s_suppkey",
        F.concat(F.lit("<tr><td>"), F.col("s_name"), F.lit("</td><td> "), F.col("s_suppkey").cast("string"),
                 F.lit(" </td></tr>")).alias("tr"))
    g = rows.groupBy("n_nationkey", "chunk").agg(
        F.first("n_name").alias("n_name"),
        F.array_sort(F.collect_list(F.struct("s_suppkey", "tr"))).alias("trs"))
    nk = F.col("n_nationkey").cast("string")
    head = F.when(F.col("n_nationkey") % 2 == 0,
                  F.concat(F.lit("<table><caption>"), F.col("n_name"), F.lit("</caption>"))) \
        .otherwise(F.concat(F.lit("<p>"), F.col("n_name"), F.lit(" suppliers</p><table>")))
    html = F.concat(
        F.lit("<html><body><div>"), head, F.array_join(F.transform("trs", lambda x: x["tr"]), ""),
        F.lit("</table><table><tr><td>layout</td></tr></table>"),
        F.lit('<figure><img src="/img/'), nk, F.lit('.png"><figcaption>Fig. '), nk,
        F.lit(" "), F.col("n_name"), F.lit("</figcaption></figure><figure></figure></div></body></html>"))
    url = F.concat(F.lit("https://ex.org/nation/"), nk, F.lit("/"), F.col("chunk").cast("string"))
    return g.select("n_nationkey", "chunk", url.alias("url"), html.alias("html"))
