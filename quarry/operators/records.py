"""Records: nest evidence under articles (A05), flatten (U03), summaries and analyst queries.

``assemble_records`` groups each evidence kind by article (groups bounded by
one article's evidence) and left-joins the three arrays onto the article
rows.  ``flatten_records`` is a single ``explode`` over the concatenation of
the per-kind struct arrays: one scan, no union of five scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..shared import numbered
from .skew import salted_join

FLAT = K.FLAT_RECORD_COLUMNS


def _nest(df: DataFrame, article: str, order: str, name: str) -> DataFrame:
    cols = [c for c in df.columns if c != article]
    return df.groupBy(article).agg(F.transform(F.sort_array(F.collect_list(
        F.struct(F.col(order).alias("_o"), F.struct(*cols).alias("v")))), lambda x: x["v"]).alias(name))


def assemble_records(articles: DataFrame, tables: DataFrame, figures: DataFrame, links: DataFrame,
                     article: str = "article_id", key: str | None = None) -> DataFrame:
    """One nested record per article (extraction.tables/figures/datasetLinks in order).

    ``key`` is the column that tells articles apart in all four tables (the
    target's position); ``article`` is the slug, a label that different
    articles may share, and serves as the key only where none is given.
    """
    key = key or article
    given = [c for c in ("candidate_urls", "errors") if c in articles.columns]
    t = _nest(tables, key, "table_number", "tables")
    f = _nest(figures, key, "figure_number", "figures")
    ln = _nest(links, key, "link_number", "dataset_links")
    j = articles.join(t, key, "left").join(f, key, "left").join(ln, key, "left")
    empty = F.array()
    return j.select(
        *[c for c in articles.columns if c not in given],
        F.struct(F.col("attempted"), F.col("loaded"), F.col("mode"), F.col("final_url"), *given,
                 F.coalesce(F.col("tables"), empty).alias("tables"),
                 F.coalesce(F.col("figures"), empty).alias("figures"),
                 F.coalesce(F.col("dataset_links"), empty).alias("dataset_links")).alias("extraction"),
        F.array().cast("array<struct<id:string,file:string,url:string,resolvedUrl:string,label:string,"
                       "value:string,status:string>>").alias("statistics"))


def flatten_records(records: DataFrame, article: str = "article_id", key: str | None = None) -> DataFrame:
    """Article row + table/figure/dataset_link/statistic rows in one explode.

    ``key``, the column that tells records apart where slugs repeat, stays on every row.
    """
    e = F.col("extraction")
    fields = ("id", "n", "file", "url", "resolvedUrl", "caption", "rows", "columns", "text", "status")

    def piece(kind, **given):
        none = F.lit(None)
        return F.struct(F.lit(kind).alias("kind"), *[given.get(c, none).cast("string").alias(c) for c in fields])

    art = piece("article", url=F.col("url"), status=X.extraction_status(e["attempted"], e["loaded"]))
    tables = F.transform(e["tables"], lambda t: piece(
        "table", n=t["table_number"], file=t["file"], caption=t["caption"], rows=t["rows"], columns=t["columns"], status=F.lit("extracted")))
    figures = F.transform(e["figures"], lambda f: piece(
        "figure", n=f["figure_number"], file=f["file"], url=f["image_url"], caption=f["caption"], status=F.lit("extracted")))
    links = F.transform(e["dataset_links"], lambda ln: piece(
        "dataset", n=ln["link_number"], file=ln["downloaded_files"], url=ln["url"], resolvedUrl=ln["resolved_url"], text=ln["text"],
        status=X.download_status(ln["download_status"], ln["n_files"], ln["n_errors"])))
    stats = F.transform(F.col("statistics"), lambda s: piece(
        "statistic", id=s["id"], file=s["file"], url=s["url"], resolvedUrl=s["resolvedUrl"], caption=s["label"], text=s["value"],
        status=F.coalesce(s["status"], F.lit("extracted"))))
    # the article's columns go along; what a row makes of both is computed behind the explode, where unread columns fall away
    whole = {c: F.col(c) for c in ("doi", "title", "source", "score", "kind", "commodity", "measure")}
    whole |= {"_id": F.col(article), "articleUrl": e["final_url"]}
    kept = [key] if key else []
    rows = records.select(*kept, *[v.cast("string").alias(f"_a_{c}") for c, v in whole.items()],
                          F.posexplode(F.concat(F.array(art), tables, figures, links, stats)).alias("record_ord", "r"))
    kind, slug = F.col("r.kind"), F.col("_a__id")
    is_article = kind == "article"
    flat = {c: F.col(f"_a_{c}") for c in whole if c != "_id"} | {c: F.col(f"r.{c}") for c in fields[2:]}
    flat |= {
        "recordId": F.when(is_article, slug).when(kind == "statistic", F.col("r.id")).otherwise(F.concat_ws("-", slug, kind, F.col("r.n"))),
        "parentRecordId": F.when(~is_article, slug), "recordType": F.when(is_article, "article").otherwise("evidence"),
        "evidenceType": F.when(kind == "dataset", "dataset_link").otherwise(kind),
        "text": F.when(kind.isin("table", "figure"), F.concat(kind, F.lit(" "), F.col("r.n"))).otherwise(F.col("r.text"))}
    return rows.select(*kept, "record_ord", *[F.coalesce(flat.get(c, F.lit("")), F.lit("")).alias(c) for c in FLAT])


def extraction_summary(records: DataFrame) -> DataFrame:
    """Pages loaded/failed, tables, figure captions/images, links, downloaded files — one aggregate."""
    e = F.col("extraction")
    return records.agg(
        F.count_if(e["loaded"]).alias("pages_loaded"),
        F.count_if(e["attempted"] & ~e["loaded"]).alias("pages_failed"),
        F.coalesce(F.sum(F.size(e["tables"])), F.lit(0)).alias("tables"),
        F.coalesce(F.sum(F.size(e["figures"])), F.lit(0)).alias("figure_captions"),
        F.coalesce(F.sum(F.size(F.filter(e["figures"], lambda f: F.coalesce(f["file"], F.lit("")) != ""))),
                   F.lit(0)).alias("figure_images"),
        F.coalesce(F.sum(F.size(e["dataset_links"])), F.lit(0)).alias("dataset_links"),
        F.coalesce(F.sum(F.aggregate(e["dataset_links"], F.lit(0).cast("long"),
                                     lambda acc, ln: acc + ln["n_files"].cast("long"))), F.lit(0))
        .alias("downloaded_files"),
        F.count(F.lit(1)).alias("records"))


def substantial_tables(flat: DataFrame) -> DataFrame:
    """Table evidence, most rows first, numbered by ``rank`` (ties by record id)."""
    return numbered(flat.filter(F.col("evidenceType") == "table"),
                    [(F.col("rows").cast("int"), True), (F.col("recordId"), False)], "rank")


def thin_tables(flat: DataFrame) -> DataFrame:
    """Table evidence, fewest rows first (to spot layout tables), numbered by ``rank``."""
    return numbered(flat.filter(F.col("evidenceType") == "table"),
                    [(F.col("rows").cast("int"), False), (F.col("recordId"), False)], "rank")


def downloaded_links(flat: DataFrame) -> DataFrame:
    """Dataset links whose files were downloaded."""
    return flat.filter((F.col("evidenceType") == "dataset_link") & (F.col("status") == "downloaded"))


def join_evidence(flat: DataFrame, key: str | None = None) -> DataFrame:
    """Evidence rows joined to their article row (parentRecordId = recordId).

    Slugs may be shared: with ``key`` (what ``flatten_records`` kept) each evidence row meets its own article only.
    """
    on = ["parentRecordId", *([key] if key else [])]
    art = flat.filter(F.col("recordType") == "article").select(
        F.col("recordId").alias("parentRecordId"), *on[1:], F.col("title").alias("article_title"),
        F.col("status").alias("article_status"))
    return flat.filter(F.col("recordType") == "evidence").join(art, on)


def articles_with_data(flat: DataFrame, key: str | None = None) -> DataFrame:
    """Article rows having at least one dataset link with downloaded files (left semi-join), by ``key`` where slugs repeat."""
    on = ["recordId", *([key] if key else [])]
    has = flat.filter((F.col("evidenceType") == "dataset_link") & (F.col("file") != "")) \
        .select(F.col("parentRecordId").alias("recordId"), *on[1:])
    return flat.filter(F.col("recordType") == "article").join(has, on, "left_semi")


def shared_deposits(links: DataFrame, article: str = "article_id") -> DataFrame:
    """Deposits (identities) linked from more than one article, long form (identity, article).

    No collect_set: a popular deposit may be linked from millions of articles,
    so the result stays one row per (identity, article), and the counts meet
    the pairs with heavy deposits salted.
    """
    pairs = links.select("identity", article).distinct()
    multi = pairs.groupBy("identity").agg(F.count(F.lit(1)).alias("n_articles")).filter(F.col("n_articles") > 1)
    return salted_join(pairs, multi, ["identity"], [article])
