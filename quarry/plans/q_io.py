"""Catalog: readers and sinks, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.discover import article_rows, keep_best, with_dedupe_key
from ..operators.records import FLAT, flatten_records
from ..operators.scoring import complete, gate, score_candidates
from ..shared import shared_dir
from ..sources import responses as R
from ..sources import sinks
from ..sources.normalise import normalise_responses
from ..sources.tables import documents_as_candidates, read_table
from ..sources.works import read_works, write_works
from . import oracles as O
from . import synth
from .catalog import register
from .fixtures import CORPUS_LEXICON
from .q_records import FLAT_SQL, _records

q = O.q


def _place(spark, name):
    return f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"


# -- S05 ------------------------------------------------------------------------------------------
# Of the responses of the five services every seventh is cut short, the one after has its items in the wrong place, and so on.

_HURT = {3: "not JSON", 4: "items are no array", 5: "missing body"}


@register("s05_responses", f"""
WITH r AS (SELECT DISTINCT 'OpenAlex' AS source, floor(doc_id / 50)::INT AS k, count(*) OVER (PARTITION BY floor(doc_id / 50)) AS n FROM documents
  UNION ALL SELECT DISTINCT CASE WHEN floor(o_orderkey / 50) % 2 = 0 THEN 'Crossref' ELSE 'Crossref Data Journals' END, floor(o_orderkey / 50)::INT,
    count(*) OVER (PARTITION BY floor(o_orderkey / 50)) FROM orders
  UNION ALL SELECT DISTINCT 'DataCite', floor(p_partkey / 50)::INT, count(*) OVER (PARTITION BY floor(p_partkey / 50)) FROM part
  UNION ALL SELECT DISTINCT 'Zenodo', floor(s_suppkey / 50)::INT, count(*) OVER (PARTITION BY floor(s_suppkey / 50)) FROM supplier)
SELECT CASE WHEN k % 7 = 6 THEN 'Gopher' ELSE source END AS source, CASE k % 7 {' '.join(f"WHEN {k} THEN {q(v)}" for k, v in _HURT.items())} WHEN 6 THEN 'unknown source' ELSE '' END AS problem,
  count(*) AS n_responses, CAST(sum(CASE WHEN k % 7 < 3 THEN n ELSE 0 END) AS BIGINT) AS n_items FROM r GROUP BY 1, 2""")
def s05_responses(spark, sf):
    """Landed by source and read again: good responses are normalised, the others are counted by problem."""
    k = F.col("keyword_ord") % 7
    body = F.when(k == 3, F.expr("left(body, length(body) - 5)")) \
        .when(k == 5, F.lit(" ")).otherwise(F.col("body"))
    # a wrong place of the items: one number where the array should be
    wrong = F.create_map(*[x for n, b in (("OpenAlex", '{"results":1}'), ("Crossref", '{"message":{"items":1}}'), ("Crossref Data Journals", '{"message":{"items":"a"}}'),
                                          ("DataCite", '{"data":{"a":1}}'), ("Zenodo", '{"hits":{"hits":true}}')) for x in (F.lit(n), F.lit(b))])
    made = synth.search_responses(spark, sf).filter(F.col("source").isin(K.API_SOURCES))
    made = made.withColumn("body", F.when(k == 4, wrong[F.col("source")]).otherwise(body)).withColumn("source", F.when(k == 6, F.lit("Gopher")).otherwise(F.col("source")))
    at = _place(spark, "responses")
    R.land_responses(made, at)
    landed = R.read_search_responses(spark, at)
    items = normalise_responses(R.good_responses(landed), K.API_SOURCES).groupBy("source").agg(F.count(F.lit(1)).alias("n_items"))
    good = R.good_responses(landed).groupBy("source").agg(F.count(F.lit(1)).alias("n_responses")).join(items, "source", "left")
    bad = R.dead_letters(landed).groupBy("source", "problem").agg(F.count(F.lit(1)).alias("n_responses"))
    return good.select("source", F.lit("").alias("problem"), "n_responses", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items")).unionByName(
        bad.select("source", "problem", "n_responses", F.lit(0).cast("long").alias("n_items")))


# -- S04 / S07 / S08 ------------------------------------------------------------------------------

def _index(spark, sf):
    docs = documents_as_candidates(read_table(spark, sf, "documents", rebalance=True))
    return article_rows(keep_best(with_dedupe_key(gate(score_candidates(complete(docs), CORPUS_LEXICON)))))


_INDEX_SQL = O.discover_sql(CORPUS_LEXICON, O.candidates_sql())


@register("s07_articles_json", f"SELECT {', '.join('search_url' if c == 'searchUrl' else c for c in K.ARTICLE_JSON_COLUMNS)} FROM ({_INDEX_SQL})")
def s07_articles_json(spark, sf):
    at = _place(spark, "articles-json")
    sinks.write_articles_json(_index(spark, sf), at)
    return sinks.read_articles(spark, at)


@register("s08_articles_csv", f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in K.ARTICLE_CSV_COLUMNS)} FROM ({_INDEX_SQL})")
def s08_articles_csv(spark, sf):
    at = _place(spark, "articles-csv")
    sinks.write_articles_csv(_index(spark, sf), at)
    return _read_csv(spark, at, K.ARTICLE_CSV_COLUMNS)


def _read_csv(spark, at, columns):
    """The sink's dialect; a line break inside quotes is part of a value, a blank is an empty string."""
    rows = spark.read.options(**sinks.CSV_OPTIONS).option("multiLine", True).schema(", ".join(f"`{c}` string" for c in columns)).csv(at)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


# -- S14 / S15 / S16 ------------------------------------------------------------------------------

@register("s14_records_json", f"""
SELECT "recordId" AS article_id, url, CAST(count(*) FILTER (WHERE x = 'table') AS BIGINT) AS n_tables, CAST(count(*) FILTER (WHERE x = 'figure') AS BIGINT) AS n_figures,
  max(CASE WHEN x = 'table' THEN caption END) AS caption FROM (SELECT a."recordId", a.url, e."evidenceType" AS x, e.caption FROM ({FLAT_SQL}) a JOIN ({FLAT_SQL}) e
  ON e."parentRecordId" = a."recordId" WHERE a."recordType" = 'article') GROUP BY 1, 2""")
def s14_records_json(spark, sf):
    at = _place(spark, "records-json")
    records = _records(spark, sf)
    sinks.write_records_json(records, at)
    back = spark.read.schema(records.schema).json(at)
    tables = F.col("extraction.tables")
    return back.select("article_id", "url", F.size(tables).cast("long").alias("n_tables"), F.size("extraction.figures").cast("long").alias("n_figures"),
                       F.get(tables, 0)["caption"].alias("caption"))


@register("s15_records_csv", f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in FLAT)} FROM ({FLAT_SQL})")
def s15_records_csv(spark, sf):
    at = _place(spark, "records-csv")
    sinks.write_records_csv(flatten_records(_records(spark, sf)), at)
    return _read_csv(spark, at, FLAT)


@register("s16_publish", """
SELECT 'documents' AS output, doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'again' ELSE 'first' END AS run FROM documents WHERE doc_id % 6 <> 3
UNION ALL SELECT 'labels', doc_id, CASE WHEN doc_id % 3 = 0 THEN 'again' ELSE 'first' END FROM labels""")
def s16_publish(spark, sf):
    """Two outputs published together, then a third of the ids run again: half of those leave no document row."""
    at = _place(spark, "published")
    again = read_table(spark, sf, "documents").select("doc_id").unionByName(read_table(spark, sf, "labels").select("doc_id")).filter("doc_id % 3 = 0")

    def rows(name, run):
        return read_table(spark, sf, name).select("doc_id", F.lit(run).alias("run"))
    sinks.publish(spark, at, {n: rows(n, "first") for n in ("documents", "labels")})
    sinks.publish(spark, at, {"documents": rows("documents", "again").filter("doc_id % 6 = 0"), "labels": rows("labels", "again").filter("doc_id % 3 = 0")}, again, "doc_id")
    parts = [sinks.published(spark, at, n).select(F.lit(n).alias("output"), F.col("doc_id").alias("id"), "run") for n in ("documents", "labels")]
    return parts[0].unionByName(parts[1])


# -- F18 ------------------------------------------------------------------------------------------

@register("f18_dump", f"""
SELECT 'Crossref Data Journals' AS source, o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0
UNION ALL SELECT 'Crossref', o_orderkey FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'DataCite', o_orderkey FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT 'Zenodo', o_orderkey FROM orders""")
def f18_dump(spark, sf):
    """The sources' predicates on a dump laid out for them; every third work has two of the journals' ISSNs."""
    k = F.col("o_orderkey")
    works = read_table(spark, sf, "orders").select(
        k, F.when(k % 3 == 0, F.array(F.lit("0000-0000"), F.lit(K.DATA_JOURNAL_ISSNS[1]), F.lit(K.DATA_JOURNAL_ISSNS[0]))).when(k % 7 == 0, F.array(F.lit("1111-1111")))
        .otherwise(F.array().cast("array<string>")).alias("issn"),
        F.when(k % 2 == 0, F.lit("journal-article")).otherwise(F.lit("book")).alias("type"),
        F.when(k % 5 == 0, F.lit("Dataset")).otherwise(F.lit("Text")).alias("resource_type"))
    at = _place(spark, "works")
    write_works(works, at)
    parts = [read_works(spark, at, n).select(F.lit(n).alias("source"), "o_orderkey") for n in ("Crossref Data Journals", "Crossref", "DataCite", "Zenodo")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
