"""Scans of the landed parquet tables and the corpus candidate view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import norm_ws

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Provenance ordinals carried by every candidate (P6): arrival order is
# (keyword_ord, variant_ord, source_ord, item_ord), smaller = earlier.
ORDER_COLUMNS = ["keyword_ord", "variant_ord", "source_ord", "item_ord"]

CANDIDATE_FIELDS = ["title", "abstract", "journal", "doi", "published", "url", "kind", "search_url"]


def read_table(spark: SparkSession, sf_dir: str, name: str, rebalance: bool = False) -> DataFrame:
    """A landed table.

    ``rebalance`` deals its rows out anew, for queries with much work per row
    over tables that are landed as a single row group; operators never do it,
    and a corpus of many files needs none.
    """
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return table.hint("rebalance") if rebalance else table


def documents_as_candidates(documents: DataFrame) -> DataFrame:
    """Candidate view (M6 + provenance) of a text corpus.

    title = first line (whitespace-normalised), abstract = everything after
    the first line feed, doi = 10.9999/doc.<id>, url = https://ex.org/<id>,
    kind = lang, item_ord = doc_id.  A pure projection: fuses with the scan.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nl = F.instr(text, "\n")
    return documents.select(
        F.lit(0).alias("keyword_ord"),
        F.lit("").alias("keyword"),
        F.lit(0).alias("variant_ord"),
        F.lit("").alias("variant"),
        F.lit(0).alias("source_ord"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.col("doc_id").cast("long").alias("item_ord"),
        norm_ws(F.substring_index(text, "\n", 1)).alias("title"),
        F.when(nl > 0, F.expr("substr(coalesce(text, ''), instr(coalesce(text, ''), '\n') + 1)"))
         .otherwise(F.lit("")).alias("abstract"),
        F.lit("").alias("journal"),
        F.concat(F.lit("10.9999/doc."), F.col("doc_id").cast("string")).alias("doi"),
        F.lit("").alias("published"),
        F.concat(F.lit("https://ex.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.coalesce(F.col("lang"), F.lit("")).alias("kind"),
        F.lit("").alias("search_url"),
    )
