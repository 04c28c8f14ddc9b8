"""The corpus pipeline: quality classifier, line dedup, MinHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, lines, neardup, packing, quality
from quarry.llm.common import stored
from quarry.llm.queries import TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL can't express a learnt classifier, nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, learnt on this stage's own input, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.filter("predicted = 1").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts; every document stays."""
    kept = lines.apply_bitmaps(docs.select(*COLUMNS), lines.keep_bitmaps(docs))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates (five words, 0.8).

    Rows that share a doc_id are told apart by their texts: of identical ones one stays, and different
    ones are copies or not, each by its own text; of copies with one doc_id the smaller hash stays.
    """
    twice = stored(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("shared")), "shared-ids")
    if twice.isEmpty():
        gone = neardup.near_duplicates(docs).filter("not kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    named = docs.join(twice, "doc_id", "left").withColumn("node", F.when(F.col("shared"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")))
    shared = named.filter("shared").groupBy("node").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    real = stored(shared.select("node", F.col("row.doc_id").alias("real")), "real-ids")
    found = neardup.near_duplicates(named.select(F.col("node").alias("doc_id"), "text")).filter("doc_id is not null").select(F.col("doc_id").alias("node"), "component_id")
    found = stored(found.join(real, "node", "left").withColumn("real", F.coalesce("real", "node")), "copies")
    first = found.groupBy("component_id").agg(F.min(F.struct("real", "node")).alias("first"))
    gone = found.join(first, "component_id").filter("node <> first.node").select("node")
    alone = named.filter("shared is null").select("node", *COLUMNS)
    return alone.unionByName(shared.select("node", "row.*")).join(gone, "node", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all tokens into sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
