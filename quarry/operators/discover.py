"""Discover-stage operators: W01/W02 keep-best, T01 rank, A01/A02 counts, M8 rows.

Scale notes
-----------
* ``keep_best`` is ONE hash/sort aggregate with map-side partial
  aggregation (``max_by`` over a struct), not a row_number window: a hot
  key (e.g. all non-Latin titles share ``title:``, or a deposit family
  shares ``doi:10.5281/zenodo``) is reduced to one row per map task before
  the shuffle, so even a key holding a third of all rows never lands whole
  in one task.
* ``rank`` numbers rows in key-range buckets plus the buckets' offsets, in one
  plan (no single-partition window over the rows, nothing run at build).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import dedupe_key
from ..shared import numbered
from ..sources.tables import ORDER_COLUMNS


def with_dedupe_key(df: DataFrame, title: str = "title", doi: str = "doi") -> DataFrame:
    """W01/C10."""
    return df.withColumn("dedupe_key", dedupe_key(F.col(title), F.col(doi)))


def keep_best(df: DataFrame, key: str = "dedupe_key", score: str = "score",
              order: list[str] | None = None) -> DataFrame:
    """Per key the highest score; ties go to the earliest arrival.

    Arrival is the lexicographic order of ``order`` (default keyword, variant,
    source, item ordinals); the first seen copy survives an equal score.
    """
    order = order or ORDER_COLUMNS
    payload = F.struct(*[F.col(c) for c in df.columns if c != key])
    rank = F.struct(F.col(score).alias("s"), *[(-F.col(o)).alias(f"o{i}") for i, o in enumerate(order)])
    best = df.groupBy(key).agg(F.max_by(payload, rank).alias("_best"))
    return best.select(key, "_best.*")


def rank(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``rank`` = 0, 1, ... by score desc, then title by Unicode collation, then arrival order."""
    order = [c for c in (order or ORDER_COLUMNS) if c in df.columns]
    return numbered(df, [(F.col("score"), True), (F.collate(F.col("title"), "UNICODE"), False),
                         *[(F.col(c), False) for c in order]], "rank")


def article_rows(df: DataFrame) -> DataFrame:
    """M8: the article index row (term lists '; '-joined, A07)."""
    extra = [c for c in ["dedupe_key"] + ORDER_COLUMNS if c in df.columns]
    return df.select(
        F.col("score"), F.col("source"), F.col("kind"), F.col("title"), F.col("journal"),
        F.col("published"), F.col("doi"), F.col("url"), F.col("abstract"),
        F.array_join("geography", "; ").alias("geography"),
        F.array_join("commodity", "; ").alias("commodity"),
        F.array_join("measure", "; ").alias("measure"),
        F.col("keyword"), F.col("search_url"), *extra,
    )


def funnel(examined: DataFrame) -> DataFrame:
    """Candidates examined (before any gate), passing the gates, kept after de-dup, in one pass.

    Input: every candidate's (passes BOOLEAN, dedupe_key); as keep-best leaves
    one row per key, the kept are the distinct keys that pass.
    """
    key = F.when(F.col("passes"), F.col("dedupe_key"))
    counts = examined.agg(F.count(F.lit(1)).alias("examined"), F.count_if("passes").alias("passed"),
                          F.count_distinct(key).alias("kept"))
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).alias("n"))
                                            for c in ("examined", "passed", "kept")])))


def source_counts(kept: DataFrame) -> DataFrame:
    """Surviving rows per source, count desc."""
    return (kept.groupBy("source").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("source")))


def filter_sources(df: DataFrame, selection: str, column: str = "source") -> DataFrame:
    """Comma list, trimmed, lower-cased substring match on the source name; empty = all."""
    wanted = [s.strip().lower() for s in (selection or "").split(",") if s.strip()]
    if not wanted:
        return df
    low = F.lower(F.col(column))
    cond = None
    for s in wanted:
        c = low.contains(s)
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def cap_results(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The caller's result cap, at most OpenAlex's 200 or the others' 100; none unless given.

    ``item_ord`` is the 0-based position of the item inside its response.
    """
    if rows is None:
        return df
    cap = F.lit(min(rows, K.DEFAULT_RESULT_CAP))
    for name, c in K.SOURCE_RESULT_CAPS.items():
        cap = F.when(F.col("source") == name, F.lit(min(rows, c))).otherwise(cap)
    return df.filter(F.col("item_ord") < cap)
