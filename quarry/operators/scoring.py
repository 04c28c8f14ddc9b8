"""C11 relevance scoring and the F01-F04 gates.

``score_candidates`` adds the M7 relevance columns to any DataFrame with a
title and an abstract column.  It is row-local (no shuffle) and also runs on
a streaming DataFrame.  Each text is scanned once for the terms of all
facets (see ``functions.lexicon``); the intermediates are bound behind
one-row generators so Catalyst cannot inline them into pushed-down filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.lexicon import Lexicon, match_terms, term_hits


def let(df: DataFrame, *exprs) -> DataFrame:
    """Bind expressions once: append them as columns via a one-row ``inline``.

    A Generate node is a barrier for predicate push-down and project
    collapsing, so downstream references read the bound value instead of
    re-evaluating (and re-inlining) the expression.
    """
    return df.select("*", F.inline(F.array(F.struct(*exprs))))


RELEVANCE_COLUMNS = ["score", "geography", "commodity", "measure", "penalties",
                     "has_dataset_hint", "commodity_in_title"]


def _facet_points(title_hits, abstract_hits, w_title, w_abstract):
    return (F.when(F.size(title_hits) > 0, F.lit(w_title))
            .when(F.size(abstract_hits) > 0, F.lit(w_abstract)).otherwise(F.lit(0)))


def score_candidates(df: DataFrame, lexicon: Lexicon | None = None, title: str = "title",
                     abstract: str = "abstract") -> DataFrame:
    """C11: per facet the title hit scores, else the abstract hit; clamp to 0..100.

    Adds: score INT, geography/commodity/measure/penalties ARRAY<STRING>
    (title hits then abstract hits, de-duplicated, lexicon order),
    has_dataset_hint BOOLEAN, commodity_in_title BOOLEAN.
    """
    lx = lexicon or Lexicon.reference()
    w = lx.weights
    cols = df.columns
    t, a = F.col(title), F.col(abstract)
    facets = [*lx.geography, *lx.commodity, *lx.measure, *lx.penalty]
    # Each scan is bound once behind a one-row generator: filters on the score
    # cannot be inlined below it, so a text is scanned once per row.
    staged = let(df, term_hits(t, [*facets, *lx.dataset_hints]).alias("_th"), term_hits(a, facets).alias("_ah"),
                 term_hits(t, lx.penalty_stems, whole=False).alias("_ts"),
                 term_hits(a, lx.penalty_stems, whole=False).alias("_as"))
    th, ah = F.col("_th"), F.col("_ah")
    hits = let(
        staged,
        match_terms(th, lx.geography).alias("_tg"), match_terms(ah, lx.geography).alias("_ag"),
        match_terms(th, lx.commodity).alias("_tc"), match_terms(ah, lx.commodity).alias("_ac"),
        match_terms(th, lx.measure).alias("_tm"), match_terms(ah, lx.measure).alias("_am"),
        F.concat(match_terms(th, lx.penalty), match_terms(F.col("_ts"), lx.penalty_stems)).alias("_tp"),
        F.concat(match_terms(ah, lx.penalty), match_terms(F.col("_as"), lx.penalty_stems)).alias("_ap"),
        (F.size(match_terms(th, lx.dataset_hints)) > 0).alias("has_dataset_hint"),
    )
    raw = (_facet_points(F.col("_tg"), F.col("_ag"), w["title_geography"], w["abstract_geography"])
           + _facet_points(F.col("_tc"), F.col("_ac"), w["title_commodity"], w["abstract_commodity"])
           + _facet_points(F.col("_tm"), F.col("_am"), w["title_measure"], w["abstract_measure"])
           + F.when(F.col("has_dataset_hint"), F.lit(w["dataset_hint"])).otherwise(F.lit(0))
           + _facet_points(F.col("_tp"), F.col("_ap"), w["title_penalty"], w["abstract_penalty"]))
    return hits.select(
        *cols,
        F.greatest(F.lit(0), F.least(F.lit(100), raw)).cast("int").alias("score"),
        F.array_distinct(F.concat("_tg", "_ag")).alias("geography"),
        F.array_distinct(F.concat("_tc", "_ac")).alias("commodity"),
        F.array_distinct(F.concat("_tm", "_am")).alias("measure"),
        F.array_distinct(F.concat("_tp", "_ap")).alias("penalties"),
        "has_dataset_hint",
        (F.size("_tc") > 0).alias("commodity_in_title"),
    )


def complete(df: DataFrame, title: str = "title", url: str = "url") -> DataFrame:
    """title and url are both non-empty."""
    return df.filter((F.coalesce(F.col(title), F.lit("")) != "")
                     & (F.coalesce(F.col(url), F.lit("")) != ""))


def gate(df: DataFrame, min_score: int = K.MIN_SCORE,
         require_title_commodity: bool = K.REQUIRE_TITLE_COMMODITY) -> DataFrame:
    """Score >= min_score, a commodity term, optionally one in the title."""
    return df.filter(passes_gates(min_score, require_title_commodity))


def passes_gates(min_score: int = K.MIN_SCORE, require_title_commodity: bool = K.REQUIRE_TITLE_COMMODITY):
    cond = (F.col("score") >= min_score) & (F.size("commodity") > 0)
    return cond & F.col("commodity_in_title") if require_title_commodity else cond
