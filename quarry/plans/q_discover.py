"""Catalog: discover slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.discover import funnel, source_counts, with_dedupe_key
from ..operators.scoring import complete, gate, passes_gates, score_candidates
from ..sources.tables import documents_as_candidates, read_table
from . import oracles as O
from .catalog import register
from .discover import discover
from .fixtures import CORPUS_LEXICON


def _cands(spark, sf):
    return documents_as_candidates(read_table(spark, sf, "documents", rebalance=True))


# -- discover slice -----------------------------------------------------------

@register("w02_keep_best", O.discover_sql(CORPUS_LEXICON, O.candidates_sql()))
def w02_keep_best(spark, sf):
    """Flagship: corpus -> score -> gates -> de-dup key -> best copy per key."""
    return discover(_cands(spark, sf), CORPUS_LEXICON, ranked=False)


@register("t01_rank", f"""
SELECT *, row_number() OVER (ORDER BY score DESC, title COLLATE en, item_ord) - 1 AS rank
FROM ({O.discover_sql(CORPUS_LEXICON, O.candidates_sql())})""")
def t01_rank(spark, sf):
    return discover(_cands(spark, sf), CORPUS_LEXICON, ranked=True)


_SCORE_COLS = ["item_ord", "score", "geography", "commodity", "measure", "penalties",
               "has_dataset_hint", "commodity_in_title"]


@register("c11_score", f"""
SELECT item_ord, score, array_to_string(geography, '; ') AS geography,
       array_to_string(commodity, '; ') AS commodity, array_to_string(measure, '; ') AS measure,
       array_to_string(penalties, '; ') AS penalties, has_dataset_hint, commodity_in_title
FROM ({O.scored_sql(CORPUS_LEXICON, O.candidates_sql())})""")
def c11_score(spark, sf):
    s = score_candidates(complete(_cands(spark, sf)), CORPUS_LEXICON)
    return s.select("item_ord", "score", *[F.array_join(c, "; ").alias(c) for c in
                                           ["geography", "commodity", "measure", "penalties"]],
                    "has_dataset_hint", "commodity_in_title")


@register("f02_gated", f"""
SELECT item_ord, score FROM ({O.scored_sql(CORPUS_LEXICON, O.candidates_sql())})
WHERE score >= 45 AND len(commodity) > 0 AND commodity_in_title""")
def f02_gated(spark, sf):
    return gate(score_candidates(complete(_cands(spark, sf)), CORPUS_LEXICON)).select("item_ord", "score")


@register("c10_dedupe_key", f"""
SELECT doc_id, {O.dedupe_key_sql(O.norm_ws_sql("split_part(coalesce(text, ''), chr(10), 1)"),
                                  "'10.9999/doc.' || CAST(doc_id AS VARCHAR)")} AS dedupe_key
FROM documents""")
def c10_dedupe_key(spark, sf):
    c = with_dedupe_key(_cands(spark, sf))
    return c.select(F.col("item_ord").alias("doc_id"), "dedupe_key")


@register("a01_funnel", f"""
WITH s AS ({O.scored_sql(CORPUS_LEXICON, O.candidates_sql())}),
p AS (SELECT * FROM s WHERE score >= 45 AND len(commodity) > 0 AND commodity_in_title),
k AS (SELECT DISTINCT {O.dedupe_key_sql('title', 'doi')} FROM p)
SELECT 'examined' AS stage, (SELECT count(*) FROM documents) AS n
UNION ALL SELECT 'passed', (SELECT count(*) FROM p)
UNION ALL SELECT 'kept', (SELECT count(*) FROM k)""")
def a01_funnel(spark, sf):
    scored = score_candidates(_cands(spark, sf), CORPUS_LEXICON)
    done = (F.coalesce(F.col("title"), F.lit("")) != "") & (F.coalesce(F.col("url"), F.lit("")) != "")
    return funnel(with_dedupe_key(scored.withColumn("passes", done & passes_gates())))


@register("a02_source_counts", f"""
SELECT source, count(*) AS count FROM ({O.discover_sql(CORPUS_LEXICON, O.candidates_sql())})
GROUP BY source""")
def a02_source_counts(spark, sf):
    return source_counts(discover(_cands(spark, sf), CORPUS_LEXICON, ranked=False))
