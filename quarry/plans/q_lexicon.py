"""Catalog: a large lexicon as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import JSWS, ascii_lower
from ..operators.lexicon_table import index_lexicon, lexicon_rows, matched_by_facet, score_by_table
from ..operators.scoring import complete
from ..sources.tables import documents_as_candidates, read_table
from . import oracles as O
from .catalog import register
from .fixtures import CORPUS_LEXICON

#: DuckDB: the runs of words, white space alone between them, of a lower-cased text; (…, gram, size).
_SEGMENTS = ("unnest(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9"
             + O.WS[1:-1].replace("{", "{{").replace("}", "}}") + "]+'))")
_GRAMS = """(SELECT {key}, k AS size, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram FROM (
  SELECT {key}, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT {key}, regexp_extract_all(s, '[a-z0-9]+') AS w FROM (SELECT {key}, {seg} AS s FROM {table})),
  (SELECT unnest([1, 2, 3]) AS k)))"""


def _grams(key, table):
    return _GRAMS.format(key=key, seg=_SEGMENTS.format("coalesce(text, '')"), table=table)


def _benchmark_lexicon(spark, sf):
    """Every run of two or three words of the benchmark's texts is a term: of the facet of its length."""
    words = F.regexp_extract_all(ascii_lower(F.col("s")), F.lit("[a-z0-9]+"), F.lit(0))
    separated = F.split(F.coalesce(F.col("text"), F.lit("")), "(?i)[^a-z0-9" + JSWS[1:-1] + "]+")
    segments = read_table(spark, sf, "benchmark").select(F.explode(separated).alias("s")).select(words.alias("w"))
    at = segments.select("w", F.explode(F.sequence(F.lit(2), F.lit(3))).alias("k")).filter(F.size("w") >= F.col("k"))
    grams = at.select("k", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1), lambda i: F.array_join(F.slice("w", i, F.col("k")), " "))).alias("term"))
    return grams.distinct().select(F.concat(F.lit("of "), F.col("k").cast("string")).alias("facet"), F.hash("term").alias("ord"), "term",
                                   F.lit("term").alias("kind"))


@register("j07_lexicon_table", f"""
WITH t AS (SELECT DISTINCT gram, size FROM {_grams("item_id", "benchmark")} WHERE size > 1),
h AS (SELECT DISTINCT doc_id, gram, size FROM {_grams("doc_id", "documents")} SEMI JOIN t USING (gram, size))
SELECT doc_id, 'of ' || size AS facet, count(*) AS n_terms, md5(string_agg(gram, '|' ORDER BY gram)) AS terms FROM h GROUP BY doc_id, size""")
def j07_lexicon_table(spark, sf):
    """All documents against thousands of terms by one keyed join."""
    docs = read_table(spark, sf, "documents", rebalance=True).select("doc_id", "text")
    hits = matched_by_facet(docs, index_lexicon(_benchmark_lexicon(spark, sf)), ["doc_id"])
    return hits.select("doc_id", "facet", F.size("terms").cast("long").alias("n_terms"), F.md5(F.array_join(F.array_sort("terms"), "|")).alias("terms"))


@register("c11_score_by_table", f"""
SELECT item_ord, score, array_to_string(geography, '; ') AS geography, array_to_string(commodity, '; ') AS commodity, array_to_string(measure, '; ') AS measure,
  array_to_string(penalties, '; ') AS penalties, has_dataset_hint, commodity_in_title FROM ({O.scored_sql(CORPUS_LEXICON, O.candidates_sql())})""")
def c11_score_by_table(spark, sf):
    """C11 with the lexicon as a table."""
    docs = documents_as_candidates(read_table(spark, sf, "documents", rebalance=True))
    scored = score_by_table(complete(docs), lexicon_rows(spark, CORPUS_LEXICON), "item_ord")
    return scored.select("item_ord", "score", *[F.array_join(c, "; ").alias(c) for c in ("geography", "commodity", "measure", "penalties")],
                         "has_dataset_hint", "commodity_in_title")
