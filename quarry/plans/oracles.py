"""DuckDB SQL builders for the correctness oracle.

These spell the *specification* (one regex per term, window-based
first-wins) rather than the Spark strategy, so the oracle checks the
tokenised matcher against the regex semantics it replaces.
"""

from __future__ import annotations

import re

from ..functions import constants as K
from ..functions.lexicon import Lexicon

# ECMAScript whitespace for RE2.
WS = r"[\t\n\x{0B}\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _re_quote(w: str) -> str:
    return re.sub(r"([.*+?^${}()|\[\]\\/-])", r"\\\1", w)


def term_re(term: str) -> str:
    body = (WS + "+").join(_re_quote(w) for w in term.split(" "))
    return r"(?i)(^|[^a-z0-9])" + body + r"([^a-z0-9]|$)"


def stem_re(stem: str) -> str:
    return r"(?i)(^|[^a-z0-9])" + _re_quote(stem) + r"[a-z]*"


def hits_sql(text: str, terms, stems=()) -> str:
    items = [f"CASE WHEN regexp_matches(coalesce({text}, ''), {q(term_re(t))}) THEN {q(t)} END"
             for t in terms]
    items += [f"CASE WHEN regexp_matches(coalesce({text}, ''), {q(stem_re(s))}) THEN {q(s)} END"
              for s in stems]
    if not items:
        return "[]::VARCHAR[]"
    return f"list_filter([{', '.join(items)}]::VARCHAR[], lambda x: x IS NOT NULL)"


def odistinct(expr: str) -> str:
    """Order-preserving distinct of a list expression."""
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


def norm_ws_sql(expr: str) -> str:
    return f"trim(regexp_replace(coalesce({expr}, ''), {q(WS + '+')}, ' ', 'g'))"


def dedupe_key_sql(title: str, doi: str) -> str:
    nt = f"trim(regexp_replace(lower({title}), '[^a-z0-9]+', ' ', 'g'))"
    nd = (f"regexp_replace(regexp_replace(lower({doi}), '^https?://doi\\.org/', ''), "
          f"'\\.v?[0-9]+$', '')")
    return (f"CASE WHEN length({nt}) >= 15 THEN 'title:' || {nt} "
            f"WHEN coalesce({doi}, '') <> '' THEN 'doi:' || {nd} ELSE 'title:' || {nt} END")


def candidates_sql() -> str:
    """documents -> candidate view (mirrors sources.tables.documents_as_candidates)."""
    return f"""
SELECT 0 AS keyword_ord, '' AS keyword, 0 AS variant_ord, '' AS variant, 0 AS source_ord,
       coalesce(source, '') AS source, doc_id AS item_ord,
       {norm_ws_sql("split_part(coalesce(text, ''), chr(10), 1)")} AS title,
       CASE WHEN strpos(coalesce(text, ''), chr(10)) > 0
            THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
       '' AS journal, '10.9999/doc.' || CAST(doc_id AS VARCHAR) AS doi, '' AS published,
       'https://ex.org/' || CAST(doc_id AS VARCHAR) AS url, coalesce(lang, '') AS kind,
       '' AS search_url
FROM documents"""


def scored_sql(lx: Lexicon, cand_sql: str) -> str:
    w = lx.weights

    def pts(tf, af, wt, wa):
        return f"(CASE WHEN len({tf}) > 0 THEN {wt} WHEN len({af}) > 0 THEN {wa} ELSE 0 END)"

    return f"""
WITH c AS ({cand_sql}),
h AS (
  SELECT c.*,
    {hits_sql('title', lx.geography)} AS tg, {hits_sql('abstract', lx.geography)} AS ag,
    {hits_sql('title', lx.commodity)} AS tc, {hits_sql('abstract', lx.commodity)} AS ac,
    {hits_sql('title', lx.measure)} AS tm, {hits_sql('abstract', lx.measure)} AS am,
    {hits_sql('title', lx.penalty, lx.penalty_stems)} AS tp,
    {hits_sql('abstract', lx.penalty, lx.penalty_stems)} AS ap,
    len({hits_sql('title', lx.dataset_hints)}) > 0 AS has_dataset_hint
  FROM c WHERE coalesce(title, '') <> '' AND coalesce(url, '') <> ''
)
SELECT h.*,
  CAST(greatest(0, least(100,
    {pts('tg', 'ag', w['title_geography'], w['abstract_geography'])}
    + {pts('tc', 'ac', w['title_commodity'], w['abstract_commodity'])}
    + {pts('tm', 'am', w['title_measure'], w['abstract_measure'])}
    + (CASE WHEN has_dataset_hint THEN {w['dataset_hint']} ELSE 0 END)
    + {pts('tp', 'ap', w['title_penalty'], w['abstract_penalty'])})) AS INTEGER) AS score,
  {odistinct('list_concat(tg, ag)')} AS geography,
  {odistinct('list_concat(tc, ac)')} AS commodity,
  {odistinct('list_concat(tm, am)')} AS measure,
  {odistinct('list_concat(tp, ap)')} AS penalties,
  len(tc) > 0 AS commodity_in_title
FROM h"""


def discover_sql(lx: Lexicon, cand_sql: str, min_score: int = K.MIN_SCORE,
                 require_title_commodity: bool = True) -> str:
    tc = "AND commodity_in_title" if require_title_commodity else ""
    return f"""
WITH s AS ({scored_sql(lx, cand_sql)}),
g AS (SELECT s.*, {dedupe_key_sql('title', 'doi')} AS dedupe_key FROM s
      WHERE score >= {min_score} AND len(commodity) > 0 {tc}),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY dedupe_key
      ORDER BY score DESC, keyword_ord, variant_ord, source_ord, item_ord) = 1)
SELECT score, source, kind, title, journal, published, doi, url, abstract,
       array_to_string(geography, '; ') AS geography,
       array_to_string(commodity, '; ') AS commodity,
       array_to_string(measure, '; ') AS measure,
       keyword, search_url, dedupe_key, keyword_ord, variant_ord, source_ord, item_ord
FROM b"""
