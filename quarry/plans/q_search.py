"""Catalog: keyword lines, query variants and the search plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.search import expand_variants, search_plan
from ..sources.keywords import keyword_lines
from ..sources.tables import read_table
from . import oracles as O
from .catalog import register
from .fixtures import CORPUS_BROAD, CORPUS_LEXICON

q = O.q
LX = CORPUS_LEXICON


def _lines(spark, sf):
    return keyword_lines(read_table(spark, sf, "conversations"), "text", ["conv_id", "turn"])


# ECMAScript whitespace, spelt out for DuckDB's regex
_WS = r"[\s\x0B\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_LINES_SQL = f"""
SELECT conv_id, turn, line_no - 1 AS line_no, keyword
FROM (SELECT conv_id, turn, line_no, regexp_replace(raw, '^{_WS}+|{_WS}+$', '', 'g') AS keyword
      FROM (SELECT conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
            FROM conversations))
WHERE keyword <> '' AND NOT starts_with(keyword, '#')"""


def _dropsub(x: str) -> str:
    o = (f"list_transform(list_sort(list_transform({x}, lambda t, i: {{'nl': -length(t), 'i': i, 't': t}})), "
         f"lambda s: s.t)")
    return (f"list_filter({o}, lambda t, i: NOT coalesce(list_bool_or(list_transform(({o})[1:i-1], "
            f"lambda y: contains(y, t))), false))")


def variants_sql() -> str:
    broad = "[" + ", ".join(q(b) for b in CORPUS_BROAD) + "]::VARCHAR[]"
    build = ("array_to_string(" + O.odistinct(
        "list_filter(string_split(array_to_string(list_filter([a, b, z], lambda y: y <> ''), ' '), ' '), "
        "lambda w: w <> '')") + ", ' ')")
    return f"""
WITH k AS ({_LINES_SQL}),
m AS (SELECT *, {_dropsub(O.hits_sql('keyword', LX.geography))} AS g,
              {_dropsub(O.hits_sql('keyword', LX.commodity))} AS c,
              {_dropsub(O.hits_sql('keyword', LX.measure))} AS m FROM k),
p AS (SELECT *, list_concat(list_filter(g, lambda t: NOT list_contains({broad}, t)), g) AS rg FROM m),
x AS (SELECT *,
  flatten(list_transform(CASE WHEN len(rg) > 0 THEN rg[1:1] ELSE [''] END, lambda a:
    flatten(list_transform(CASE WHEN len(c) > 0 THEN c[1:2] ELSE [''] END, lambda b:
      list_transform(CASE WHEN len(m) > 0 THEN m[1:3] ELSE [''] END, lambda z: {build}))))) AS xprod FROM p),
v AS (SELECT *, CASE WHEN len(c) = 0 AND len(m) = 0 THEN [keyword]
  ELSE list_concat([keyword], ({O.odistinct("list_filter(xprod, lambda v: v <> '' AND v <> lower(keyword))")}))
  END AS variants FROM x)
SELECT conv_id, turn, line_no, keyword, i - 1 AS variant_ord, variants[i] AS variant
FROM (SELECT *, generate_subscripts(variants, 1) AS i FROM v)"""


@register("c28_variants", variants_sql())
def c28_variants(spark, sf):
    return expand_variants(_lines(spark, sf), None, LX, broad=CORPUS_BROAD) \
        .select("conv_id", "turn", "line_no", "keyword", "variant_ord", "variant")


@register("j06_search_plan", f"""
WITH v AS ({variants_sql()}),
s AS (SELECT unnest([{', '.join(str(i) for i in range(len(K.ALL_SOURCES)))}]) AS source_ord,
             unnest([{', '.join(q(n) for n in K.ALL_SOURCES)}]) AS source)
SELECT conv_id, turn, line_no, variant_ord, variant, source_ord, source
FROM v, s""")
def j06_search_plan(spark, sf):
    v = expand_variants(_lines(spark, sf), None, LX, broad=CORPUS_BROAD)
    return search_plan(v).select(
        "conv_id", "turn", "line_no", "variant_ord", "variant", "source_ord", "source")
