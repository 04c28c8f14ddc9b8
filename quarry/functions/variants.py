"""C28/C29 query decomposition as higher-order array functions (no shuffle).

A keyword line is matched against the geography, commodity and measure
facets; each facet's hits are sorted longest-first (stable) and terms that
are substrings of an earlier kept term are dropped.  The probe set is the
cross product of the first geography (specific before broad), commodity and
measure terms, as many of each as the caller says, with repeated words
removed; the line itself stays first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .lexicon import Lexicon, match_terms, term_hits
from .text import _s


def drop_subsumed(terms: Column) -> Column:
    """Longest-first stable sort, then drop a term contained in any earlier one."""
    keyed = F.transform(terms, lambda t, i: F.struct((-F.length(t)).alias("nl"), i.alias("i"), t.alias("t")))
    ordered = F.transform(F.array_sort(keyed), lambda s: s["t"])
    return F.transform(F.array(ordered), lambda o: F.filter(
        o, lambda t, i: ~F.exists(F.slice(o, 1, i), lambda longer: longer.contains(t))))[0]


def _words_variant(g: Column, c: Column, m: Column) -> Column:
    joined = F.array_join(F.filter(F.array(g, c, m), lambda x: x != ""), " ")
    words = F.array_distinct(F.filter(F.split(joined, " "), lambda w: w != ""))
    return F.trim(F.array_join(words, " "))


def facet_hits(lexicon: Lexicon, hits: Column) -> dict:
    """C02 + C29 per facet: the subsumption-free hits of a keyword line, from its ``term_hits``."""
    return {"geo": drop_subsumed(match_terms(hits, lexicon.geography)),
            "com": drop_subsumed(match_terms(hits, lexicon.commodity)),
            "mea": drop_subsumed(match_terms(hits, lexicon.measure))}


def keyword_hits(keyword, lexicon: Lexicon) -> Column:
    """The terms of the three probe facets in a keyword line, from one scan; bind it before reading it."""
    return term_hits(_s(keyword), [*lexicon.geography, *lexicon.commodity, *lexicon.measure])


def variants_from_facets(keyword, geo: Column, com: Column, mea: Column,
                         max_variants: int | None = None, broad=None, max_geography: int = 1,
                         max_commodity: int = 2, max_measure: int = 3) -> Column:
    """C28 from precomputed facet hits (see ``facet_hits``).

    The line itself, then the probes; all of them unless ``max_variants``
    (the line included) says how many to keep.
    """
    broad = list(broad if broad is not None else K.BROAD_GEOGRAPHY_TERMS)
    kw = _s(keyword)
    empty = F.array(F.lit(""))
    specific = F.filter(geo, lambda t: ~t.isin(broad)) if broad else geo
    ranked = F.concat(specific, geo)
    gp = F.when(F.size(ranked) > 0, F.array_distinct(F.slice(ranked, 1, max_geography))).otherwise(empty)
    cp = F.when(F.size(com) > 0, F.slice(com, 1, max_commodity)).otherwise(empty)
    mp = F.when(F.size(mea) > 0, F.slice(mea, 1, max_measure)).otherwise(empty)
    cross = F.flatten(F.transform(gp, lambda g: F.flatten(F.transform(
        cp, lambda c: F.transform(mp, lambda m: _words_variant(g, c, m))))))
    low = F.lower(kw)
    probes = F.array_distinct(F.filter(cross, lambda v: (v != "") & (v != low)))
    if max_variants is not None:
        probes = F.slice(probes, 1, max(0, max_variants - 1))
    return F.when((F.size(com) == 0) & (F.size(mea) == 0), F.array(kw)).otherwise(F.concat(F.array(kw), probes))


def query_variants(keyword, max_variants: int | None = None, lexicon: Lexicon | None = None, broad=None) -> Column:
    """C28 (+T05): ARRAY<STRING>, the line itself first, then its probes.

    For many lines use ``operators.search.expand_variants``, which binds each step once.
    """
    lx = lexicon or Lexicon.reference()
    h = facet_hits(lx, keyword_hits(keyword, lx))
    return variants_from_facets(keyword, h["geo"], h["com"], h["mea"], max_variants, broad)
