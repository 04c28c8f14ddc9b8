"""Facet lexicons and whole-word term matching (M3, C02-C04, strategy P1).

A term hits a text iff ``(^|[^a-z0-9]) term ([^a-z0-9]|$)`` matches with
ASCII case folding, the term's inner spaces matching any run of
(ECMAScript) whitespace.  One regex per term per row would cost
O(|lexicon| x |text|); instead each text is scanned once for all terms:

1. the terms are folded into one prefix-tree pattern inside a look-ahead, so
   that at every word start the longest term there is captured, also where
   terms overlap (``regexp_extract_all``, constant pattern);
2. captured texts are lower-cased and their whitespace is collapsed;
3. each stands for itself and for the terms that begin it as whole words
   (a constant map);
4. ``array_intersect(terms, hits)`` keeps lexicon order and de-duplicates.

Stems (``(^|[^a-z0-9])stem[a-z]*``) hit iff some word starts with the stem;
they are scanned for in the same way, without the boundary at the end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import JSWS, _s, ascii_lower

def _clean(term: str) -> str:
    return re.sub(r"\s+", " ", term.strip().lower())


@dataclass(frozen=True)
class Lexicon:
    """Six ordered term lists plus the nine scoring weights (M3, M4)."""

    geography: tuple[str, ...]
    commodity: tuple[str, ...]
    measure: tuple[str, ...]
    penalty: tuple[str, ...]
    penalty_stems: tuple[str, ...]
    dataset_hints: tuple[str, ...]
    weights: dict = field(default_factory=lambda: dict(K.WEIGHTS))

    @staticmethod
    def of(geography, commodity, measure, penalty=(), penalty_stems=(), dataset_hints=(),
           weights=None) -> "Lexicon":
        return Lexicon(tuple(_clean(t) for t in geography), tuple(_clean(t) for t in commodity),
                       tuple(_clean(t) for t in measure), tuple(_clean(t) for t in penalty),
                       tuple(_clean(t) for t in penalty_stems),
                       tuple(_clean(t) for t in dataset_hints), dict(weights or K.WEIGHTS))

    @staticmethod
    def reference() -> "Lexicon":
        return Lexicon.of(K.GEOGRAPHY_TERMS, K.COMMODITY_TERMS, K.MEASURE_TERMS,
                          K.PENALTY_TERMS, K.PENALTY_STEMS, K.DATASET_HINT_TERMS)

    def facets(self) -> dict[str, tuple[str, ...]]:
        return {"geography": self.geography, "commodity": self.commodity,
                "measure": self.measure, "penalty": self.penalty,
                "dataset_hints": self.dataset_hints}

    def rows(self):
        """The lexicon as table rows (facet, ord, term, kind)."""
        out = []
        for facet, terms in self.facets().items():
            out += [(facet, i, t, "term") for i, t in enumerate(terms)]
        out += [("penalty", len(self.penalty) + i, s, "stem") for i, s in enumerate(self.penalty_stems)]
        return out


_NO_WORD_BEFORE, _NO_WORD_AFTER = "(?<![a-z0-9])", "(?![a-z0-9])"


def _java_quote(w: str) -> str:
    return re.sub(r"([.*+?^${}()|\[\]\\/-])", r"\\\1", w)


def _tree_pattern(terms: list[str]) -> str:
    """Alternation of the terms, folded by common prefixes; longer terms are tried first."""
    tree: dict = {}
    for t in terms:
        node = tree
        for ch in t:
            node = node.setdefault(ch, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        parts = [(JSWS + "+" if ch == " " else _java_quote(ch)) + pattern(child) for ch, child in node.items() if ch]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in node else "(?:" + "|".join(parts) + ")"
        return body + "?" if "" in node else body

    return pattern(tree)


def _begins(term: str, longer: str, whole: bool) -> bool:
    return longer.startswith(term) and (not whole or re.match(r"[^a-z0-9]|$", longer[len(term):]) is not None)


def term_hits(text, terms, whole: bool = True) -> Column:
    """Every term that occurs in the text (any order, maybe repeated), from one scan.

    ``whole=False`` drops the boundary at the end (stems).
    """
    terms = sorted({_clean(t) for t in terms})
    if not terms:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(_s(text), F.lit(
        "(?i)" + _NO_WORD_BEFORE + "(?=(" + _tree_pattern(terms) + ")" + (_NO_WORD_AFTER if whole else "") + ")"), 1)
    canonical = F.array_distinct(F.transform(F.array_distinct(found), lambda t: F.regexp_replace(
        ascii_lower(t), JSWS + "+", " ")))
    shorter = {t: [x for x in terms if x != t and _begins(x, t, whole)] for t in terms}
    pairs = [F.struct(F.lit(t).alias("key"), F.array(*[F.lit(x) for x in xs]).alias("value"))
             for t, xs in shorter.items() if xs]
    if not pairs:
        return canonical

    def with_shorter(hits):
        extra = F.transform(F.filter(F.array(*pairs), lambda p: F.array_contains(hits, p["key"])), lambda p: p["value"])
        return F.when(F.size(hits) > 0, F.concat(hits, F.flatten(extra))).otherwise(hits)

    return F.transform(F.array(canonical), with_shorter)[0]  # bound once: the scan isn't repeated


def match_terms(hits: Column, terms) -> Column:
    """The terms, in lexicon order, among a text's ``term_hits``."""
    terms = [_clean(t) for t in terms]
    return F.array_intersect(F.array(*[F.lit(t) for t in terms]), hits) if terms \
        else F.array().cast("array<string>")


def includes_any(text, terms) -> Column:
    """At least one term occurs as a whole word (one scan)."""
    if not terms:
        return F.lit(False)
    return _s(text).rlike("(?i)" + _NO_WORD_BEFORE + "(?:" + _tree_pattern(sorted({_clean(t) for t in terms})) + ")"
                          + _NO_WORD_AFTER)


def matched_terms(text, terms) -> Column:
    """C02 as a standalone Column function."""
    return match_terms(term_hits(text, terms), terms)


def matched_penalties(text, terms, stems) -> Column:
    """Whole-word penalty terms, then word-initial stems."""
    return F.concat(matched_terms(text, terms), match_terms(term_hits(text, stems, whole=False), stems))


__all__ = ["Lexicon", "term_hits", "match_terms", "includes_any", "matched_terms", "matched_penalties"]
