"""J05/J06 search plan: keyword -> variants -> (variant x enabled source).

Both fan-outs are ``posexplode`` generators over per-row arrays: no join,
no shuffle, and the plan rows stay partitioned like the keyword lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.lexicon import Lexicon
from ..functions.variants import facet_hits, keyword_hits, variants_from_facets
from .scoring import let


def expand_variants(keywords: DataFrame, max_variants: int | None = None,
                    lexicon: Lexicon | None = None, keyword: str = "keyword", broad=None,
                    max_geography: int = 1, max_commodity: int = 2, max_measure: int = 3) -> DataFrame:
    """C28 per row, exploded: (…, variant_ord, variant).

    A probe set takes at most one geography, two commodities and three measures, which is its definition;
    the arguments change it.

    The scan and the facet hits are bound once (generator "let") before
    later steps read them several times.  All variants unless ``max_variants``.
    """
    cols = keywords.columns
    lx = lexicon or Lexicon.reference()
    scanned = let(keywords, keyword_hits(F.col(keyword), lx).alias("_vh"))
    h = facet_hits(lx, F.col("_vh"))
    staged = let(scanned, h["geo"].alias("_vg"), h["com"].alias("_vc"), h["mea"].alias("_vm"))
    v = variants_from_facets(F.col(keyword), F.col("_vg"), F.col("_vc"), F.col("_vm"), max_variants, broad, max_geography, max_commodity,
                             max_measure)
    return staged.select(*cols, F.posexplode(v).alias("variant_ord", "variant"))


def enabled_sources(selection: str = "", skip_html: bool = False) -> list[str]:
    """S17 on the registry (N07 order defines source_ord)."""
    wanted = [s.strip().lower() for s in (selection or "").split(",") if s.strip()]
    names = K.API_SOURCES + ([] if skip_html else K.HTML_SOURCES)
    return [n for n in names if not wanted or any(w in n.lower() for w in wanted)]


def search_plan(variants: DataFrame, selection: str = "", skip_html: bool = False) -> DataFrame:
    """One row per (variant, enabled source) with the registry ordinal."""
    names = enabled_sources(selection, skip_html)
    ords = {n: i for i, n in enumerate(K.ALL_SOURCES)}
    srcs = F.array(*[F.struct(F.lit(ords[n]).alias("source_ord"), F.lit(n).alias("source")) for n in names])
    return variants.select("*", F.inline(srcs))
