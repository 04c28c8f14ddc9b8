"""Discover plan: candidates -> F01 -> C11 -> F02-F04 -> W01 -> W02 -> T01.

Physical shape: scan + projection + score + gates fuse into one codegen
stage; keep-best is the only shuffle (partial aggregation map-side); rank
adds a range shuffle on the (small) survivor set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import constants as K
from ..functions.lexicon import Lexicon
from ..operators.discover import article_rows, keep_best, rank, with_dedupe_key
from ..operators.scoring import complete, gate, score_candidates
from ..sources.tables import documents_as_candidates


def discover(candidates: DataFrame, lexicon: Lexicon | None = None, min_score: int = K.MIN_SCORE,
             require_title_commodity: bool = K.REQUIRE_TITLE_COMMODITY,
             ranked: bool = True) -> DataFrame:
    """Candidates (M6 + ordinals) -> ranked, de-duplicated article index (M8)."""
    scored = score_candidates(complete(candidates), lexicon)
    gated = gate(scored, min_score, require_title_commodity)
    best = keep_best(with_dedupe_key(gated))
    rows = article_rows(best)
    return rank(rows) if ranked else rows


def discover_corpus(documents: DataFrame, lexicon: Lexicon | None = None, **kw) -> DataFrame:
    return discover(documents_as_candidates(documents), lexicon, **kw)
