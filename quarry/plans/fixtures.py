"""Parameters that fit the driver's invented-word corpus.

The reference lexicon's domain terms never occur in the generated
``documents`` text, so the catalog queries score with this lexicon (passed
as a parameter, exactly like a user-supplied lexicon) to exercise every
facet, the penalty terms and stems, and the dataset-hint rule.
"""

from ..functions.lexicon import Lexicon

# Test lexicon, facet by facet, in order.
CORPUS_LEXICON = Lexicon.of(
    geography=["was", "thanedble", "nicht", "para"],
    commodity=["the", "que", "of the"],
    measure=["from", "attion", "only", "rely", "and the"],
    penalty=["ertion", "retion"],
    penalty_stems=["thr"],
    dataset_hints=["by the", "the of"],
)

# The corpus lexicon's "country-level" geography terms (probes prefer the rest).
CORPUS_BROAD = ["was", "para"]
