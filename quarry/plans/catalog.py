"""Query catalog: one entry per operator, each over the whole driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (DuckDB
SQL over the same tables) are exported through ``__spark_entry__``.
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all():
    from . import (q_articles, q_discover, q_extract, q_io, q_lexicon, q_normalise, q_pages, q_records, q_records_plan, q_scalars,  # noqa: F401
                   q_search)
