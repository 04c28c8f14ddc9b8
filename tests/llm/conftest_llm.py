"""Awkward small tables and brute-force readings of the contracts."""

import re

import pytest

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "", 0),
    (5, " \n\t\r\n", "en", "a", 3),
    (6, "one", "en", "a", 3),
    (7, "one two", "en", "a", 3),
    (8, LONG, "en", "b", 1),
    (9, LONG + " tail", "en", "b", 1),
    (10, "ÄÖ ünïcödé ÉCOLE 日本語 don't <|endoftext|> x² \x1c ctrl", "fr", "c", 1),
    (10, "ÄÖ ünïcödé ÉCOLE 日本語 don't <|endoftext|> x² \x1c ctrl", "fr", "c", 1),
    (None, "a text whose id is null stands alone whatever it says here today", "en", None, 1),
    (-5, "A TEXT whose id is null stands alone whatever it says here today", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word_lists(text, pattern):
    return re.findall(pattern, (text or "").translate(ASCII_LOWER))


@pytest.fixture
def docs(spark):
    """With two more columns, whose names clash with what operators add."""
    rows = [(*r, 7, "x") for r in DOCS]
    return spark.createDataFrame(rows, SCHEMA + ", score int, n_lines string").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
