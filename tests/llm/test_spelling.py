"""Spelling variants against comparing all words, on small tables and damaged texts."""

import random
import re
import zlib
from collections import Counter

from conftest_llm import ASCII_LOWER, DOCS, docs, no_docs  # noqa: F401
from quarry.llm import variants


def words_of(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def collected(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_against_all_pairs(spark):
    """Few letters, so that runs are full and inserted letters repeat."""
    rng = random.Random(4)
    words = {}
    for _ in range(700):
        words["".join(rng.choices("abé", k=rng.randrange(1, 8)))] = rng.choice([5, 5, 6, 25, 30, 150, 4000])
    words |= {"$"[:0] + "a" * k: 5**k for k in range(1, 12)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    want = brute(words)
    assert collected(variants.group_variants(df)) == want
    assert len({r[2] for r in want if r[0] != r[2]}) > 3 and any(r[1] not in (None, r[2]) for r in want)


def test_texts(spark):
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéÿ×", k=rng.randrange(5, 12))) for _ in range(150)]
    rows = []
    for doc in range(400):
        own = rng.choices(base, weights=[1 / (k + 1) for k in range(len(base))], k=200)
        own = [w.upper() if rng.random() < 0.1 else w[: (k := rng.randrange(len(w)))] + rng.choice(["", "x"]) + w[k + 1 :] if rng.random() < 0.1 else w for w in own]
        rows.append((rng.choice([doc, doc, None, -doc]), rng.choice([" ", "\n", "1", "-"]).join(own)))
    rows += [(7, None), (8, ""), (9, "Grüße_Grüße") ] + [r[:2] for r in DOCS]
    df = spark.createDataFrame([(*r, 3, "y") for r in rows], "doc_id long, text string, n int, word string").repartition(4)
    want = brute(words_of(rows))
    assert len(want) > 150 and any(r[1] for r in want)
    assert collected(variants.spelling_variants(df)) == want


def test_empty_and_awkward(spark, docs, no_docs):
    assert collected(variants.spelling_variants(no_docs)) == []
    assert collected(variants.spelling_variants(docs)) == brute(words_of([r[:2] for r in DOCS]))


def test_runs_cross_batches(spark):
    """Runs of neighbours over many small Arrow batches."""
    words = {f"{a}{b}{c}{d}zz": 5 + k for k, (a, b, c, d) in enumerate((a, b, c, d) for a in "abc" for b in "abcd" for c in "abcde" for d in "abcdef")}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert collected(variants.group_variants(df)) == brute(words)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
