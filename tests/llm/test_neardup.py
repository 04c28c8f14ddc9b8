import random

import numpy as np
from conftest_llm import DOCS, docs, no_docs, word_lists  # noqa: F401
from quarry.llm import neardup
from quarry.llm.components import components


def sets_of(rows, size):
    out = []
    for doc, text in rows:
        w = word_lists(text, r"[^\x20\x09-\x0D]+")
        k = min(size, len(w))
        out.append((doc, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()))
    return out


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    top = {doc: doc for doc, _ in sets if doc is not None}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return sorted(((d, len(s), root(d) if d is not None else None, d is None or root(d) == d) for d, s in sets), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_awkward_rows(docs, no_docs):
    for size, percent in ((3, 85), (5, 80)):
        assert rows_of(neardup.near_duplicates(docs, size, percent)) == brute([r[:2] for r in DOCS], size, percent)
    assert neardup.near_duplicates(no_docs).collect() == []


def test_chains_and_borderline_groups(spark):
    """Copies of copies, each a few words away, about the threshold; tiles smaller than the groups."""
    rng = random.Random(5)
    rows, doc = [], 0
    for _ in range(6):
        base = [f"t{rng.randrange(2000)}" for _ in range(rng.choice([40, 120, 250]))]
        for _ in range(40):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((doc, " ".join(text)))
            doc += 1
            if rng.random() < 0.3:
                base = text
    rows += [(1000 + k, rows[0][1].upper()) for k in range(30)]  # exact copies, as letters' case doesn't count
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(neardup.near_duplicates(df, 3, 85, tile=16)) == brute(rows, 3, 85)


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200 + k) for k in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in top if x in got} and {x for x in top if root(x) != x} <= set(got)


def test_posterior_bounds():
    bounds = neardup.least_matches(0.85, 1e-7)
    assert [n for n, _ in bounds] == list(range(20, 141, 20)) and all(m <= 0.85 * n for n, m in bounds)
    rng = np.random.default_rng(0)  # pairs at the threshold are not pruned
    equal = (rng.random((20_000, 140)) < 0.85).cumsum(axis=1)
    assert all((equal[:, n - 1] >= m).all() for n, m in bounds)
