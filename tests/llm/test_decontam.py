import hashlib
import random

from conftest_llm import DOCS, docs, no_docs, word_lists  # noqa: F401
from quarry.llm import decontam
from quarry.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = word_lists(text, WORD)
        if item is not None and w:
            k = min(size, len(w))
            for i in range(len(w) - k + 1):
                windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = word_lists(text, WORD), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ITEMS = [(1, "quick brown fox jumps over the lazy dog near the old river"), (2, "ONE"), (3, ""), (None, "one two"), (4, None), (10, "École 日本語"), (10, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15")]


def test_awkward_rows(spark, docs, no_docs):
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, doc_id int")
    assert rows_of(decontam.decontaminate(docs, items)) == brute([r[:2] for r in DOCS], ITEMS)
    assert decontam.decontaminate(no_docs, items).collect() == []
    none = decontam.decontaminate(docs, items.limit(0))
    assert rows_of(none) == brute([r[:2] for r in DOCS], [])


def test_against_brute_force_in_blocks(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(12)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(0, 300)))) for k in range(120)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 14)))) for k in range(30)]
    items += [(100 + k, " ".join(rows[k][1].split()[5:25])) for k in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert rows_of(decontam.decontaminate(df, bench)) == want
    index = stored(decontam.build_index(df, segment_bytes=3000), "test")
    found = decontam.search(index, bench, block_words=60)
    assert sorted((r.doc_id, r.n_words, r.n_hit, len(r.items)) for r in found.collect()) == [w[:4] for w in sorted(want)]


def test_proximity(spark):
    df = spark.createDataFrame([(1, "alpha beta x y gamma"), (2, "gamma x alpha beta"), (3, "alpha z z z z z z z beta gamma"), (4, "alpha beta"), (5, "gamma")], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    found = decontam.search(decontam.build_index(df), bench, near=4).collect()
    assert {r.doc_id: (r.items, r.near_items) for r in found} == {1: ([], ["7"]), 2: ([], ["7"]), 3: ([], []), 4: ([], []), 5: ([], [])}


def test_clean_documents_keeps_the_others(spark, docs):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old river")], "item_id long, text string")
    left = decontam.clean_documents(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in DOCS if r[0] not in (1, 2))
