"""Each stage's decisions against brute force on its own input; all ids packed at the end."""

import corpus_pipeline
from quarry.llm.common import stored
from test_decontam import brute as hits
from test_lines import brute as line_counts
from test_neardup import brute as groups
from test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        seen[name] = len(before), len(after)
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in after}
            assert all((d in kept) == (q == 1) for d, q in quality.items() if d in dict(before))
        elif name == "line_dedup":
            want = {r[0]: r[1] - r[2] for r in line_counts(before)}
            assert {r.doc_id: r.text.count("\n") + 1 if want[r.doc_id] else 0 for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "near_dedup":
            assert {r.doc_id for r in after} == {r[0] for r in groups(before, 5, 80) if r[3]}
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert {r.doc_id for r in after} == {r[0] for r in hits(before, bench) if not r[5]}
        else:
            assert check(before, after) < 0.01
    assert seen["line_dedup"][0] == seen["line_dedup"][1] and seen["near_dedup"][0] > seen["near_dedup"][1]


def test_copies_that_share_an_id(spark):
    """Of identical rows one stays; a text beside a copy under one doc_id is judged by itself."""
    words = lambda seed, n=120: " ".join(f"w{seed}x{k * 7919 % 1013}" for k in range(n))
    a, b, c, d = words(1), words(2), words(3), words(4)
    texts = [(1, a), (2, a + " end"), (3, b), (3, a + " tail"), (4, c), (4, c), (5, c), (6, d), (6, a), (7, d + " end"), (8, None), (8, None), (9, b + " x"), (9, b + " y"), (None, a), (None, a), (10, "one more " + words(5))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.drop_copies(spark, docs, SF)
    assert got.columns == docs.columns
    want = [(1, a), (3, b), (4, c), (6, d), (8, None), (None, a), (None, a), texts[-1]]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
