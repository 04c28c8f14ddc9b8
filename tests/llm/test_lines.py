import hashlib
import random

from conftest_llm import DOCS, docs, no_docs  # noqa: F401
from quarry.llm import lines

WS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda x: low(x.strip(WS))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if doc is None or len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_awkward_rows(spark, docs, no_docs):
    assert rows_of(lines.line_dedup(docs)) == brute([r[:2] for r in DOCS])
    assert lines.line_dedup(no_docs).collect() == []


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"line {k} " + "Äbc " * 12 + str(k) for k in range(40)] + ["short", "", "x" * 39, "y" * 40, "  " + "Z" * 40 + "\t"]
    rows = [(rng.choice([k, k, k % 7]), "\n".join(rng.choices(pool, k=rng.randrange(0, 30)))) for k in range(300)]
    rows += [(1000 + k, "hot line that a third of all documents hold, all of it the same") for k in range(150)]
    rows += [(5, None), (None, pool[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert rows_of(lines.line_dedup(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_key_over_batches(spark):
    """One key in every document, streamed in small batches and over many ranges."""
    rows = [(k, "the same long line again and again, in every single document") for k in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.line_dedup(df).filter("n_dropped = 0").collect()
    assert [r.doc_id for r in got] == [4999]


def test_bitmap_round_trip():
    for gone in ([0], [3], [7], [8], [0, 1, 2, 19], list(range(100))):
        own = [str(k) for k in range(120)]
        assert lines.kept_lines(own, lines.pack_bitmap(gone)) == [x for k, x in enumerate(own) if k not in gone]


def test_columns_and_clashes(docs):
    out = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    assert sorted(out.columns) == sorted([*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_dropped", "kept_text"])
    assert out.count() == len(DOCS)
