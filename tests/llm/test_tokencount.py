"""Token counts against the library, whole tables and awkward strings."""

import random

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import DOCS, docs, no_docs  # noqa: F401
from quarry.llm import tokencount
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def counted(df, path=WORDS, **more):
    return sorted((tuple(r) for r in tokencount.count_tokens(df, path, **more).collect()), key=str)


def brute(rows, path=WORDS):
    tokenizer = Tokenizer.from_file(path)
    n = [len(e.ids) for e in tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    return sorted(((d, len((t or "").encode()), k, k > 2048) for (d, t), k in zip(rows, n)), key=str)


def test_awkward_rows(spark, docs, no_docs):
    for path in (WORDS, BYTES):
        assert counted(docs, path) == brute([r[:2] for r in DOCS], path)
    assert counted(no_docs) == []


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert counted(df) == brute([(r.doc_id, r.text) for r in df.collect()])


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_strings(path):
    rng = random.Random(1)
    letters = "aabbc éÀßİKſΣ’'s'll<|endoftext|>_日本́̀  \x1c\x85　ﬁ½²12 \t\n\U0001F600‍Iǅ"
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(5000)]
    texts += ["<|endoftext|> a<|endoftext|>b <|startoftext|>", "<|endof", "a" * 3000, "ab" * 4000, "é" * 2001, "hello " * 50]
    texts += ["".join(rng.choices(some, k=20_000)) for some in ("acgt", "abcdefghijklmnopqrstuvwxyz", "ab")]
    counter = tokencount.TokenCounter(path, 1 << 12)
    tokenizer = Tokenizer.from_file(path)
    assert counter.counts(texts) == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_slices_and_small_caches(monkeypatch):
    monkeypatch.setattr(tokencount, "_SLICE", 100)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdé'", k=rng.randrange(1, 9))) for _ in range(500)) + "\x1c" * (k % 2) for k in range(10)]
    counter = tokencount.TokenCounter(WORDS, 20)
    tokenizer = Tokenizer.from_file(WORDS)
    assert counter.counts(texts) == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_both_merging_ways_agree():
    """The ragged rounds and the long sequence's places by rank, against the textbook loop."""
    merges = [["a", "b"], ["b", "a"], ["a", "a"], ["ab", "ab"], ["aa", "aa"], ["ba", "ab"], ["abab", "c"], ["c", "c"]]
    vocab = {s: k for k, s in enumerate(["a", "b", "c", *("".join(m) for m in merges)])}
    table = tokencount.Merges(vocab, merges, "")
    rng = random.Random(3)
    words = ["".join(rng.choices("abc" if k % 3 else "a", k=rng.randrange(1, 30))) for k in range(600)]

    def plain(word):
        own = list(word)
        while True:
            ranks = [merges.index([x, y]) for x, y in zip(own, own[1:]) if [x, y] in merges]
            if not ranks:
                return len(own)
            x, y = merges[min(ranks)]
            k = next(k for k in range(len(own)) if own[k : k + 2] == [x, y])
            own[k : k + 2] = [x + y]

    ids = [np.array(table.symbols(w), np.int32) for w in words]
    want = [plain(w) for w in words]
    assert tokencount.merged_counts(np.concatenate(ids), np.array(list(map(len, words))), table).tolist() == want
    assert [tokencount.merged_count(i, table) for i in ids] == want


def test_foreign_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):  # c's pair comes before c is made
        tokencount.Merges({"a": 0, "b": 1, "ab": 2, "abb": 3}, [["ab", "b"], ["a", "b"]], "")
    text = open(WORDS, encoding="utf-8").read().replace('"byte_fallback":false', '"byte_fallback":true').replace('"byte_fallback": false', '"byte_fallback": true')
    (tmp_path / "odd.json").write_text(text, encoding="utf-8")
    with pytest.raises(ValueError):
        tokencount.TokenCounter(str(tmp_path / "odd.json"), 10)
