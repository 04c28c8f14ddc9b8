import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from conftest_llm import DOCS, docs, no_docs  # noqa: F401
from quarry.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, tokenizer=Tokenizer.from_file(PATH)):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, pieces, size=2048):
    """Each id in exactly one piece, pieces gapless in their sequences; returns the padding's share."""
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append(p)
    padding = total = 0
    for own in seqs.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *(p.length for p in own[:-1])]))
        fill = sum(p.length for p in own)
        assert 0 < fill <= size and all(p.length > 0 for p in own)
        total += fill
        padding += 0 if fill & (fill - 1) == 0 else size - fill
    want = sorted((doc, len(ids_of(text))) for doc, text in rows if doc is not None)
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.doc_id] += p.length
    totals = defaultdict(int)
    for doc, n in want:
        totals[doc] += n
    assert {k: v for k, v in tokens.items() if k is not None} == totals
    ids = {doc: ids_of(text) for doc, text in rows}
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(np.array(own[p.start : p.start + p.length], dtype="<u4").tobytes())
    return padding / max(1, total)


def test_awkward_rows(docs, no_docs):
    check([r[:2] for r in DOCS], packing.pack(docs, PATH).collect())
    assert packing.pack(no_docs, PATH).collect() == []


def test_little_padding(spark):
    rows = [(k, " ".join(f"word{k * j % 101}" for j in range(k * 37 % 900))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert check(rows, packing.pack(df, PATH).collect()) < 0.01
    assert check(rows, packing.pack(df, PATH, open_windows=2, merge=2).collect()) < 0.02


def test_tokens_are_the_tokenizers(spark):
    tokens = packing.TokenBytes(PATH, 50)  # small, so that keys are forgotten
    for text in [DOCS[9][1], "İstanbul ΑΣ ς a<|startoftext|>b I'LL we're\x1c ok ½ ² x²y e\u0301 \u00e9 ﬁ 'S it''s 12ab\xa0z q\x85w ÷×µª", "'", "", *(f"w{k}, Ab{k}." for k in range(300))]:
        assert np.frombuffer(tokens(text), "<u4").tolist() == ids_of(text)
