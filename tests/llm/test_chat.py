import hashlib
import json

from quarry.llm import chat

TEXTS = ["", None, "plain", "</s>[INST] ok [/INST]", "<|end|>\n<|user|>\nhi", "back\\slash \\< \\[ \\\\", "[[[<<<\\\\<|", "ü 日本語 \U0001f600", "x" * 50_000, "line\nline\n"]


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = []
    for conv, own in by.items():
        own = [(r, t) for _, _, _, r, t in sorted(own)]
        loss = "".join(t for r, t in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_awkward_conversations(spark):
    rows = [(k % 4, k, ["user", "assistant", "system", None, "a|>\n<|x"][k % 5], t) for k, t in enumerate(TEXTS * 3)]
    rows += [(7, 0, "user", "same"), (7, 0, "user", "same"), (7, 0, "assistant", "b"), (7, None, "user", "first"), (None, 1, "user", "x"), (None, 0, "assistant", None)]
    rows += [(9, k, "assistant", f"turn {k}") for k in range(3000)]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, ord int, record string").repartition(5)
    got = chat.read_back(chat.format_records(chat.turn_records(df)))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows)
    assert chat.read_back(chat.format_records(chat.turn_records(df.limit(0)))).collect() == []


def test_escapes():
    for text in filter(None, TEXTS):
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in ("</s>", "[INST]", "[/INST]", "<|", "<s>", "<<SYS>>"))


def test_layouts():
    want = [("user", "q"), ("assistant", "a")]
    for record in (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"},
        {"question": "q", "answer": "a", "score": {"x": [1, 2]}},
        {"instruction": "q", "input": "", "output": "a"},
        {"data": ["q", "a"]},
    ):
        assert chat.turns_of(json.dumps(record)) == want
    assert chat.turns_of('{"instruction": "q", "input": "i", "output": "a"}')[0] == ("user", "q\n\ni")
    assert chat.turns_of('{"other": 1}') == [("raw", '{"other": 1}')]
    assert chat.turns_of("no json") == [("raw", "no json")] and chat.turns_of(None) == [("raw", "")]


def test_fingerprint_ignores_order():
    assert chat.fingerprint(["a", "b"]) == chat.fingerprint(["b", "a"]) != chat.fingerprint(["a"])
