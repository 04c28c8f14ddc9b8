"""Conversation repair against a search over all edit sequences, cheapest first."""

import hashlib
import heapq
import random
import re
import zlib

from quarry.llm import dawg

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        own += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by Dijkstra's search over (row, roles' state), ordered by cost and audit."""
    heap, best = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, at, roles, said = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in said)
        ends = roles[-1:] if roles != "s" else "S"
        # two ways to one place: the dearer can't win, and of equal costs the audits' order decides only at a difference
        if best.get((at, ends), cost) < cost or len(roles) > 2 * len(rows) + 3:
            continue
        best[at, ends] = cost
        for r in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", roles + r[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", at, roles + r[0], (*said, (r, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, said))
            if fault not in (1, 2):
                extra = int(fault == 3)
                if role and re.fullmatch("s?(ua)*u?", roles + role[0]):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, roles + role[0], (*said, (role, text))))
                for r in ("user", "assistant"):
                    if re.fullmatch("s?(ua)*u?", roles + r[0]):
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, roles + r[0], (*said, (r, text))))


def brute(rows):
    out = []
    for conv, own in damaged(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.rstrip(WS)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        legal = {"su", "ua", "au"}
        illegal = sum(a[1][:1] + b[1][:1] not in legal for a, b in zip(own, own[1:]))
        cost, audit, said = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


def repaired(df):
    got = dawg.repair(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_random_conversations(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ux"]
    texts = ["Hello there.", "what?", "cut off", "", " \t\n", "done!\x0b\r", "a\xa0", None, "Hello there.", "x. y"]
    rows = []
    for conv in [None, -4, *range(220)]:
        for k in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([k, k, k, None, 3 * k, 0, -k]), rng.choice(roles), rng.choice(texts)))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cost int, signature string").repartition(5)
    assert repaired(df) == brute(rows)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert repaired(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_empty_and_dropped(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)) == []
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert repaired(spark.createDataFrame([(7, gone, "user", "a.")], SCHEMA)) == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_one_long_conversation(spark):
    """A hot conversation: its audit is as long as it, and nothing grows with its square."""
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k}." if k % 5 else "") for k in range(20_000)]
    got = repaired(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert len(got) == 1
    live = damaged(rows)[1]
    audit = got[0][7]
    assert len(audit) - audit.count("I") == len(live)
    kept = list(dawg.apply_audit(audit, [(r, t) for _, r, t in sorted(live)]))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))
    assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest() == got[0][8]


def test_nodes_are_shared():
    automaton, made = dawg.Automaton(), []
    plain = dawg.node
    dawg.node = lambda *a: made.append(1) or plain(*a)
    try:
        for signature in sorted([bytes([4, 0] * k) for k in range(1, 30)] + [bytes([4, 0, 4, 0, 8])] * 5):
            automaton.repair(signature)
    finally:
        dawg.node = plain
    assert len(made) <= 58 + 2


def test_repaired_rows(spark):
    rows = [(5, 1, "user", "q?"), (5, 2, "assistant", "a."), (5, 3, "assistant", "more."), (6, 1, "assistant", "alone.")]
    df = dawg.damage(spark.createDataFrame(rows, SCHEMA)).filter("conv_id < 0").unionByName(
        spark.createDataFrame([(*r, True) for r in rows], SCHEMA + ", live boolean"))
    audited = dawg.audits(dawg.signatures(df))
    got = sorted((r.conv_id, r.ord, r.role, r.text) for r in dawg.repaired(df, audited).collect())
    assert got == [(5, 0, "user", "q?"), (5, 1, "assistant", "a."), (5, 2, "user", ""), (5, 3, "assistant", "more."), (6, 0, "user", ""), (6, 1, "assistant", "alone.")]
