"""Conversation structure repair (operator 11): a suffix-shared automaton of row signatures.

A row's signature is its role's initial (user, assistant, system, other) and its first fault. A
conversation is the string of its rows' signatures, and two conversations that end alike share the
automaton's nodes from there on: a node is a suffix of a signature string, minimised from the end.
For a node and a state of the grammar the cost-to-go and the best audit suffix don't depend on what
came before, so each is worked out once: the strings are sorted from their ends, over all
conversations, and one pass a partition holds the nodes of the present string only, keeping those it
shares with the next. A node stores its cost and the edit that begins its best audit suffix; edits
have different letters, so equal costs are settled by that letter.

Order and keys: rows of a conversation go by turn (nulls first), then role, then text. A null in
conv_id, turn, role or text reads as one space; all rows of a null ``conv_id`` are one conversation.
A role without characters has no legal initial. Defined cases: repeated rows are duplicates; a
conversation without rows after the damage gives zeros and empty strings; an empty table gives an
empty one; further columns are ignored. A conversation's signature (a byte a row) is one task's, its
texts stream by one at a time; duplicates are found by Spark's sort.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ASCII_SPACE, chunks, rows_of, small_batches, stored

#: Costs of the edits; a row's fault, 0 for none, in the order in which they count.
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3

# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_END = [(0, "", _START), (COST["I"] * 2, "I", _USER), (COST["I"], "I", _ASSISTANT), (0, "", _ASSISTANT)]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): rows dropped, emptied, unpunctuated, repeated or made the user's, by their crc32.

    A dropped row stays as ``live`` = false without a text, so that its conversation is still known.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("d"))
    d = F.col("d")
    text = F.when(d.isin(0, 1), F.lit("")).when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    again = F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", F.when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (d != 0).alias("live"), again).drop("copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id")


def signed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, live) with ``code`` = 4 x role class + fault; the rows of a conversation stay in one partition."""
    seen = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    said = F.rtrim("text", F.lit(ASCII_SPACE))
    fault = (F.when(said == "", F.lit(_BLANK)).when(F.row_number().over(seen) > 1, F.lit(_DUPLICATE))
             .when(~said.substr(-1, 1).isin(".", "!", "?"), F.lit(_TRUNCATED)).otherwise(F.lit(0)))
    initial = F.col("role").substr(1, 1)
    role = F.when(initial == "u", F.lit(0)).when(initial == "a", F.lit(1)).when(initial == "s", F.lit(2)).otherwise(F.lit(3))
    return _by_conversation(rows).withColumn("code", (role * 4 + fault).cast("int"))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) per conversation; the signature is written from its end."""
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    schema = pa.schema([("conv_id", pa.int64()), ("signature", pa.binary()), *((n, pa.int64()) for n in names[2:])])
    small_batches(rows.sparkSession)

    def run(batches):
        def finish(conv, codes, first, last, distinct):
            faults = [c & 3 for c in codes]
            roles = [c >> 2 for c in codes]
            legal = {(2, 0), (0, 1), (1, 0)}
            gaps = last - first + 1 - distinct if distinct else 0
            return (conv, bytes(codes[::-1]), gaps, *(faults.count(f) for f in (_BLANK, _DUPLICATE, _TRUNCATED)), sum(p not in legal for p in zip(roles, roles[1:])))

        def out():
            conv, codes, first, last, distinct = None, None, None, None, 0
            for c, turn, live, code in rows_of(batches, "conv_id", "turn", "live", "code"):
                if codes is None or c != conv:
                    if codes is not None:
                        yield finish(conv, codes, first, last, distinct)
                    conv, codes, first, last, distinct = c, bytearray(), None, None, 0
                if not live:
                    continue
                codes.append(code)
                if turn is not None and (distinct == 0 or turn != last):
                    first = turn if distinct == 0 else first
                    last = turn
                    distinct += 1
            if codes is not None:
                yield finish(conv, codes, first, last, distinct)

        yield from chunks(out(), schema, weight=lambda r: len(r[1]))

    repeated = F.col("code").bitwiseAND(3) == _DUPLICATE  # of equal rows of a turn, the one that isn't goes first
    ordered = signed(rows).sortWithinPartitions("conv_id", *_order(), repeated).select("conv_id", "turn", "live", "code")
    return ordered.mapInArrow(run, "conv_id long, signature binary, gaps long, blank long, duplicate long, truncated long, illegal long")


def node(code: int, following: list[tuple]) -> list[tuple]:
    """(cost-to-go, first edit, state after it) of each grammar state at a row, from those of the next node."""
    role, fault = code >> 2, code & 3
    extra = TRUNCATED_COST if fault == _TRUNCATED else 0
    best = []
    for state in range(4):
        ways = [(COST["D"] + following[state][0], "D", state)]
        if fault not in (_BLANK, _DUPLICATE):
            to = _NEXT[state]
            ways.append((COST["R"] + extra + following[to][0], "R", to))
            if role == to - _USER:
                ways.append((extra + following[to][0], "K", to))
            elif role == 2 and state == _START:
                ways.append((extra + following[_SYSTEM][0], "K", _SYSTEM))
        best.append(min(ways))
    # an inserted turn stays at the row: from a user's or an assistant's state once, then from the start's two
    user, assistant = best[_USER], best[_ASSISTANT]
    best[_USER] = min(user, (COST["I"] + assistant[0], "I", _ASSISTANT))
    best[_ASSISTANT] = min(assistant, (COST["I"] + user[0], "I", _USER))
    for state in (_START, _SYSTEM):
        best[state] = min(best[state], (COST["I"] + best[_USER][0], "I", _USER))
    return best


class Automaton:
    """The nodes of the present signature, from its end; those it shares with the next stay."""

    def __init__(self):
        self.path = b""
        self.nodes = [_END]
        self.audit = ""

    def repair(self, backward: bytes) -> tuple[int, str]:
        """Cost and audit of a signature written from its end; signatures come in ascending order."""
        if backward != self.path or len(self.nodes) == 1:
            shared = shared_length(self.path, backward)
            del self.nodes[shared + 1 :]
            for code in backward[shared:]:
                self.nodes.append(node(code, self.nodes[-1]))
            self.path = backward
            self.audit = self._walk()
        return self.nodes[-1][_START][0], self.audit

    def _walk(self) -> str:
        out, at, state = [], len(self.nodes) - 1, _START
        while edit := self.nodes[at][state][1]:
            out.append(edit)
            state = self.nodes[at][state][2]
            at -= edit != "I"
        return "".join(out)


def shared_length(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # a[:low] agrees, a[:high] doesn't
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def audits(signatures: DataFrame) -> DataFrame:
    """``signatures`` with ``cost`` and ``audit``; sorted from the ends of all conversations, so that nodes are shared."""
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    arrow = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in schema.split(", ")])

    def run(batches):
        automaton = Automaton()

        def out():
            for conv, signature, *counts in rows_of(batches, "conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"):
                cost, audit = automaton.repair(signature)
                yield conv, *counts, cost, audit

        yield from chunks(out(), arrow, weight=lambda r: len(r[-1]))

    return signatures.repartitionByRange("signature", "conv_id").sortWithinPartitions("signature", "conv_id").mapInArrow(run, schema)


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, ord, role, text) of the repaired conversations, in order, from the live rows and their audits."""
    schema = pa.schema([("conv_id", pa.int64()), ("ord", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return _with_audits(rows, audited, lambda conv, turns: ((conv, k, role, text) for k, (role, text) in enumerate(turns)),
                        "conv_id long, ord long, role string, text string", schema)


def digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired conversations, their texts streaming by."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def digest(conv, turns):
        sha = hashlib.sha256()
        for k, (role, text) in enumerate(turns):
            sha.update(f"{chr(10) if k else ''}{role}:{text}".encode())
        yield conv, sha.hexdigest()

    return _with_audits(rows, audited, digest, "conv_id long, repaired_sha256 string", schema)


def _with_audits(rows: DataFrame, audited: DataFrame, write, ddl: str, schema: pa.Schema) -> DataFrame:
    """``write(conv_id, turns)`` for each conversation: its audit comes first, its rows follow as they stream by."""
    small_batches(rows.sparkSession)
    heads = audited.select("conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    tails = rows.filter("live").select("conv_id", F.lit(True).alias("is_row"), "turn", "role", "text")

    def run(batches):
        stream = rows_of(batches, "conv_id", "is_row", "role", "text")
        yield from chunks((out for conv, audit, own in _conversations(stream) for out in write(conv, apply_audit(audit, own))), schema, weight=lambda r: sum(len(x) for x in r if isinstance(x, str)))

    ordered = _by_conversation(heads.unionByName(tails)).sortWithinPartitions("conv_id", "is_row", *_order())
    return ordered.mapInArrow(run, ddl)


def _conversations(stream):
    """(conv_id, audit, iterator of (role, text)) per conversation of a stream of heads and rows."""
    head = next(stream, None)
    while head is not None:
        following = [None]

        def own(following=following):
            for row in stream:
                if not row[1]:
                    following[0] = row
                    return
                yield row[2], row[3]

        turns = own()
        yield head[0], head[3], turns
        for _ in turns:  # rows that weren't read
            pass
        head = following[0]


def apply_audit(audit: str, turns):
    """(role, text) after the edits. Roles alternate; an odd number of turns begins with the system's, which was kept."""
    turns = iter(turns)
    system = (len(audit) - audit.count("D")) % 2
    placed = 0
    for edit in audit:
        if edit == "D":
            next(turns)
            continue
        role, text = ("", "") if edit == "I" else next(turns)
        if edit != "K":
            role = "assistant" if (placed - system) % 2 else "user"
        placed += 1
        yield role, text


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps, the faults after the damage, the cheapest repair's cost and audit, and its digest."""
    rows = damage(conversations)
    audited = stored(audits(stored(signatures(rows), "signatures")), "audits")
    out = audited.join(digests(rows, audited).withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return out.select(*columns, "repaired_sha256")
