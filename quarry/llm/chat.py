"""Chat formatting (operator 5) by schema fingerprints.

A record is JSON of any layout. The paths of its nested fields, as far as some layout names them, are
hashed; the fingerprint selects a declarative mapping, which makes canonical turns (role, text).
The template marks turns and escapes control strings inside texts: every backslash is doubled and a
backslash follows every ``<`` and ``[``, with which all control strings begin, so that none survives
and unescaping is exact.

Conversations are dealt by id, sorted by turn, and streamed a turn at a time, so that a long one
takes no more memory than its longest turn; its digests are sequential by nature.

Defined cases: a null text is empty and a null role has no name; a record of an unknown layout (an empty array of messages is none), or of more nested values than Python reads, becomes one turn of
role ``raw`` with the record as its text; turns with one number are ordered by
role and text, a null number first; rows with a null ``conv_id`` form one conversation; repeated
rows are turns each; an empty table gives an empty one; further columns and fields are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches

#: Roles under other names in layouts that use ``from``.
_ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant"}

#: Layouts. Each mapping lists, in order, (role or path of the role, paths of the texts to join);
#: a path through ``[]`` makes a turn per element, ``[]*`` makes alternating user and assistant turns.
LAYOUTS: list[tuple[tuple[str, ...], list[tuple[str, list[str]]]]] = [
    (("role", "text"), [("$role", ["text"])]),
    (("role", "content"), [("$role", ["content"])]),
    (("from", "value"), [("$from", ["value"])]),
    (("messages[].role", "messages[].content"), [("$messages[].role", ["messages[].content"])]),
    (("messages[].role", "messages[].text"), [("$messages[].role", ["messages[].text"])]),
    (("conversations[].from", "conversations[].value"), [("$conversations[].from", ["conversations[].value"])]),
    (("system", "conversations[].from", "conversations[].value"), [("system", ["system"]), ("$conversations[].from", ["conversations[].value"])]),
    (("prompt", "completion"), [("user", ["prompt"]), ("assistant", ["completion"])]),
    (("prompt", "response"), [("user", ["prompt"]), ("assistant", ["response"])]),
    (("system", "prompt", "response"), [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]),
    (("question", "answer"), [("user", ["question"]), ("assistant", ["answer"])]),
    (("instruction", "output"), [("user", ["instruction"]), ("assistant", ["output"])]),
    (("instruction", "response"), [("user", ["instruction"]), ("assistant", ["response"])]),
    (("instruction", "input", "output"), [("user", ["instruction", "input"]), ("assistant", ["output"])]),
    (("system", "instruction", "input", "output"), [("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])]),
    (("data[]",), [("*", ["data[]*"])]),
]


def fingerprint(paths) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths)))


MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS}
_KNOWN = {p for paths, _ in LAYOUTS for p in paths}


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; array elements are ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"} if not value or not isinstance(value[0], (dict, list)) else set(), *(field_paths(v, f"{at}[]") for v in value if isinstance(v, (dict, list))))
    return {at}


def _at(value, path: str):
    for key in filter(None, path.split(".")):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: str | None) -> list[tuple[str, str]]:
    """Canonical turns of one JSON record; one of no known layout, or nested too deep to read, is a raw turn."""
    try:
        return _known_turns(record or "")
    except (ValueError, RecursionError):
        return [("raw", record or "")]


def _known_turns(record: str) -> list[tuple[str, str]]:
    value = json.loads(record)
    mapping = MAPPINGS.get(fingerprint(field_paths(value) & _KNOWN)) if isinstance(value, dict) else None
    if mapping is None:
        raise ValueError("unknown layout")
    out: list[tuple[str, str]] = []
    for role, texts in mapping:
        if role == "*":
            out += [(("user", "assistant")[k % 2], _text(x)) for k, x in enumerate(_at(value, texts[0].removesuffix("[]*")) or [])]
        elif role.startswith("$") and "[]." in role:
            array, _, name = role[1:].partition("[].")
            for x in _at(value, array) or []:
                r = _text(_at(x, name))
                out.append((_ALIASES.get(r, r) if name == "from" else r, _text(_at(x, texts[0].partition("[].")[2]))))
        elif role.startswith("$"):
            r = _text(_at(value, role[1:]))
            out.append((_ALIASES.get(r, r) if role == "$from" else r, _text(_at(value, texts[0]))))
        else:
            text = "\n\n".join(t for t in (_text(_at(value, p)) for p in texts) if t)
            if text or role != "system":
                out.append((role, text))
    return out


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template; where its text begins and ends."""
    head = f"<|{escape(role).replace('|', '|' + chr(92))}|>\n"
    body = escape(text)
    return f"{head}{body}<|end|>\n", len(head), len(head) + len(body)


_TURN = re.compile(r"<\|((?:[^|]|\|\\)*)\|>\n([^<]*(?:<\\[^<]*)*)<\|end\|>\n")
_PIECE = "conv_id long, formatted string, loss_from int, loss_to int"


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, ord, record) -> a row per turn: its formatted text and, for assistants, the span of
    it under the loss mask. Rows of a conversation stand together, in order."""
    small_batches(records.sparkSession)

    def run(batches):
        def out():
            for conv, record in rows_of(batches, "conv_id", "record"):
                for role, text in turns_of(record):
                    piece, a, b = formatted_turn(role, text)
                    yield conv, piece, a if role == "assistant" else None, b if role == "assistant" else None

        yield from chunks(out(), pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_from", pa.int32()), ("loss_to", pa.int32())]), weight=lambda r: len(r[1]))

    dealt = records.select(F.col("conv_id").cast("long").alias("conv_id"), "ord", "record").repartition("conv_id").sortWithinPartitions("conv_id", "ord", "record")
    return dealt.mapInArrow(run, _PIECE)


class _Read:
    """What is read back from one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss_from, loss_to) -> None:
        self.chars += len(piece)
        at = 0
        while at < len(piece):
            turn = _TURN.match(piece, at)
            if turn is None:
                raise ValueError(f"conversation {self.conv}: no turn at {at}")
            self.turns += 1
            self.all.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            at = turn.end()
        if loss_from is not None:
            text = unescape(piece[loss_from:loss_to])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations, parsed from ``format_records``' output as it streams by."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        def out():
            now = None
            for conv, piece, a, b in rows_of(batches, "conv_id", "formatted", "loss_from", "loss_to"):
                if now is None or now.conv != conv:
                    if now is not None:
                        yield now.row()
                    now = _Read(conv)
                now.feed(piece, a, b)
            if now is not None:
                yield now.row()

        yield from chunks(out(), pa.schema(list(zip(names, types, strict=True))))

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn as records; order: turn, role, text."""
    record = F.to_json(F.struct("role", F.coalesce("text", F.lit("")).alias("text")), {"ignoreNullFields": "false"})
    return conversations.select("conv_id", F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("ord"), record.alias("record"))
