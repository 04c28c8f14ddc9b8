"""Packing (operator 3): bounded-space online packing of token sequences.

Each partition keeps ``open_windows`` windows. A document's ids (its text's, then the end id) are cut
into full windows and a rest; the rest goes to the window it fits best. If it fits none, the fullest
window is topped up with the head of the rest and emitted, unless its gap is under ``min_piece``
ids, which are padded instead of cutting a crumb off. At the end the open windows of up to
``merge`` partitions meet, are packed again, and the last one is cut into powers of two, which need
no padding.

Tokens: a text's white-space chunks are tokenized on their own, as the tokenizer splits there anyway,
and remembered in a bounded cache, as most recur; so are the pieces of chunks in Latin letters.

Defined cases: a null text is empty and a document without ids still gets its end id; a null
``doc_id`` stays null and its document is packed; repeated rows are packed each on its own; ties go
to the window opened first; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches, stored

END_ID = 1
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECE_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _PIECE.split(", ")])
_PLACED = f"{_PIECE}, part int, ids binary"
_PLACED_ARROW = pa.schema([*_PIECE_ARROW, ("part", pa.int32()), ("ids", pa.binary())])
#: Sequence ids: partition or merge group, then a running number. Merge groups have the top bit.
_ROOM, _MERGED = 1 << 36, 1 << 62

#: Chunks of ASCII and Latin letters, and how the vocabulary's tokenizer splits them, lower-cased.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_CONTROLS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the tokenizer


@lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _le(ids) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Remembered(dict):
    """Key -> ``make(key)``; the two newest generations of ``size`` keys are kept."""

    def __init__(self, size: int, make):
        self.size, self.make = size, make
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        self[key] = value
        return value


class TokenBytes:
    """A text's ids as the tokenizer gives them, then the end id."""

    def __init__(self, path: str, size: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.pieces = Remembered(size, self.piece)
        self.chunks = Remembered(size, self.chunk)
        self.end = _le([END_ID])

    def whole(self, text: str) -> bytes:
        return _le(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        return _le([t.id for t in self.tokenize(piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode())))])

    def chunk(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk) or "<|" in chunk:
            return self.whole(chunk)
        return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(chunk.lower())))

    def __call__(self, text: str) -> bytes:
        if _CONTROLS.search(text):
            return self.whole(text) + self.end
        return b"".join(map(self.chunks.__getitem__, text.split())) + self.end


@lru_cache(maxsize=2)
def token_bytes(path: str, size: int) -> TokenBytes:
    """One per Python worker, as Spark reuses its workers."""
    return TokenBytes(path, size)


class Window:
    """An open sequence: its pieces (doc_id, start, doc_tokens, id bytes) and its fill in ids."""

    def __init__(self):
        self.pieces: list[tuple] = []
        self.fill = 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[3]) // 4


def cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    """A piece's first ``n`` ids and the rest."""
    doc, start, total, ids = piece
    return (doc, start, total, ids[: 4 * n]), (doc, start + n, total, ids[4 * n :])


def place(pieces, size: int, open_windows: int, min_piece: int):
    """Place pieces best-fit; yields emitted windows, at last ("open", windows)."""
    windows: list[Window] = []
    for piece in pieces:
        while len(piece[3]) >= 4 * size:
            full = Window()
            head, piece = cut(piece, size)
            full.add(head)
            yield full
        while n := len(piece[3]) // 4:
            best = min((w for w in windows if size - w.fill >= n), key=lambda w: size - w.fill, default=None)
            if best is None and len(windows) < open_windows:
                windows.append(best := Window())
            if best is not None:
                best.add(piece)
                if best.fill == size:
                    windows.remove(best)
                    yield best
                break
            fullest = max(windows, key=lambda w: w.fill)
            windows.remove(fullest)
            if size - fullest.fill >= min_piece:
                head, piece = cut(piece, size - fullest.fill)
                fullest.add(head)
            yield fullest
    yield "open", windows


def powers(window: Window):
    """A last window as sequences whose lengths are powers of two."""
    rest = list(window.pieces)
    left = window.fill
    while left:
        out = Window()
        want = 1 << (left.bit_length() - 1)
        left -= want
        while out.fill < want:
            piece = rest.pop(0)
            if out.fill + len(piece[3]) // 4 > want:
                piece, tail = cut(piece, want - out.fill)
                rest.insert(0, tail)
            out.add(piece)
        yield out


def _rows(window: Window, sequence: int):
    at = 0
    for doc, start, total, ids in window.pieces:
        yield doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, at
        at += len(ids) // 4


def place_partitions(docs: DataFrame, tokenizer_path: str, size: int, open_windows: int, min_piece: int, cached_chunks: int) -> DataFrame:
    """Emitted pieces; pieces of windows left open have ``part`` and ``ids``."""

    def run(batches):
        tokens = token_bytes(tokenizer_path, cached_chunks)
        part = TaskContext.get().partitionId()

        def pieces():
            for doc, text in rows_of(batches, "doc_id", "text"):
                ids = tokens(text or "")
                yield doc, 0, len(ids) // 4, ids

        def rows():
            n = 0
            for out in place(pieces(), size, open_windows, min_piece):
                if isinstance(out, tuple):
                    for w in out[1]:
                        for row, piece in zip(_rows(w, 0), w.pieces, strict=True):
                            yield *row, part, piece[3]
                    return
                for row in _rows(out, part * _ROOM + n):
                    yield *row, None, None
                n += 1

        yield from chunks(rows(), _PLACED_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PLACED)


def merge_left(left: DataFrame, size: int, min_piece: int, merge: int) -> DataFrame:
    """Pack the open windows of ``merge`` partitions together; a group's last window becomes powers of two.

    A group has at most ``merge`` * ``open_windows`` windows of ``size`` ids, whatever the input's size.
    """

    def run(key, table):
        group = key[0].as_py()

        def pieces():
            yield from sorted(rows_of([table], "doc_id", "start", "doc_tokens", "ids"), key=lambda r: (-len(r[3]), r[0] is None, r[0], r[1], r[3]))

        def emitted():
            for out in place(pieces(), size, 8, min_piece):
                if not isinstance(out, tuple):
                    yield out
                    continue
                last = Window()
                for w in sorted(out[1], key=lambda w: -w.fill):
                    for piece in w.pieces:
                        if last.fill + len(piece[3]) // 4 >= size:
                            head, piece = cut(piece, size - last.fill)
                            last.add(head)
                            yield last
                            last = Window()
                        if piece[3]:
                            last.add(piece)
                yield from powers(last)

        rows = (row for n, w in enumerate(emitted()) for row in _rows(w, _MERGED + group * _ROOM + n))
        return pa.Table.from_batches(chunks(rows, _PIECE_ARROW), schema=_PIECE_ARROW)

    grouped = left.withColumn("grp", F.expr(f"cast(floor(part / {merge}) as int)")).groupBy("grp")
    return grouped.applyInArrow(run, _PIECE)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, open_windows: int = 32, min_piece: int = 16, merge: int = 8, cached_chunks: int = 300_000) -> DataFrame:
    """A row per piece: which ids of which document stand where in which sequence."""
    small_batches(docs.sparkSession)
    placed = stored(place_partitions(docs, tokenizer_path, size, open_windows, min_piece, cached_chunks), "packed")
    done = placed.filter(F.col("part").isNull()).select(*_PIECE_ARROW.names)
    return done.unionByName(merge_left(placed.filter(F.col("part").isNotNull()), size, min_piece, merge))
