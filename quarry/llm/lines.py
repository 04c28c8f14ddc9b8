"""Line dedup (operator 4).

Line hashes are range-partitioned with a secondary sort by document and position. Each partition is
streamed once: the first occurrence of a key (its largest document, as documents are sorted
descending) stays, the others go if enough documents hold the key. A key that touches a partition's
edge is settled from one summary row per edge. The result is a compressed bitmap per document, not
text; ``apply_bitmaps`` turns texts and bitmaps into the kept texts.

Defined cases: a null or empty text is one empty line and loses nothing; a null ``doc_id`` takes no
part and keeps all its lines; rows repeated with one ``doc_id`` count as one document, and rows that
share a ``doc_id`` but differ in text keep separate bitmaps (``text_crc``); a key on several lines of
the keeping document keeps them all; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import ASCII_SPACE, chunks, rows_of, small_batches, stored

_LINE = "h1 long, h2 long, doc_id long, text_crc long, pos int"
_LINE_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("text_crc", pa.int64()), ("pos", pa.int32())])
_FOUND = "kind int, h1 long, h2 long, doc_id long, text_crc long, pos int, n_docs long"
_FOUND_ARROW = pa.schema([("kind", pa.int32()), *_LINE_ARROW, ("n_docs", pa.int64())])
#: A line that goes; a line of an edge key, still open; a summary of an edge key (doc_id: its largest).
DROP, OPEN, EDGE = 0, 1, 2


def line_key(line: str) -> bytes:
    """The line without ASCII white space at both ends, A-Z lower-cased (bytes.lower is ASCII only)."""
    return line.strip(ASCII_SPACE).encode().lower()


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per line whose key has ``min_chars`` code points: 128-bit hash, document, position."""

    def run(batches):
        for batch in batches:
            digests, ids, crcs, places = [], [], [], []
            for doc, text in rows_of([batch], "doc_id", "text"):
                if doc is None or not text:
                    continue
                crc = zlib.crc32(text.encode())
                for pos, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(line.strip(ASCII_SPACE)) >= min_chars:
                        digests.append(xxhash.xxh3_128_digest(line_key(line)))
                        ids.append(doc)
                        crcs.append(crc)
                        places.append(pos)
            h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), pa.array(ids, pa.int64()), pa.array(crcs, pa.int64()), pa.array(places, pa.int32())], schema=_LINE_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _LINE)


class _Key:
    """The key whose lines are being streamed: distinct documents so far and its undecided lines."""

    def __init__(self, h1, h2, top, first):
        self.h1, self.h2, self.top, self.first = h1, h2, top, first
        self.n_docs, self.last_doc, self.held = 0, None, []


def _found(kind, h1, h2, doc, crc, pos, n_docs):
    n = len(doc)
    full = lambda v, t: pa.array(np.full(n, v, dtype=t))
    return pa.RecordBatch.from_arrays([full(kind, np.int32), full(h1, np.int64), full(h2, np.int64), pa.array(doc), pa.array(crc), pa.array(pos), full(n_docs, np.int64)], schema=_FOUND_ARROW)


def stream_keys(batches, min_docs: int):
    """Lines to drop from one sorted partition; what its first and last key need from neighbours.

    A key that begins here has its largest document here, so once ``min_docs`` documents are seen its
    later lines go at once; at most the lines of ``min_docs`` - 1 documents are held.
    """
    now: _Key | None = None

    def feed(doc, crc, pos):
        """Lines of the current key, in order."""
        new = np.empty(len(doc), dtype=bool)
        new[0] = doc[0] != now.last_doc
        new[1:] = doc[1:] != doc[:-1]
        now.n_docs += int(new.sum())
        now.last_doc = doc[-1]
        if now.first:
            yield _found(OPEN, now.h1, now.h2, doc, crc, pos, 0)
            return
        now.held.append((doc, crc, pos))
        if now.n_docs >= min_docs:
            for d, c, p in now.held:
                if (go := d != now.top).any():
                    yield _found(DROP, now.h1, now.h2, d[go], c[go], p[go], 0)
            now.held = []

    def close(at_end):
        if now.first or at_end:
            yield _found(EDGE, now.h1, now.h2, np.array([now.top]), np.zeros(1, np.int64), np.zeros(1, np.int32), now.n_docs)
            for d, c, p in now.held:
                yield _found(OPEN, now.h1, now.h2, d, c, p, 0)

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, crc, pos = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("h1", "h2", "doc_id", "text_crc", "pos"))
        key_start = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        key_end = np.r_[key_start[1:], len(h1)]
        if now is not None and (now.h1, now.h2) != (h1[0], h2[0]):
            yield from close(False)
            now = _Key(h1[0], h2[0], doc[0], False)
        elif now is None:
            now = _Key(h1[0], h2[0], doc[0], True)
        yield from feed(doc[: key_end[0]], crc[: key_end[0]], pos[: key_end[0]])
        if len(key_start) == 1:
            continue
        yield from close(False)
        a, b = key_start[1], key_start[-1]  # keys that begin and end inside this batch
        if b > a:
            new = np.r_[True, (doc[a + 1 : b] != doc[a : b - 1])]
            starts, sizes = key_start[1:-1] - a, key_end[1:-1] - key_start[1:-1]
            new[starts] = True
            docs_of = np.repeat(np.add.reduceat(new.astype(np.int64), starts), sizes)
            top_of = np.repeat(doc[key_start[1:-1]], sizes)
            if (go := (docs_of >= min_docs) & (doc[a:b] != top_of)).any():
                yield _found(DROP, 0, 0, doc[a:b][go], crc[a:b][go], pos[a:b][go], 0)
        now = _Key(h1[b], h2[b], doc[b], False)
        yield from feed(doc[b:], crc[b:], pos[b:])
    if now is not None:
        yield from close(True)


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_crc, pos) of every line that goes."""
    spark = docs.sparkSession
    small_batches(spark)
    lines = stored(line_hashes(docs, min_chars), "line-hashes")  # small rows, so that sampling for ranges is cheap
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_crc", "pos")
    found = stored(ranged.mapInArrow(lambda it: stream_keys(it, min_docs), _FOUND), "line-found")
    edges = found.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.sum("n_docs").alias("docs"), F.max("doc_id").alias("top")).filter(F.col("docs") >= min_docs)
    late = found.filter(F.col("kind") == OPEN).select("h1", "h2", "doc_id", "text_crc", "pos").join(F.broadcast(edges), ["h1", "h2"])  # at most two rows a partition
    late = late.filter(F.col("doc_id") != F.col("top"))
    sure = found.filter(F.col("kind") == DROP)
    return sure.select("doc_id", "text_crc", "pos").unionByName(late.select("doc_id", "text_crc", "pos"))


def pack_bitmap(dropped: list[int]) -> bytes:
    """Keep bits up to the last dropped line, compressed; lines beyond are kept."""
    keep = np.ones((max(dropped) // 8 + 1) * 8, dtype=np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def kept_lines(lines: list[str], bitmap: bytes | None) -> list[str]:
    if bitmap is None:
        return lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
    return [x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_crc, keep): the compressed bitmap of each document that loses a line."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text_crc", pa.int64()), ("keep", pa.binary())])
        yield from chunks(((d, c, pack_bitmap(p)) for d, c, p in rows_of(batches, "doc_id", "text_crc", "pos")), schema)

    gone = dropped_lines(docs, min_chars, min_docs).groupBy("doc_id", "text_crc").agg(F.collect_set("pos").alias("pos"))
    return gone.mapInArrow(run, "doc_id long, text_crc long, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """All columns of ``docs``, then ``n_lines``, ``n_dropped`` and ``kept_text`` (replacing namesakes)."""
    added = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])
    own = [n for n in docs.columns if n not in {*added.names, "__doc", "__crc", "__keep"}]
    docs = docs.select(*(F.col(f"`{n}`") for n in own))
    # the bitmaps are the built side: texts are neither sorted nor spilled for the join
    side = bitmaps.select(F.col("doc_id").alias("__doc"), F.col("text_crc").alias("__crc"), F.col("keep").alias("__keep")).hint("shuffle_hash")
    joined = docs.join(side, (docs["doc_id"].cast("long") == side["__doc"]) & (F.crc32(docs["text"]) == side["__crc"]), "left").drop("__doc", "__crc")
    names = [*own, *added.names]

    def run(batches):
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, keep in rows_of([batch], "text", "__keep"):
                lines = (text or "").split("\n")
                left = kept_lines(lines, keep)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append("\n".join(left))
            columns = [batch.column(n) for n in own] + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Each document's line counts and the digest of its kept lines."""
    kept = apply_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs, min_chars, min_docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
