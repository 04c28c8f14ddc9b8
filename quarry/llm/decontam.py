"""Benchmark decontamination (operator 1): a distributed positional inverted index.

``build_index`` makes one row per segment of documents: its terms (sorted 64-bit hashes) and, term by
term, the positions where they stand in the segment. Positions run on through a segment with one free
place between documents, so that no run of positions crosses two. ``search`` takes the test items in
blocks of bounded size against every segment: for each window of test words the rarest term's list
is taken first and the other terms' lists, moved by their offsets, are intersected with it, from rare
to common. Phrase matches have all words in order; proximity matches have every word of the window
within ``near`` words of the rarest one.

Defined cases: a null text has no words; a null ``doc_id`` stays null and is judged all the same;
items without words or with a null ``item_id`` match nothing; items that share an ``item_id`` count
once; repeated documents are judged each on its own; empty tables give clean or no rows; further
columns are ignored. Terms are compared by 64-bit hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches, stored

#: Bytes to themselves, A-Z lower-cased, all that is no word byte to a space.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())

_SEGMENT = "segment long, doc_ids array<long>, crcs array<long>, starts binary, terms binary, list_ends binary, steps binary"
_SEGMENT_ARROW = pa.schema([("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("crcs", pa.list_(pa.int64())), ("starts", pa.binary()), ("terms", pa.binary()), ("list_ends", pa.binary()), ("steps", pa.binary())])
_HIT = "segment long, row int, doc_id long, text_crc long, n_words long, items array<string>, near_items array<string>, spans array<struct<s:int,e:int>>"
_HIT_ARROW = pa.schema([("segment", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("text_crc", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))])


def words(text: str | None) -> list[bytes]:
    """Words as bytes: a-z, 0-9 and everything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Terms(dict):
    """Word -> running number in a segment."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _segment(number: int, docs: list, segment_terms: _Terms, ids: list[np.ndarray]) -> tuple:
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    starts = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=starts[1:])
    term = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    place = np.arange(len(term)) + np.repeat(np.arange(len(ids)), sizes)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, segment_terms), dtype=np.uint64, count=len(segment_terms))
    order = np.argsort(hashes)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    keys = rank[term] << 32 | place if len(term) else np.zeros(0, np.int64)
    keys.sort()
    ends = np.cumsum(np.bincount(keys >> 32, minlength=len(order)))
    places = (keys & 0xFFFFFFFF).astype(np.int32)
    steps = np.diff(places, prepend=np.int32(0))  # lists hold steps, which compress well
    firsts = np.r_[0, ends[:-1]] if len(ends) else np.zeros(0, np.int64)
    steps[firsts] = places[firsts]
    return number, [d for d, _ in docs], [c for _, c in docs], starts.astype("<i4").tobytes(), hashes[order].astype("<u8").tobytes(), ends.astype("<i4").tobytes(), steps.astype("<i4").tobytes()


def build_index(docs: DataFrame, segment_bytes: int = 6 << 20) -> DataFrame:
    """A row per segment of about ``segment_bytes`` of text (a longer document has one of its own)."""
    small_batches(docs.sparkSession)

    def run(batches):
        part = TaskContext.get().partitionId()

        def rows():
            n, size, docs_, terms, ids = 0, 0, [], _Terms(), []
            for doc, text in rows_of(batches, "doc_id", "text"):
                w = words(text)
                ids.append(np.fromiter(map(terms.__getitem__, w), dtype=np.int64, count=len(w)))
                docs_.append((doc, zlib.crc32((text or "").encode())))
                size += len(text or "")
                if size >= segment_bytes:
                    yield _segment(part << 32 | n, docs_, terms, ids)
                    n, size, docs_, terms, ids = n + 1, 0, [], _Terms(), []
            if docs_:
                yield _segment(part << 32 | n, docs_, terms, ids)

        yield from chunks(rows(), _SEGMENT_ARROW, size=1)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SEGMENT)


class Postings:
    """A segment's lists, as one sorted array of term << 32 | position."""

    def __init__(self, starts, terms, list_ends, steps):
        self.starts = np.frombuffer(starts, "<i4").astype(np.int64)
        self.terms = np.frombuffer(terms, "<u8")
        self.ends = np.frombuffer(list_ends, "<i4").astype(np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        run = np.cumsum(np.frombuffer(steps, "<i4"), dtype=np.int64)
        before = np.repeat(np.r_[0, run[self.ends[:-1] - 1]] if len(self.ends) else np.zeros(0, np.int64), self.sizes)
        self.keys = np.repeat(np.arange(len(self.ends)), self.sizes) << 32 | (run - before)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash's term here, or -1."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = term << 32 | np.maximum(place, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (place >= 0)

    def near(self, term: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
        """Whether the term stands within ``most`` places of ``place``."""
        key = term << 32 | place
        at = np.searchsorted(self.keys, key)
        after = self.keys[np.minimum(at, len(self.keys) - 1)]
        before = self.keys[np.maximum(at - 1, 0)]
        return ((after >= key) & (after - key <= most)) | ((before <= key) & (key - before <= most))


def windows_of(items: list[tuple[str, np.ndarray]], size: int):
    """By length: (item number of each window, hashes of its words); short items are one window."""
    by: dict[int, tuple[list, list]] = {}
    for n, (_, hashes) in enumerate(items):
        if len(hashes):
            own = np.lib.stride_tricks.sliding_window_view(hashes, min(size, len(hashes)))
            to = by.setdefault(own.shape[1], ([], []))
            to[0].append(np.full(len(own), n))
            to[1].append(own)
    return {k: (np.concatenate(a), np.concatenate(b)) for k, (a, b) in by.items()}


def match(postings: Postings, item_of: np.ndarray, hashes: np.ndarray, near: int | None, most: int = 1 << 20):
    """Yields (item numbers, phrase starts, None) and (item numbers, None, places of proximity)."""
    if not len(postings.keys):
        return
    term = postings.find(hashes)
    alive = (term >= 0).all(axis=1)
    item_of, term = item_of[alive], term[alive]
    by_size = np.argsort(postings.sizes[term], axis=1, kind="stable")  # rarest first
    first = np.take_along_axis(term, by_size[:, :1], axis=1)[:, 0] if len(term) else np.zeros(0, np.int64)
    todo = postings.sizes[first]
    at = 0
    while at < len(term):  # some windows at a time, so that their lists stay small
        upto = max(at + 1, int(np.searchsorted(np.cumsum(todo[at:]), most)) + at)
        counts = todo[at:upto]
        window = np.repeat(np.arange(at, upto), counts)
        begins = np.repeat(postings.ends[first[at:upto]] - counts, counts)
        within = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = postings.keys[begins + within] & 0xFFFFFFFF
        left, start = window, place - by_size[window, 0]
        for k in range(1, term.shape[1]):
            offset = by_size[left, k]
            keep = postings.has(term[left, offset], start + offset)
            left, start = left[keep], start[keep]
        yield item_of[left], start, None
        if near is not None:
            for k in range(1, term.shape[1]):
                keep = postings.near(term[window, by_size[window, k]], place, near)
                window, place = window[keep], place[keep]
            for k in range(1, term.shape[1]):  # in the same document: checked on the survivors
                keep = _same_document(postings, term[window, by_size[window, k]], place, near)
                window, place = window[keep], place[keep]
            yield item_of[window], None, place
        at = upto


def _same_document(postings: Postings, term: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    doc = np.searchsorted(postings.starts, place, side="right") - 1
    low = np.maximum(place - most, postings.starts[doc])
    high = np.minimum(place + most, postings.starts[doc + 1] - 2)
    return np.searchsorted(postings.keys, term << 32 | low) < np.searchsorted(postings.keys, term << 32 | high, side="right")


def merged_spans(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Half-open spans, joined where they touch or overlap."""
    order = np.argsort(start, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(start[order].tolist(), (start + length)[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _search_segment(row: tuple, items, windows, near, all_rows: bool):
    segment, doc_ids, crcs, starts, *lists = row
    postings = Postings(starts, *lists)
    hits = [[], [], []]  # document, item, start and length
    close = [[], []]
    for length, (item_of, hashes) in windows.items():
        for item, start, place in match(postings, item_of, hashes, near):
            if start is not None:
                hits[0].append(np.searchsorted(postings.starts, start, side="right") - 1)
                hits[1].append(item)
                hits[2].append(np.stack([start, np.full(len(start), length)], axis=1))
            else:
                close[0].append(np.searchsorted(postings.starts, place, side="right") - 1)
                close[1].append(item)
    doc, item, span = (np.concatenate(x) if x else np.zeros((0, 2) if k == 2 else 0, np.int64) for k, x in enumerate(hits))
    near_doc, near_item = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in close)
    order, near_order = np.argsort(doc, kind="stable"), np.argsort(near_doc, kind="stable")
    doc, item, span, near_doc, near_item = doc[order], item[order], span[order], near_doc[near_order], near_item[near_order]
    n_words = np.diff(postings.starts) - 1
    name = lambda numbers: [items[k][0] for k in np.unique(numbers)]
    for k in range(len(doc_ids)) if all_rows else np.union1d(doc, near_doc).tolist():
        own, near_own = (slice(*np.searchsorted(x, [k, k + 1])) for x in (doc, near_doc))
        spans = merged_spans(span[own, 0] - postings.starts[k], span[own, 1])
        yield segment, k, doc_ids[k], crcs[k], int(n_words[k]), name(item[own]), name(near_item[near_own]), [{"s": s, "e": e} for s, e in spans]


def item_blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """Items with hashed words, in as many blocks as keep one at about ``block_words`` words."""

    def run(batches):
        def rows():
            for item, text in rows_of(batches, "item_id", "text"):
                if item is not None and (w := words(text)):
                    yield item, len(w), np.array([xxhash.xxh3_64_intdigest(x) for x in w], dtype="<u8").tobytes()

        yield from chunks(rows(), pa.schema([("item", pa.string()), ("n", pa.int64()), ("hashes", pa.binary())]))

    items = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(run, "item string, n long, hashes binary"), "items")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = max(1, -(-total // block_words))
    return [items.filter(F.expr(f"pmod(xxhash64(item), {n}) = {k}")).select("item", "hashes") for k in range(n)]


def search(index: DataFrame, benchmark: DataFrame, window: int = 10, near: int | None = None, block_words: int = 1 << 20) -> DataFrame:
    """A row per document: n_words, the items with phrase matches, the matched spans of words, and
    the items with proximity matches (none unless ``near`` is given).

    A block of items, at most about ``block_words`` words, goes to every task. Where there are several,
    they follow each other, each a scan of the index whose hits are written before the next block is read:
    the driver and the executors hold one block at a time.
    """
    spark = index.sparkSession

    def searched(block: DataFrame, all_rows: bool):
        sent = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in block.collect()])

        def run(batches):
            items = [(i, np.frombuffer(h, "<u8")) for i, h in sent.value]
            windows = windows_of(items, window)
            rows = (hit for row in rows_of(batches, *_SEGMENT_ARROW.names) for hit in _search_segment(row, items, windows, near, all_rows))
            yield from chunks(rows, _HIT_ARROW)

        return index.mapInArrow(run, _HIT), sent

    found = None
    blocks = item_blocks(benchmark, block_words)
    for k, block in enumerate(blocks):
        part, sent = searched(block, k == 0)
        if len(blocks) > 1:
            part = stored(part, "hits")
            sent.destroy()  # what was written is never computed again
        found = part if found is None else found.unionByName(part)
    names = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    by_row = found.groupBy("segment", "row").agg(F.max("doc_id").alias("doc_id"), F.max("text_crc").alias("text_crc"), F.max("n_words").alias("n_words"), names("items").alias("items"), names("near_items").alias("near_items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    # spans of several blocks may overlap: count each word once
    covered = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")), lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).alias("n"), F.greatest(a["to"], x["e"]).alias("to")), lambda a: a["n"])
    return by_row.select("doc_id", "text_crc", "n_words", covered.alias("n_hit"), "items", "near_items", "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, near: int | None = None) -> DataFrame:
    """The contract's columns per document, from the written index."""
    found = search(stored(build_index(docs), "postings"), benchmark, window, near)
    items = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without a phrase match; columns as they are."""
    hit = search(stored(build_index(docs), "postings"), benchmark, window).filter(F.col("n_hit") > 0)
    hit = hit.select(F.col("doc_id").alias("__hit"), F.col("text_crc").alias("__crc")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__hit"]) & (F.crc32(docs["text"]) == hit["__crc"]), "left_anti")
