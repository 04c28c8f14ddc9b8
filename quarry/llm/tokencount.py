"""Token counts (operator 12): rank-synchronous array merging of byte-pair symbols.

The pre-tokens of a batch lie in one ragged numpy array of symbol ids. In a round every sequence
applies its own lowest-rank pair at all its places at once, left to right; sequences without a
mergeable pair leave the array, and what is left of a sequence is its token count. Sequences over
``LONG`` symbols keep their places by rank instead, so that a round costs what it merges.

White-space chunks recur, so each is counted once a batch and remembered in a bounded cache. Added
tokens inside a text count as one, as the library does by default.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; a null ``doc_id`` stays null;
repeated rows give a row each; an empty table gives an empty one; further columns are ignored; a
very long text is counted slice by slice, cut at white space. A vocabulary whose merges can't be
applied rank by rank, or one of another kind than BPE without unknown tokens, raises ValueError.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches

#: Symbols from which a sequence is merged on its own; no result depends on it.
LONG = 512
#: Characters of text that are split at once.
_SLICE = 1 << 21
_NONE = np.iinfo(np.int32).max

_CONTROLS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the tokenizers
_CHUNK = re.compile("[^ \t\n\x0b\x0c\r]+")
_SPACE = re.compile("[ \t\n\x0b\x0c\r]")


class Merges:
    """The merge table: pairs of symbol ids, their ranks and what they become."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.size = max(vocab.values(), default=0) + 1
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        rank = np.arange(len(pairs), dtype=np.int32)
        first = np.full(self.size, _NONE, np.int32)  # the lowest rank of a pair that holds a symbol
        np.minimum.at(first, left, rank)
        np.minimum.at(first, right, rank)
        if (first[made] <= rank).any():
            raise ValueError("a symbol's pairs come before it is made: merges can't be applied rank by rank")
        self.left, self.right, self.made = left.astype(np.int32), right.astype(np.int32), made
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], rank[order]
        letters = {c for c in vocab if len(c) == 1}
        self.inner = {c: vocab[c] for c in letters}
        self.last = {c: vocab[c + suffix] for c in letters if c + suffix in vocab}

    def symbols(self, piece: str) -> list[int]:
        ids = [self.inner[c] for c in piece]
        ids[-1] = self.last[piece[-1]]
        return ids

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE, np.int32)
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def alternate(follows: np.ndarray) -> np.ndarray:
    """Of places in order, ``follows`` where one overlaps the one before: keep every other of a run, from its first."""
    index = np.arange(len(follows))
    start = np.maximum.accumulate(np.where(follows, 0, index))
    return (index - start) % 2 == 0


def merged_counts(ids: np.ndarray, lengths: np.ndarray, merges: Merges) -> np.ndarray:
    """How many symbols of each sequence survive; sequences are ``lengths`` long, none empty."""
    out = np.zeros(len(lengths), np.int64)
    which = np.arange(len(lengths))  # the sequences still in the array
    while len(which):
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        rank = np.full(len(ids), _NONE, np.int32)
        rank[:-1] = merges.rank_of(ids[:-1], ids[1:])
        rank[starts[1:] - 1] = _NONE  # the last symbol of a sequence has no pair
        least = np.minimum.reduceat(rank, starts)
        going = least < _NONE
        out[which[~going]] = lengths[~going]
        stay = np.repeat(going, lengths)
        ids, rank, which, lengths, least = ids[stay], rank[stay], which[going], lengths[going], least[going]
        if not len(which):
            break
        seq = np.repeat(np.arange(len(which)), lengths)
        at = np.flatnonzero(rank == least[seq])
        at = at[alternate(np.concatenate(([False], at[1:] == at[:-1] + 1)))]
        ids[at] = merges.made[rank[at]]
        lengths = lengths - np.bincount(seq[at], minlength=len(which))
        ids = np.delete(ids, at + 1)
    return out


def merged_count(ids: np.ndarray, merges: Merges) -> int:
    """The same for one long sequence: the places of each rank are held apart, the lowest rank's merged together."""
    n = live = len(ids)
    ids = ids.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    gone = np.zeros(n, bool)
    places: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def add(at: np.ndarray) -> None:
        rank = merges.rank_of(ids[at], ids[after[at]])
        at, rank = at[rank < _NONE], rank[rank < _NONE]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for some, r in zip(np.split(at, cuts), rank[np.concatenate(([0], cuts))] if len(rank) else ()):
            if int(r) not in places:
                heapq.heappush(ranks, int(r))
            places.setdefault(int(r), []).append(some)

    add(np.arange(n - 1))
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(places.pop(r)))
        at = at[~gone[at] & (after[at] < n)]
        second = after[at]
        fits = (ids[at] == merges.left[r]) & (ids[second] == merges.right[r])
        at, second = at[fits], second[fits]
        kept = alternate(np.concatenate(([False], at[1:] == second[:-1]))) if len(at) else slice(0)
        at, second = at[kept], second[kept]
        ids[at] = merges.made[r]
        gone[second] = True
        live -= len(at)
        third = after[second]
        after[at] = third
        inside = third < n
        before[third[inside]] = at[inside]
        add(np.unique(np.concatenate((at[inside], before[at][before[at] >= 0]))))
    return live


class TokenCounter:
    """Counts the tokens of texts as the tokenizer in the file gives them."""

    def __init__(self, path: str, size: int):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            declared = json.load(f)
        model = declared["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd:
            raise ValueError(f"{path}: not a plain byte-pair vocabulary ({model.get('type')}, {odd})")
        added = declared["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens that depend on what is around them")
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else lambda s: s
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.size = size
        self.pieces: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        #: Whether white space only parts chunks, so that they can be counted one by one.
        self.by_chunk = self.pre_tokens(" a\tb\n\n c.\r\n") == ["a", "b", "c", "."]

    def pre_tokens(self, text: str) -> list[str]:
        return [piece for piece, _ in self.split(self.normalize(text))] if text else []

    def learn_new(self, pieces: set[str]) -> None:
        """Count the pieces not known yet, all in one ragged array but for the long ones."""
        if len(self.pieces) > self.size:
            self.pieces.clear()
        short = []
        for piece in pieces - self.pieces.keys():
            if len(piece) <= LONG:
                short.append(piece)
            else:
                self.pieces[piece] = merged_count(np.array(self.merges.symbols(piece), np.int32), self.merges)
        if short:
            rows = [self.merges.symbols(p) for p in short]
            lengths = np.fromiter(map(len, rows), np.int64, len(rows))
            ids = np.fromiter((i for row in rows for i in row), np.int32, int(lengths.sum()))
            self.pieces.update(zip(short, merged_counts(ids, lengths, self.merges).tolist(), strict=True))

    def count_units(self, units) -> dict[str, int]:
        """Unit (a chunk or a whole text) -> its tokens."""
        specials, parts = {}, {}
        for unit in units:
            runs = self.added.split(unit) if self.added else [unit]
            specials[unit] = len(runs) - 1
            parts[unit] = [p for run in runs for p in self.pre_tokens(run)]
        self.learn_new({p for own in parts.values() for p in own})
        found = self.pieces
        return {unit: specials[unit] + sum(map(found.__getitem__, own)) for unit, own in parts.items()}

    def count_chunks(self, units: list[str]) -> dict[str, int]:
        """The same for chunks between white space, normalised and parted in one run: their pieces are told apart by place."""
        line = " ".join(units)
        if not units or (self.added and self.added.search(line)):
            mixed = [u for u in units if self.added.search(u)]
            return self.count_units(mixed) | (self.count_chunks([u for u in units if not self.added.search(u)]) if mixed else {})
        shown = self.normalize(line)
        spaces = np.flatnonzero(np.frombuffer(shown.encode("utf-32-le"), np.uint32) == 32)
        if len(spaces) != len(units) - 1:  # other white space inside a chunk
            return self.count_units(units)
        parted = self.split(shown)
        pieces = [piece for piece, _ in parted]
        place = np.searchsorted(spaces, np.fromiter((at for _, (at, _) in parted), np.int64, len(parted)))
        self.learn_new(set(pieces))
        n = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        sums = np.concatenate(([0], np.cumsum(n)))
        ends = np.searchsorted(place, np.arange(len(units) + 1))
        return dict(zip(units, np.diff(sums[ends]).tolist(), strict=True))

    def slices(self, text: str):
        """Lists of a text's chunks, a bounded part of the text at a time."""
        at = 0
        while at < len(text):
            end = at + _SLICE
            if end < len(text):
                space = _SPACE.search(text, end)
                end = space.start() if space else len(text)
            part = text[at:end]
            yield _CHUNK.findall(part) if _CONTROLS.search(part) else part.split()
            at = end

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_chunk:
            return list(map(self.count_units(set(texts)).__getitem__, texts))
        totals = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        n = 0

        def settle() -> None:
            if len(self.chunks) > self.size:
                self.chunks.clear()
            self.chunks.update(self.count_chunks(list({c for _, own in held for c in own} - self.chunks.keys())))
            found = self.chunks
            for k, own in held:
                totals[k] += sum(map(found.__getitem__, own))
            held.clear()

        for k, text in enumerate(texts):
            for own in self.slices(text):
                held.append((k, own))
                n += len(own)
                if n >= 1 << 18:
                    settle()
                    n = 0
        settle()
        return totals


@lru_cache(maxsize=2)
def token_counter(path: str, size: int) -> TokenCounter:
    """One per Python worker, as Spark reuses its workers."""
    return TokenCounter(path, size)


def count_tokens(documents: DataFrame, path: str, limit: int = 2048, text: str = "text", key: str = "doc_id", remember: int = 1 << 18) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row; ``remember`` bounds each cache's entries before it is emptied."""
    small_batches(documents.sparkSession)
    kept = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        counter = token_counter(path, remember)

        def out():
            for batch in batches:
                rows = list(rows_of([batch], "doc_id", "n_bytes", "text"))
                for (doc, n_bytes, _), n in zip(rows, counter.counts([r[2] for r in rows]), strict=True):
                    yield doc, n_bytes, n

        yield from chunks(out(), pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]))

    sized = kept.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
