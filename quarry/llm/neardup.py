"""MinHash near-dedup (operator 8) with sequential Bayesian verification.

1. One pass makes each document's set of word shingles (64-bit hashes), a MinHash signature of it and
   a 128-bit fingerprint. Documents of one fingerprint form a class; one signature stands for it.
2. Signatures are cut into bands; classes that agree on a band share a bucket. Buckets with the same
   members count once.
3. Signatures are compared batch by batch; a pair is pruned as soon as its posterior chance of reaching
   the threshold falls under ``miss``. Only the members of surviving pairs are passed on, not the pairs.
   For those, the full sets are made from the texts and compared exactly; a task sees two tiles of a
   bucket at most and returns a spanning forest of the links it found, never all pairs of a group.
4. Step 3 runs twice: first each class meets the least class of its buckets, which joins most groups of
   copies; then, in buckets that hold several components, members of different ones meet.
5. Connected components of all links.

Defined cases: a null text or one without words has an empty set and stands alone; a text of fewer
words than a shingle has one shingle; a null ``doc_id`` stands alone with a null component and is
kept; repeated rows are copies of each other; rows that share a ``doc_id`` but differ in text link
what either links; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches, stored
from quarry.llm.components import components

_SKETCH = "doc_id long, n long, f1 long, f2 long, sig binary"
_SKETCH_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sig", pa.binary())])
HASHES = 140
#: Hashes compared before the posterior is looked at again.
BATCH = 20
#: Shingles that make a class count once more when tiles are filled, so that long texts make small tiles.
HEAVY = 1000
#: Remainders of hashed ids by which texts are filtered before they are shuffled.
FILTER = 1 << 20


class WordHashes(dict):
    """Word -> 64-bit hash, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; words are split at ASCII white space."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    if not len(h):
        return h
    size = min(size, len(h))
    run = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        run = _mix(run * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    run.sort()
    return run[np.r_[True, run[1:] != run[:-1]]]


class MinHash:
    """The least values of ``HASHES`` random functions over a set, 16 bits of each."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None] | np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]

    def __call__(self, run: np.ndarray) -> bytes:
        least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
        low = (run >> np.uint64(32)).astype(np.uint32) ^ run.astype(np.uint32)
        for at in range(0, len(low), 4096):  # bounded memory for very long texts
            x = low[None, at : at + 4096] * self.times
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x85EBCA6B)
            x += self.plus
            np.minimum(least, x.min(axis=1), out=least)
        least ^= least >> np.uint32(16)
        return least.astype("<u2").tobytes()


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """A row per document: set size, fingerprint, signature (null for an empty set)."""
    small_batches(docs.sparkSession)

    def run(batches):
        known, minhash = WordHashes(), MinHash()

        def rows():
            for doc, text in rows_of(batches, "doc_id", "text"):
                s = shingles(text, shingle, known)
                if len(s):
                    f1, f2 = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64).tolist()
                    yield doc, len(s), f1, f2, minhash(s)
                else:
                    yield doc, 0, None, None, None

        yield from chunks(rows(), _SKETCH_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SKETCH)


def band_rows(threshold: float, miss: float) -> int:
    """The longest bands that miss a pair at the threshold with a chance of ``miss`` at most."""
    return max((r for r in range(1, 17) if (1 - threshold**r) ** (HASHES // r) <= miss), default=1)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n hashes a pair with fewer than m equal ones is pruned.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), whose weight beyond t is
    the chance that a binomial of n + 1 draws at t is at most m.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        weight, m = 0.0, 0
        while m <= n and (weight := weight + comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)) < miss:
            m += 1
        out.append((n, m))
    return out


def _groups(batches, keys: tuple[str, ...], names: tuple[str, ...]):
    """Rows of one key after the other, from batches sorted by key; a group is bounded by its tiles."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if now is not None and tuple(key[a]) != now:
                yield now, held
                held = []
            now = tuple(key[a])
            held.append([batch.column(n).slice(a, b - a).to_pylist() for n in names])
    if now is not None:
        yield now, held


def _tile_pair(held) -> tuple[list, ...]:
    return tuple([x for part in held for x in part[k]] for k in range(len(held[0])))


def surviving(sig: np.ndarray, comp: np.ndarray, band: int, rows: int, bounds: list[tuple[int, int]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Members with a pair, one of ``left`` and one of ``right``, that no batch prunes.

    Pairs of one component are not looked at, and others in the first band on which they agree only.
    """
    alive = np.zeros(len(sig), dtype=bool)
    same = left is right
    for i, x in enumerate(left):
        others = right[i + 1 :] if same else right
        others = others[comp[others] != comp[x]]
        if not len(others):
            continue
        matches = np.zeros(len(others), dtype=np.int32)
        for n, least in bounds:
            matches += (sig[others, n - BATCH : n] == sig[x, n - BATCH : n]).sum(axis=1, dtype=np.int32)
            keep = matches >= least
            others, matches = others[keep], matches[keep]
            if not len(others):
                break
        if len(others) and band:
            agreed = (sig[others, : band * rows] == sig[x, : band * rows]).reshape(len(others), band, rows).all(axis=2).any(axis=1)
            others = others[~agreed]
        if len(others):
            alive[x] = True
            alive[others] = True
    return alive


def forest(ids: list[int], comp: list[int], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """Links (a, b) between ``left`` and ``right`` that join the components which such links join."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values = np.concatenate(sets)
    _, code = np.unique(values, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    group = np.array(comp)
    mark = np.zeros(int(code.max()) + 1, dtype=bool)
    same = left is right
    for i, x in enumerate(left):
        others = right[i + 1 :] if same else right
        others = others[group[others] != group[x]]
        if not len(others):
            continue
        own = code[starts[x] : starts[x] + sizes[x]]
        mark[own] = True
        lengths = sizes[others]
        heads = np.cumsum(lengths) - lengths
        at = np.repeat(starts[others] - heads, lengths) + np.arange(int(lengths.sum()))
        common = np.add.reduceat(mark[code[at]].astype(np.int64), heads)
        mark[own] = False
        for y in others[100 * common >= percent * (sizes[x] + lengths - common)]:
            if group[y] != group[x]:
                group[group == group[y]] = group[x]
                yield ids[x], ids[y]


def _sides(la, lb, side):
    every, side = np.arange(len(side)), np.array(side)
    if la == lb:
        return every, every
    return every[side == 0], every[side == 1]


def star_tiles(members: DataFrame, tile: int) -> DataFrame:
    """Each class against the least class of all its buckets: the leader meets its followers, a tile at a time."""
    heads = members.groupBy("key").agg(F.min("cls").alias("head"))
    first = members.select("key", "cls", "weight").join(heads, "key").groupBy("cls").agg(F.min("head").alias("head"), F.first("weight").alias("weight")).filter("cls <> head")
    sizes = first.groupBy("head").agg(F.expr(f"cast(ceil(sum(weight) / {tile}) as int)").alias("tiles"))
    follow = first.join(sizes, "head").select(F.col("head").alias("key"), F.expr("pmod(xxhash64(cls, 7), tiles)").alias("la"), F.lit(1).alias("side"), "cls")
    lead = sizes.select(F.col("head").alias("key"), F.explode(F.expr("sequence(0L, cast(tiles - 1 as bigint))")).alias("la"), F.lit(0).alias("side"), F.col("head").alias("cls"))
    both = lead.unionByName(follow)
    return both.select("key", F.lit(0).alias("band"), "la", F.lit(-1).cast("long").alias("lb"), "side", "cls", F.col("cls").alias("comp"))


def leaders(stars: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, leader): the leader's leader's leader of each class that is linked to its leader.

    Classes with one leader are connected; connected ones may still have two, which then meet once more.
    """
    up = stars.groupBy(F.greatest("a", "b").alias("node")).agg(F.min(F.least("a", "b")).alias("leader"))
    for _ in range(jumps):
        above = up.select(F.col("node").alias("leader"), F.col("leader").alias("above"))
        up = up.join(above, "leader", "left").select("node", F.coalesce("above", "leader").alias("leader"))
    return stored(up, "leaders")


def bucket_tiles(members: DataFrame, tile: int) -> DataFrame:
    """Pairs of tiles of the buckets that hold several components.

    A component with half a tile of members or more in a bucket has tiles of its own, which never meet
    each other: a large group of copies costs as much as the rest of its buckets is large.
    """
    comps = members.groupBy("key", "comp").agg(F.sum("weight").alias("n"))
    per = comps.groupBy("key").agg(F.count("*").alias("comps"), F.expr(f"sum(if(n < {tile // 2}, n, 0))").alias("mixed")).filter("comps > 1")
    own = comps.join(per, "key").withColumn("pure", F.expr(f"n >= {tile // 2}")).withColumn("tiles", F.expr(f"cast(ceil(if(pure, n, mixed) / {tile}) as int)"))
    placed = members.join(own.select("key", "comp", "pure", "tiles"), ["key", "comp"])
    label = F.expr("xxhash64(if(pure, comp, 0L), pure, pmod(xxhash64(cls, 7), tiles))")
    placed = stored(placed.select("key", "band", "cls", "comp", F.expr("if(pure, comp, null)").alias("pure"), label.alias("label")), "tiles")
    labels = placed.select("key", "label", "pure").distinct()
    other = labels.select("key", F.col("label").alias("lb"), F.col("pure").alias("pure_b"))
    pairs = labels.join(other, "key").filter("label <= lb and not (pure is not null and pure <=> pure_b)")
    sides = pairs.select("key", F.col("label").alias("la"), "lb", F.inline(F.expr("if(label = lb, array(named_struct('label', label, 'side', 0)), array(named_struct('label', label, 'side', 0), named_struct('label', lb, 'side', 1)))")))
    sides = sides.select("key", "la", "lb", F.col("label").alias("at"), "side")
    joined = sides.join(placed.withColumnRenamed("label", "at"), ["key", "at"])
    return joined.select("key", "band", "la", "lb", "side", "cls", "comp")


_TILED = "key long, la long, lb long, side int, cls long, comp long"
_TILED_ARROW = pa.schema([("key", pa.int64()), ("la", pa.int64()), ("lb", pa.int64()), ("side", pa.int32()), ("cls", pa.int64()), ("comp", pa.int64())])


def verified(tiles: DataFrame, docs: DataFrame, sigs: DataFrame, shingle: int, percent: int, miss: float) -> DataFrame:
    """Forests of links (a, b) between classes of different components, tile pair by tile pair."""
    rows, bounds = band_rows(percent / 100, miss), least_matches(percent / 100, miss)
    order = ["key", "la", "lb"]

    def prune(batches):
        def out():
            for (key, la, lb), held in _groups(batches, ("key", "la", "lb"), ("band", "side", "cls", "comp", "sig")):
                band, side, cls, comp, sig = _tile_pair(held)
                table = np.frombuffer(b"".join(sig), dtype="<u2").reshape(len(sig), HASHES)
                for k in np.flatnonzero(surviving(table, np.array(comp), band[0], rows, bounds, *_sides(la, lb, side))):
                    yield int(key), int(la), int(lb), side[k], cls[k], comp[k]

        yield from chunks(out(), _TILED_ARROW)

    dealt = tiles.join(sigs, "cls").repartition(*order).sortWithinPartitions(*order)
    survivors = stored(dealt.mapInArrow(prune, _TILED), "survivors")

    def exact(batches):
        known = WordHashes()

        def out():
            for (_, la, lb), held in _groups(batches, ("key", "la", "lb"), ("side", "cls", "comp", "text")):
                side, cls, comp, text = _tile_pair(held)
                yield from forest(cls, comp, [shingles(t, shingle, known) for t in text], *_sides(la, lb, side), percent)

        yield from chunks(out(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    wanted = survivors.select("cls").distinct()
    # texts that can't be wanted stay where they are: a broadcast of at most FILTER remainders
    remainder = lambda c: F.expr(f"pmod(xxhash64({c}), {FILTER})")
    maybe = F.broadcast(wanted.select(remainder("cls").alias("remainder")).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("cls"), "text").withColumn("remainder", remainder("cls")).join(maybe, "remainder", "left_semi").select("cls", "text")
    sets = survivors.join(texts, "cls").repartition(*order).sortWithinPartitions(*order)
    return stored(sets.mapInArrow(exact, "a long, b long"), "links")


def links(docs: DataFrame, reps: DataFrame, shingle: int, percent: int, miss: float, tile: int) -> DataFrame:
    """Links (a, b) between classes whose components are those of all links among candidates."""
    rows = band_rows(percent / 100, miss)
    keys = F.array(*(F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", 2 * b * rows + 1, 2 * rows)).alias("key")) for b in range(HASHES // rows)))
    posted = reps.select("cls", F.expr(f"cast(1 + n div {HEAVY} as int)").alias("weight"), F.inline(keys))
    shared = posted.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1").select("key")
    posted = stored(posted.join(shared, "key"), "posted")
    full = posted.groupBy("key").agg(F.count("*").alias("members"), F.min("band").alias("band"), F.min("cls").alias("low"), F.max("cls").alias("high"), F.bit_xor(F.xxhash64("cls")).alias("mark"))
    once = full.groupBy("members", "low", "high", "mark").agg(F.min(F.struct("band", "key")).alias("first")).select("first.band", "first.key")
    members = stored(posted.select("key", "cls", "weight").join(once, "key"), "buckets")
    sigs = reps.select("cls", "sig")
    first = verified(star_tiles(members, tile), docs, sigs, shingle, percent, miss)
    labelled = members.join(leaders(first), F.col("cls") == F.col("node"), "left").select("key", "band", "cls", "weight", F.coalesce("leader", "cls").alias("comp"))
    rest = verified(bucket_tiles(labelled, tile), docs, sigs, shingle, percent, miss)
    return first.unionByName(rest)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = 1e-7, tile: int = 512) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept, and its class (smallest exact copy)."""
    sk = stored(sketches(docs, shingle), "sketches")
    # equal sets have equal signatures: any row's will do
    reps = sk.filter("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("cls"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    reps = stored(reps, "classes")
    found = components(links(docs, reps, shingle, percent, miss, tile))
    labelled = reps.select("f1", "f2", "cls").join(found, F.col("cls") == F.col("node"), "left").select("f1", "f2", "cls", F.coalesce("component", "cls").alias("component"))
    rows = sk.select("doc_id", "n", "f1", "f2").join(labelled, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("cls", "doc_id").alias("class_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
