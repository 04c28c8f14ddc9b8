"""Approximate nearest neighbours (operator 2): a permutation index.

A vector is represented by its ``near`` nearest of ``pivots`` pivots, in order. Vectors are dealt to
shards by hash; a shard posts them in inverted files, one per pivot: which vectors have it, at which
place. A query adds up, over the files of its own nearest pivots, Spearman's footrule distance
(a vector missing from a file counts as if the pivot came last), the ``rerank`` share of a shard's
vectors that is most promising is scored exactly, and the best of all shards are merged.
Queries are met in blocks: every block joins every shard once.

Nearness is the largest inner product; pivots are ordered by inner product with the vector, which
is the order of distance for pivots of one length (they are normalised). So the footrule tells the
angle only, and lengths are taken exactly: a line fitted per shard turns footrules into cosines; the
``LEAST`` vectors of the largest cosine times length are scored, and with the score found last among
the ``k`` best, T, the others rank by how far their cosine is above what they need, T / (|x| |q|).
For vectors of one length that is the order of the footrule. Equal vectors of a shard are posted once
and stand for all their ids, smallest first.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part; vectors
are compared with those of as many components, for each number of which there is an index of its own;
a null ``vec_id`` takes no part; rows repeated with one ``vec_id`` and vector are one, and a ``vec_id``
with several vectors is one item, as near as its nearest pair; ties go to the smaller id; fewer candidates than ``k`` give
all; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import chunks, rows_of, small_batches, stored

PIVOTS, NEAR = 512, 48
#: Vectors of a shard, and queries of a block, on average.
SHARD, BLOCK = 16384, 2048
#: Vectors of a shard that are scored exactly at least.
LEAST = 256
#: Vectors of a shard that are compared with all others to fit cosines to footrules.
FITTED = 32
_SHARD = "shard int, ids array<array<long>>, vectors binary, file_ends binary, members binary, places binary"
_SHARD_ARROW = pa.schema([("shard", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))), ("vectors", pa.binary()), ("file_ends", pa.binary()), ("members", pa.binary()), ("places", pa.binary())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, in double precision."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.filter("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.coalesce(fine, F.lit(False)))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """``pivots`` different vectors, those with the least hashes, at length one."""
    some = vectors.groupBy("v").agg(F.min(F.xxhash64("vec_id")).alias("h")).orderBy("h").limit(pivots).collect()
    rows = [np.array(r["v"]) for r in some]
    table = np.stack(rows)
    return table / np.abs(table).max(axis=1, keepdims=True) / np.linalg.norm(table / np.abs(table).max(axis=1, keepdims=True), axis=1, keepdims=True)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """(vectors, near): the numbers of the nearest pivots, in order."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return np.argsort(-(scaled @ pivots.T), axis=1, kind="stable")[:, :near].astype(np.int16)


def build_index(vectors: DataFrame, pivots: np.ndarray, shards: int, near: int = NEAR) -> DataFrame:
    """A row per shard: its distinct vectors and the inverted file of each pivot."""
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(key, table):
        piv = sent.value
        by: dict[bytes, set] = {}
        for vec, v in rows_of([table], "vec_id", "v"):
            by.setdefault(np.array(v, dtype="<f8").tobytes(), set()).add(vec)
        rows = sorted((sorted(ids), v) for v, ids in by.items())
        x = np.frombuffer(b"".join(v for _, v in rows), "<f8").reshape(len(rows), -1)
        order = nearest_pivots(x, piv, near)
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        ends = np.cumsum(np.bincount(flat, minlength=len(piv)))
        members, places = by_pivot // order.shape[1], by_pivot % order.shape[1]
        row = (key[0].as_py(), [ids for ids, _ in rows], x.tobytes(), ends.astype("<i4").tobytes(), members.astype("<i4").tobytes(), places.astype("<i2").tobytes())
        return pa.Table.from_batches(chunks([row], _SHARD_ARROW), schema=_SHARD_ARROW)

    fit = vectors.withColumn("shard", F.expr(f"cast(pmod(xxhash64(vec_id), {shards}) as int)"))
    return fit.groupBy("shard").applyInArrow(run, _SHARD)


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths, also of vectors whose squares are out of range."""
    most = np.abs(x).max(axis=1)
    return most * np.linalg.norm(x / most[:, None], axis=1)


def cosine_line(x: np.ndarray, long: np.ndarray, saved: np.ndarray, own: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the cosines with vectors ``own`` over what their footrules save, (own, vectors)."""
    with np.errstate(over="ignore", invalid="ignore"):
        unit = x / long[:, None]
        cosines = unit[own] @ unit.T
    other = np.isfinite(cosines)
    other[np.arange(len(own)), own] = False
    s, c = saved[other].astype(float), cosines[other]
    spread = ((s - s.mean()) ** 2).sum() if len(s) else 0.0
    slope = ((s - s.mean()) * (c - c.mean())).sum() / spread if spread else 0.0
    if slope <= 0:  # too few or too like to tell: any line that rises with what is saved
        return 0.0, 1 / max(1, int(saved.max(initial=0)))
    return c.mean() - slope * s.mean(), slope


def search_shard(row: tuple, queries: list[tuple], pivots: np.ndarray, near: int, k: int, rerank: float):
    """(query_id, vec_id, score) of each query's best in one shard."""
    _, ids, vectors, ends, members, places = row
    x = np.frombuffer(vectors, "<f8").reshape(len(ids), -1)
    ends, members, places = np.frombuffer(ends, "<i4"), np.frombuffer(members, "<i4"), np.frombuffer(places, "<i2")
    firsts = np.r_[0, ends[:-1]]
    q = np.array([v for _, v in queries])
    every_id = [i for own in ids for i in own]
    repeated = len(set(every_id)) < len(every_id)  # an id with several vectors, all of them in this shard
    take = min(len(ids), max(LEAST, int(np.ceil(rerank * len(ids)))))

    def saved_by(order):
        saved = np.zeros(len(ids), dtype=np.int32)  # half of what the footrule is below that of lists without a common pivot
        for place, pivot in enumerate(order.tolist()):
            a, b = firsts[pivot], ends[pivot]
            saved[members[a:b]] += near - np.maximum(places[a:b], place)
        return saved

    if take < len(ids):
        long, long_q = lengths(x), lengths(q)
        own = np.linspace(0, len(ids) - 1, min(FITTED, len(ids))).astype(int)
        base, slope = cosine_line(x, long, np.stack([saved_by(o) for o in nearest_pivots(x[own], pivots, near)]), own)
    for at, ((query, _), v, order) in enumerate(zip(queries, q, nearest_pivots(q, pivots, near), strict=True)):
        some = np.arange(len(ids))
        if take < len(ids):
            cosine = base + slope * saved_by(order)
            some = np.argpartition(-(cosine * long), LEAST - 1)[:LEAST]
            last = min(k + 1, LEAST)  # the query itself may be one
            with np.errstate(over="ignore", invalid="ignore"):
                needed = np.partition(x[some] @ v, -last)[-last] / long_q[at] / long
            margin = np.where(np.isfinite(needed), cosine - needed, cosine)
            some = np.union1d(some, np.argpartition(-margin, take - 1)[:take])
        scores = x[some] @ v
        best = np.argpartition(-scores, k)[: k + 1] if k + 1 < len(some) and not repeated else np.arange(len(some))
        cut = scores[best].min()
        best = np.flatnonzero(scores >= cut)  # with all that tie with the last
        each = slice(None) if repeated else slice(k + 1)
        found = [(-float(x[some[b]] @ v), vec) for b in best for vec in ids[some[b]][each] if vec != query]
        own: dict[int, float] = {}
        for score, vec in sorted(found):
            if len(own) < k:
                own.setdefault(vec, -score)  # an id's nearest vector comes first
        for vec, score in own.items():
            yield query, vec, score


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, pivots: int = PIVOTS, near: int = NEAR, rerank: float = 0.2) -> DataFrame:
    """The contract's rows: for ids divisible by ``every``, the ``k`` nearest of all others found.

    ``rerank`` = 1.0 scores every vector: the exact answer.
    """
    spark = embeddings.sparkSession
    small_batches(spark)
    vectors = stored(usable(embeddings).dropDuplicates(["vec_id", "v"]), "vectors")
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    # a table has one number of components, or a few
    for r in vectors.groupBy(F.size("v").alias("n")).count().orderBy("n").collect():
        found = found.unionByName(_nearest_of(vectors.filter(F.size("v") == r["n"]), every, k, pivots, near, rerank))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # of ids with several vectors the nearest pair
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest_of(vectors: DataFrame, every: int, k: int, pivots: int, near: int, rerank: float) -> DataFrame:
    """(query_id, vec_id, score) of each shard's best among vectors of one number of components."""
    spark = vectors.sparkSession
    piv = choose_pivots(vectors, pivots)
    near = min(near, len(piv))
    queries = vectors.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    n, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // BLOCK))
    index = stored(build_index(vectors, piv, shards, near), "permutations")
    sent = spark.sparkContext.broadcast(piv)

    def run(key, left, right):
        block = list(rows_of([right], "query_id", "v"))
        rows = (hit for row in rows_of([left], *_SHARD_ARROW.names) for hit in search_shard(row, block, sent.value, near, k, rerank)) if block else ()
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        return pa.Table.from_batches(chunks(rows, schema), schema=schema)

    met = index.withColumn("block", F.explode(F.expr(f"sequence(0, {blocks - 1})")))
    asked = queries.withColumn("block", F.expr(f"cast(pmod(xxhash64(query_id, 3), {blocks}) as int)")).withColumn("shard", F.explode(F.expr(f"sequence(0, {shards - 1})")))
    return met.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score double")
