"""Tables in the folder that driver and executors share, and row numbers after a global sort."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a local session gets a temporary folder, and a cluster an error,
    as executors wouldn't see each other's files."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="quarry-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, outlives lost executors.

    The shuffle files of the write go when it ends, as nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered_table(df: DataFrame, by: list[tuple[Column, bool]], name: str) -> DataFrame:
    """As ``numbered``, for tables that are written anyway: sorted and written once, each row with its place in its part.

    The keys are computed and compared by the sort alone; numbers are those places plus the rows of the parts before.
    """
    placed = stored(df.orderBy(*[c.desc() if down else c.asc() for c, down in by]).withColumn("_nb_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_nb_at", 33)  # how the function counts: parts above 33 bits of places
    counts = placed.groupBy(part.alias("_nb_part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_nb_part", (F.sum("n").over(Window.orderBy("_nb_part")) - F.col("n")).alias("_nb_before"))  # a row a part
    found = placed.withColumn("_nb_part", part).join(F.broadcast(before), "_nb_part")
    return found.withColumn(name, F.col("_nb_before") + F.col("_nb_at").bitwiseAND((1 << 33) - 1)).drop("_nb_part", "_nb_at", "_nb_before")


def _sorts_before(a: Column, b: Column, down: list[bool]) -> Column:
    """Whether key ``a`` comes before key ``b``: fields in turn, nulls first in ascending and last in descending fields."""
    before = F.lit(False)
    for k in reversed(range(len(down))):
        x, y = (b[f"k{k}"], a[f"k{k}"]) if down[k] else (a[f"k{k}"], b[f"k{k}"])
        less = F.coalesce(x < y, x.isNull() & y.isNotNull())
        before = less | (x.eqNullSafe(y) & before)
    return before


def numbered(df: DataFrame, by: list[tuple[Column, bool]], name: str) -> DataFrame:
    """``df`` with ``name`` = 0, 1, ... in the global order of ``by``: pairs (key, descending).

    One plan, of which nothing runs before the caller's action. Hashes of the keys choose a sample of bounded
    size (the least hash of each of 16 cells a bucket, an aggregate combined map-side), whose quantiles are the
    bounds of four buckets or more per shuffle partition; a row finds its bucket by bisection. A row's number is its place
    in its bucket plus the rows of the buckets before. No task holds all rows, and bounds, counts and rows agree
    however often the input is computed, as long as the input itself is the same each time. Rows equal in all
    keys get neighbouring numbers, in any order. Keys must be hashable (no maps).
    """
    spark = df.sparkSession
    steps = 2 + (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    down = [d for _, d in by]
    keyed = df.withColumn("_nb_key", F.struct(*[c.alias(f"k{i}") for i, (c, _) in enumerate(by)]))
    key, hashed = F.col("_nb_key"), F.xxhash64("_nb_key")
    order = [key[f"k{i}"].desc() if d else key[f"k{i}"].asc() for i, d in enumerate(down)]
    cells = keyed.groupBy(F.shiftrightunsigned(hashed, 60 - steps).alias("cell")).agg(F.min_by(key, hashed).alias("_nb_key"))
    place = F.row_number().over(Window.orderBy(*order))  # of at most 16 cells a bucket
    every = cells.select(key, place.alias("n")).filter((F.col("n") % 16 == 0) & (F.col("n") < 16 << steps))
    bounds = every.agg(F.array_sort(F.collect_list(F.struct("n", key))).getField("_nb_key")).scalar()

    def step(low: Column, half: Column) -> Column:
        bound = F.array(F.get(F.col("_nb_bounds"), low + half - 1))  # taken once a step
        return low + F.transform(bound, lambda b: F.when(b.isNotNull() & _sorts_before(b, key, down), half).otherwise(F.lit(0)))[0]

    bucket = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(steps))]), F.lit(0), step)
    placed = keyed.withColumn("_nb_bounds", bounds).withColumn("_nb_part", bucket).drop("_nb_bounds")
    counts = placed.groupBy("_nb_part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_nb_part", (F.sum("n").over(Window.orderBy("_nb_part")) - F.col("n")).alias("_nb_before"))
    inside = placed.withColumn("_nb_in", F.row_number().over(Window.partitionBy("_nb_part").orderBy(*order)))
    found = inside.join(F.broadcast(before), "_nb_part")  # a row a bucket
    return found.withColumn(name, F.col("_nb_before") + F.col("_nb_in") - 1).drop("_nb_part", "_nb_key", "_nb_in", "_nb_before")
