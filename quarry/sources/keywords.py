"""S01-S03 keyword lines.

A keyword file is read whole (``wholetext``) so the line ordinal survives;
lines are trimmed of all (ECMAScript) whitespace, CR included, blanks and ``#`` comments dropped, order kept.  Files are
small; many files parallelise by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import JSWS


def keyword_lines(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """Split a text column into keyword lines: (…order, line_no, keyword).

    ``line_no`` is the 0-based position of the raw line, so arrival order is
    (order…, line_no) without any global numbering.
    """
    exploded = df.select(*order, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
                         .alias("line_no", "raw"))
    kw = F.regexp_replace("raw", f"^{JSWS}+|{JSWS}+$", "")
    return (exploded.select(*order, "line_no", kw.alias("keyword"))
            .filter((F.col("keyword") != "") & ~F.col("keyword").startswith("#")))


def read_keywords(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """(keyword_ord, keyword) from keyword files; ``limit`` keeps the first N lines.

    Several files are numbered on from one another, in the order of their paths: an ordinal is never given twice.
    """
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = keyword_lines(raw, "value", ["file"])
    per_file = lines.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    before = per_file.select("file", (F.sum("_n").over(Window.orderBy("file")) - F.col("_n")).alias("_before"))
    w = Window.partitionBy("file").orderBy("line_no")
    own = lines.withColumn("_at", F.row_number().over(w) - 1).join(before, "file")
    out = own.select((F.col("_before") + F.col("_at")).cast("int").alias("keyword_ord"), "keyword")
    return out.filter(F.col("keyword_ord") < limit) if limit > 0 else out


def keywords_from(spark: SparkSession, queries: list[str]) -> DataFrame:
    """Ad-hoc queries replace the keyword file (driver-side list of a few strings)."""
    return spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "keyword_ord INT, keyword STRING")
