"""The article index's reader, and sinks. Every write is a job commit with overwrite semantics; a set of
outputs is published by one manifest (S16).

CSV: ``quote='"'``, ``escape='"'`` (doubled quotes), empty strings and
nulls written as nothing, no whitespace trimming, header, fixed column
order (Q15).  Column values are cast to string first so blank INT cells
stay blank.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.pages import grid_csv

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "lineSep": "\n", "quoteAll": "false"}


def write_csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite",
              single_file: bool = False) -> None:
    """Fixed column order, minimal quoting."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_articles_csv(articles: DataFrame, path: str) -> None:
    """Article index, 12 columns (sort first with ``operators.discover.rank``)."""
    write_csv(articles, path, K.ARTICLE_CSV_COLUMNS)


def write_articles_json(articles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Article index as JSON lines, 14 fields (abstract and searchUrl included)."""
    renamed = articles.withColumnRenamed("search_url", "searchUrl")
    renamed.select(*K.ARTICLE_JSON_COLUMNS).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_records_json(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested canonical records."""
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)


def grid_rows(tables: DataFrame, key: str = "table_id", buckets: int = 64) -> DataFrame:
    """(bucket, key, csv), one CSV text per table; the long cell table stays the core output."""
    return tables.select(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), F.col(key),
                         grid_csv(F.col("grid")).alias("csv"))


def write_grids(tables: DataFrame, path: str, key: str = "table_id", mode: str = "overwrite",
                buckets: int = 64) -> None:
    """The grids as rows of Parquet in as many folders as ``buckets``, however many tables there are."""
    grid_rows(tables, key, buckets).write.mode(mode).partitionBy("bucket").parquet(path)


def _index(records: DataFrame, name: str, fields: dict, columns: list[str]) -> DataFrame:
    """A row per element of the records' evidence array ``name``, under the fixed column names."""
    rows = records.select(F.col("doi").alias("_doi"), F.col("title").alias("_title"), F.col("source").alias("_source"),
                          F.col("score").alias("_score"), F.col("extraction.final_url").alias("_url"),
                          F.explode(f"extraction.{name}").alias("e"))
    own = {"doi": "_doi", "title": "_title", "source": "_source", "score": "_score", "articleUrl": "_url"}
    return rows.select(*[F.col(own[c] if c in own else f"e.{fields[c]}").alias(c) for c in columns])


def table_index(records: DataFrame) -> DataFrame:
    """Tables.csv rows of nested records."""
    return _index(records, "tables", {"file": "file", "tableNumber": "table_number", "caption": "caption",
                                      "rows": "rows", "columns": "columns"}, K.TABLE_INDEX_COLUMNS)


def figure_index(records: DataFrame) -> DataFrame:
    """Figures.csv rows."""
    return _index(records, "figures", {"figureNumber": "figure_number", "caption": "caption", "file": "file",
                                       "imageUrl": "image_url"}, K.FIGURE_INDEX_COLUMNS)


def dataset_index(records: DataFrame) -> DataFrame:
    """Datasets.csv rows; files and errors are '; '-joined already."""
    return _index(records, "dataset_links", {"linkText": "text", "datasetUrl": "url", "resolvedUrl": "resolved_url",
                                             "downloadedFiles": "downloaded_files", "downloadStatus": "download_status",
                                             "downloadError": "download_error"}, K.DATASET_INDEX_COLUMNS)


def write_records_csv(flat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The flat evidence table, its 20 columns in order."""
    write_csv(flat, path, K.FLAT_RECORD_COLUMNS, mode)


def read_articles(spark, path: str, corrupt: str = "fail") -> DataFrame:
    """The article index, as JSON lines (``write_articles_json``) or as one JSON array, pretty-printed or not.

    An explicit schema: nothing is inferred, and a missing path fails at once.  What isn't JSON fails the
    read, or with ``corrupt="keep"`` stays as a row whose text is in ``corrupt_record``.
    """
    fields = [f"{c} {'int' if c == 'score' else 'string'}" for c in K.ARTICLE_JSON_COLUMNS]
    keep = corrupt == "keep"
    if keep:
        fields.append("corrupt_record string")
    first = spark.read.text(path).select(F.ltrim("value", F.lit(" \t\r\ufeff")).alias("v")).filter("v <> ''").head()
    reader = spark.read.schema(", ".join(fields)).option("mode", "PERMISSIVE" if keep else "FAILFAST")
    if keep:
        reader = reader.option("columnNameOfCorruptRecord", "corrupt_record")
    is_array = first is not None and first.v.startswith("[")
    return reader.option("multiLine", is_array).json(path).withColumnRenamed("searchUrl", "search_url")


# -- S16: one commit for a set of outputs ------------------------------------------------------

def publish(spark, path: str, outputs: dict[str, DataFrame], rerun: DataFrame | None = None, key: str = "article_id") -> int:
    """Write a set of outputs and make them current together; returns the set's number.

    Every output is staged under a folder of its own set; a single-row manifest, committed last, names the
    set.  A write that fails leaves the manifest, and so the set that readers see, as it was.  With ``rerun``
    (a table of ``key`` values that were extracted again, evidence or none) the outputs hold only their rows,
    and the present set's rows of all other keys are carried over.  One writer at a time.
    """
    present = _manifest(spark, path)
    number = (present["number"] if present else 0) + 1
    at = f"{path.rstrip('/')}/sets/{number}-{uuid.uuid4().hex}"
    for name, df in outputs.items():
        if rerun is not None and present and name in present["names"]:
            others = spark.read.parquet(f"{present['at']}/{name}").join(rerun.select(key).distinct(), key, "left_anti")
            df = others.unionByName(df)
        df.write.mode("error").parquet(f"{at}/{name}")
    row = spark.createDataFrame([(number, at, sorted(outputs))], _MANIFEST)
    row.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/manifest")
    return number


def published(spark, path: str, name: str) -> DataFrame:
    """An output of the current set."""
    present = _manifest(spark, path)
    if present is None or name not in present["names"]:
        raise ValueError(f"{path}: nothing published as {name}")
    return spark.read.parquet(f"{present['at']}/{name}")


_MANIFEST = "number long, at string, names array<string>"


def _manifest(spark, path: str):
    """The newest manifest row (one a set), or None."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/manifest")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.schema(_MANIFEST).json(at.toString()).orderBy(F.col("number").desc()).first()
