"""a landed dump of works laid out for the sources' predicates, which then reach the scan.

The dump has a folder per type and resource kind, and a row per ISSN of a work, sorted and with a Parquet
bloom filter on the ISSN.  A source's predicate becomes partition filters and a pushed ``In`` on one string;
the work's other ISSN rows are told from the first that matches without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K

LAYOUT = ["work_type", "resource_kind"]


def write_works(works: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lay out works (``issn`` ARRAY<STRING>, ``type``, ``resource_type``, further columns)."""
    rows = works.select("*", F.lower(F.coalesce("type", F.lit(""))).alias("work_type"), F.lower(F.coalesce("resource_type", F.lit(""))).alias("resource_kind"),
                        F.posexplode_outer(F.array_distinct("issn")).alias("issn_no", "issn_key"))
    dealt = rows.repartitionByRange(*LAYOUT, "issn_key").sortWithinPartitions(*LAYOUT, "issn_key")
    dealt.write.mode(mode).partitionBy(*LAYOUT).option("parquet.bloom.filter.enabled#issn_key", "true").parquet(path)


def read_works(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The works that a source's requests ask for, each once; any other source gets all works."""
    rows = spark.read.parquet(path)
    article = F.col("work_type") == "journal-article"
    once = F.coalesce(F.col("issn_no"), F.lit(0)) == 0
    if source == "Crossref Data Journals":
        matching = F.filter(F.array_distinct("issn"), lambda x: x.isin(K.DATA_JOURNAL_ISSNS))
        kept = rows.filter(article & F.col("issn_key").isin(K.DATA_JOURNAL_ISSNS) & (F.get(matching, 0) == F.col("issn_key")))
    elif source == "Crossref":
        kept = rows.filter(article & once)
    elif source == "DataCite":
        kept = rows.filter((F.col("resource_kind") == "dataset") & once)
    else:
        kept = rows.filter(once)
    return kept.drop("issn_no", "issn_key", *LAYOUT)
