"""Landed search responses, read by an explicit schema; bodies that fail theirs go to a dead-letter table.

``land_responses`` writes them partitioned by source, so that a selection of sources (S17) prunes folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..operators.discover import filter_sources
from .normalise import REGISTRY

RESPONSE_SCHEMA = T.StructType([
    T.StructField("keyword_ord", T.IntegerType()), T.StructField("keyword", T.StringType()),
    T.StructField("variant_ord", T.IntegerType()), T.StructField("variant", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("search_url", T.StringType()),
    T.StructField("body", T.StringType()),
])


def checked_schema(df: DataFrame, schema: T.StructType = RESPONSE_SCHEMA) -> DataFrame:
    """``df``'s columns of ``schema``; a missing column or one of another type raises ValueError at once."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, not {f.dataType.simpleString()}"
             for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("not search responses: " + "; ".join(wrong))
    return df.select(*schema.fieldNames())


def land_responses(responses: DataFrame, path: str, mode: str = "append") -> None:
    """Write responses as Parquet, a folder per source."""
    checked_schema(responses).write.mode(mode).partitionBy("source").parquet(path)


def read_search_responses(spark: SparkSession, path: str, selection: str = "") -> DataFrame:
    """S05 + S17: landed responses; ``selection`` is a filter on the folders, so that other sources aren't read."""
    df = spark.read.schema(RESPONSE_SCHEMA).parquet(path)
    return filter_sources(checked_schema(df), selection)


def body_problem() -> Column:
    """Why a body can't be normalised, or null: unknown source, missing body, not JSON, or no array where its items should be.

    An absent item array is no problem: the response has no results.
    """
    source, body = F.col("source"), F.col("body")
    parsed = F.try_parse_json(body)
    items = F.lit(None).cast("string")
    for name, (_, path, _) in REGISTRY.items():
        items = F.when(source == name, F.schema_of_variant(F.try_variant_get(parsed, "$." + ".".join(path), "variant"))).otherwise(items)
    shapeless = ~F.coalesce(items, F.lit("VOID")).rlike("^(ARRAY<|VOID$)") | ~F.schema_of_variant(parsed).startswith("OBJECT")
    return (F.when(~F.coalesce(source, F.lit("")).isin(K.ALL_SOURCES), F.lit("unknown source"))
            .when(~F.coalesce(body, F.lit("")).rlike(r"\S"), F.lit("missing body"))
            .when(source.isin(K.HTML_SOURCES), F.lit(None))
            .when(parsed.isNull(), F.lit("not JSON")).when(shapeless, F.lit("items are no array")))


def good_responses(responses: DataFrame) -> DataFrame:
    """The responses that the normalisers can read."""
    return responses.filter(body_problem().isNull())


def dead_letters(responses: DataFrame) -> DataFrame:
    """The others, with the ``problem``; together with ``good_responses`` they are all responses."""
    return responses.withColumn("problem", body_problem()).filter("problem IS NOT NULL")
