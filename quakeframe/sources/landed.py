"""Landed JSON: payload lines and feature-collection documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.schemas import COLLECTION_DDL


def payload_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of text, named ``payload_json``."""
    return spark.read.text(path).select(F.col("value").alias("payload_json"))


def read_feature_collections(
    spark: SparkSession, path: str, one_per_line: bool = False, schema: str = COLLECTION_DDL
) -> DataFrame:
    """One row per document; each document is one fetch and so of limited size.

    A document is a file of its own, unless the files hold ``one_per_line``.
    """
    return spark.read.schema(schema).option("multiLine", not one_per_line).json(path)


def parse_feature_collection(df: DataFrame, column: str = "value") -> DataFrame:
    """Documents held as text in a column, next to the other columns of the row."""
    others = [name for name in df.columns if name != column]
    # inline() keeps later filters from being pushed into a second parse.
    parsed = F.inline(F.array(F.from_json(F.col(column), COLLECTION_DDL)))
    return df.select(*others, parsed)


def feature_id(feature: str | Column = "feature") -> Column:
    return F.try_variant_get(feature, "$.id", "string")


def explode_features(collections: DataFrame) -> DataFrame:
    """One row per feature with its position in the document and the source address."""
    others = [n for n in collections.columns if n not in ("type", "metadata", "features")]
    return collections.select(
        *others,
        F.col("metadata.url").alias("source_url"),
        F.posexplode("features").alias("position", "feature"),
    ).select("*", feature_id("feature").alias("event_id"))
