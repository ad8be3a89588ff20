"""Category summaries and their catalogue as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMARY_SCHEMA = (
    "category string, total_reviews bigint, "
    "ratings map<string, struct<count: bigint, summary: string, sampled: bigint>>, category_slug string"
)
CATALOGUE_SCHEMA = "category string, category_slug string, file string, total_reviews bigint"


def write_summaries(summaries: DataFrame, folder: str) -> None:
    """One JSON document per category in the folder of its slug, and the catalogue.

    Categories with the same slug share a folder; both rows are kept.
    """
    summaries.write.partitionBy("category_slug").json(f"{folder}/summaries")
    catalogue = summaries.select(
        "category", "category_slug",
        F.concat(F.lit(f"{folder}/summaries/category_slug="), "category_slug").alias("file"),
        "total_reviews",
    )
    catalogue.write.json(f"{folder}/index")


def read_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CATALOGUE_SCHEMA).json(f"{folder}/index")


def read_summaries(spark: SparkSession, folder: str, slug: str | None = None) -> DataFrame:
    """Summary documents; a slug reads only the folder of that category."""
    found = spark.read.schema(SUMMARY_SCHEMA).json(f"{folder}/summaries")
    return found.where(F.col("category_slug") == slug) if slug else found
