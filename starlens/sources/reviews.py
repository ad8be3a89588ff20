"""Review tables in the shapes the operators expect."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.constants import (
    BINARY_RATINGS, CATEGORY_COLUMNS, FALLBACK_RATING_COLUMNS, LOCAL_RATING_COLUMNS, LOCAL_TEXT_COLUMNS,
    RATING_COLUMNS, RATINGS, TEXT_COLUMNS, TITLE_COLUMNS, UNKNOWN,
)
from starlens.functions.labels import whole_rating
from starlens.functions.text import strip
from starlens.session import driver_tables


def quoted(name: str):
    """Column by its whole name; names such as ``reviews.text`` contain dots."""
    return F.col(f"`{name}`")


def first_present(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((name for name in candidates if name in columns), None)


def detect_text_column(df: DataFrame) -> str:
    """Known name, else a name with ``review`` or ``text`` in it, else the first column."""
    known = first_present(df.columns, TEXT_COLUMNS)
    if known:
        return known
    similar = [c for c in df.columns if "review" in c.lower() or "text" in c.lower()]
    return (similar or df.columns)[0]


def detect_rating_column(df: DataFrame) -> str | None:
    """The standard rating column, else the first known alternative, else none."""
    return first_present(df.columns, ("reviews.rating", *FALLBACK_RATING_COLUMNS))


def normalize_schema(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Map any known layout to ``text, rating, categories[, title]``.

    Keeps rows with non-blank text and a rating that rounds to 1..5. Rows with
    null text are dropped. ``keep`` names further columns to carry along.
    """
    text, rating = first_present(df.columns, TEXT_COLUMNS), first_present(df.columns, RATING_COLUMNS)
    missing = [names[0] for names, found in ((TEXT_COLUMNS, text), (RATING_COLUMNS, rating)) if not found]
    if missing:
        raise KeyError(f"no column serves as {' or '.join(missing)}")
    categories, title = first_present(df.columns, CATEGORY_COLUMNS), first_present(df.columns, TITLE_COLUMNS)
    picked = [quoted(name) for name in keep] + [
        strip(quoted(text).cast("string")).alias("text"),
        whole_rating(quoted(rating)).alias("rating"),
        (F.coalesce(quoted(categories).cast("string"), F.lit("")) if categories else F.lit(UNKNOWN)).alias("categories"),
    ]
    if title:
        picked.append(quoted(title).alias("title"))
    return df.select(*picked).where(
        (F.length("text") > 0) & F.col("rating").between(min(RATINGS), max(RATINGS))
    )


def adapt_star_dataset(df: DataFrame) -> DataFrame:
    """``review_body``/``stars`` to the standard column names."""
    return df.withColumnsRenamed({"review_body": "reviews.text", "stars": "reviews.rating"})


def adapt_binary_dataset(df: DataFrame) -> DataFrame:
    """A 0/1 label to a low or high rating; the label is dropped."""
    label = F.col("label")
    rating = reduce(lambda c, kv: c.when(label == kv[0], F.lit(kv[1])), BINARY_RATINGS.items(), F)
    return df.withColumn("reviews.rating", rating).withColumnRenamed("text", "reviews.text").drop("label")


def adapt_local_dataset(df: DataFrame) -> DataFrame:
    """Rename the text and rating columns of a local file to the standard names."""
    renames = {}
    for target, candidates in (("reviews.text", LOCAL_TEXT_COLUMNS), ("reviews.rating", LOCAL_RATING_COLUMNS)):
        found = first_present(df.columns, candidates)
        if found and target not in df.columns:
            renames[found] = target
    return df.withColumnsRenamed(renames)


def tag_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("data_source", F.lit(name))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    if not frames:
        raise ValueError("no review source given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- review views over the given tables -------------------------------------------------


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents seen as reviews with messy ratings and category lists."""
    (documents,) = driver_tables(spark, folder, "documents")
    row = F.col("doc_id")
    return documents.select(
        row.alias("review_id"),
        "text",
        F.when(row % 17 == 0, "n/a").when(row % 19 == 0, "4.5")
        .otherwise((row % 5 + 1).cast("string")).alias("rating"),
        F.when(row % 11 == 0, None).when(row % 13 == 0, " , ")
        .otherwise(F.concat("source", F.lit(", "), "lang")).alias("categories"),
    )


def labelled_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with quality labels, seen as a rated three-class data set.

    Low quality counts as one star, toxic as four, the rest as five; so Neutral
    is the smallest class at every scale, as over-sampling demands.
    """
    documents, labels = driver_tables(spark, folder, "documents", "labels")
    rating = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 4).otherwise(5)
    return documents.join(labels, "doc_id").select(F.col("doc_id").alias("review_id"), "text", rating.alias("rating"))
