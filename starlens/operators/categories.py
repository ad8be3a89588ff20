"""Category lists, counts and the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.constants import MIN_CATEGORY_REVIEWS, RATINGS, REVIEWS_PER_RATING, TOP_CATEGORIES, UNKNOWN
from starlens.functions.text import slug, strip
from starlens.operators.filters import category_contains


def category_list(categories: Column) -> Column:
    """Trimmed, non-empty parts of a comma list."""
    parts = F.transform(F.split(F.coalesce(categories, F.lit("")), ","), strip)
    return F.filter(parts, lambda c: F.length(c) > 0)


def explode_categories(reviews: DataFrame) -> DataFrame:
    """One row per category of a review; a review without any goes to ``Unknown``.

    A category that a review lists twice gives two rows; ``naming`` tells them apart.
    """
    others = [c for c in reviews.columns if c != "categories"]
    named = F.posexplode_outer(category_list(F.col("categories"))).alias("naming", "category")
    return reviews.select(*others, named).select(
        *others, F.coalesce("category", F.lit(UNKNOWN)).alias("category"), F.coalesce("naming", F.lit(0)).alias("naming")
    )


def category_counts(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("category").agg(F.count("*").alias("total_reviews"))


def top_categories(exploded: DataFrame, top_n: int | None = TOP_CATEGORIES, min_reviews: int = 1) -> DataFrame:
    """The most reviewed categories, ties by name."""
    ranked = (
        category_counts(exploded).where(F.col("total_reviews") >= min_reviews)
        .orderBy(F.desc("total_reviews"), "category")
    )
    return (ranked if top_n is None else ranked.limit(top_n)).select(
        "category", slug(F.col("category")).alias("category_slug"), "total_reviews"
    )


def categories_containing(
    exploded: DataFrame, part: str, top_n: int = TOP_CATEGORIES, min_reviews: int = MIN_CATEGORY_REVIEWS
) -> DataFrame:
    return top_categories(category_contains(exploded, part), top_n, min_reviews)


def rating_columns() -> list[Column]:
    return [F.count_if(F.col("rating") == r).alias(f"n{r}") for r in RATINGS]


def rating_rows(cap: int | None) -> Column:
    """Array with one entry per rating 1..5, from the columns n1..n5."""
    def entry(r):
        n = F.col(f"n{r}")
        sampled = F.least(n, F.lit(cap).cast("bigint")) if cap else n
        return F.struct(F.lit(r).alias("rating"), n.alias("review_count"), sampled.alias("sampled"))

    return F.array(*[entry(r) for r in RATINGS])


def category_rating_counts(exploded: DataFrame, cap: int | None = REVIEWS_PER_RATING) -> DataFrame:
    """Reviews per category and rating, with zero rows; one aggregation and no join."""
    wide = exploded.groupBy("category").agg(*rating_columns())
    return wide.select("category", F.inline(rating_rows(cap)))


def category_totals(exploded: DataFrame) -> DataFrame:
    """Counts per category and rating with a total line (null rating) per category."""
    return (
        exploded.rollup("category", "rating").agg(F.count("*").alias("n"))
        .where(F.col("category").isNotNull())
    )


def sort_catalogue(catalogue: DataFrame, by: str = "total_reviews") -> DataFrame:
    if by == "category":
        return catalogue.orderBy("category")
    return catalogue.orderBy(F.desc("total_reviews"), "category")


def distinct_categories(exploded: DataFrame) -> DataFrame:
    return exploded.select("category").distinct()
