"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.constants import MIN_REVIEW_CHARS, UNKNOWN
from starlens.functions.labels import sentiment_of
from starlens.functions.text import clean_text, content_words, processed_tokens, slug, tokens
from starlens.operators.lemmas import with_lemmas


def with_sentiment(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("sentiment", sentiment_of(F.col("rating")))


def usable(reviews: DataFrame) -> DataFrame:
    """Rows with text of at least ten characters and a known sentiment."""
    return reviews.na.drop(subset=["text", "sentiment"]).where(
        (F.length("text") >= MIN_REVIEW_CHARS) & (F.col("sentiment") != UNKNOWN)
    )


def kept(df: DataFrame, name: str, value: Column, keep) -> DataFrame:
    """Add a costly column and drop the rows that fail ``keep``.

    A plain filter would be pushed below the projection and compute the value
    twice; here it is computed once and rows that fail give no output.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.filter(F.array(value), keep)).alias(name))


def with_cleaned_text(reviews: DataFrame) -> DataFrame:
    """Add ``cleaned_text`` and keep the rows where something is left."""
    return kept(reviews, "cleaned_text", clean_text(F.col("text")), lambda t: F.length(t) > 0)


def with_processed_tokens(reviews: DataFrame, source: str = "text", lemmas: DataFrame | None = None) -> DataFrame:
    """Add ``tokens`` (lemmas of the content words) and keep the rows that have any.

    Lemmas come from a table of ``lemmas.lemma_table``, or without one from the suffix rules of ``noun_lemma``.
    """
    if lemmas is not None:
        return with_lemmas(kept(reviews, "tokens", content_words(tokens(clean_text(F.col(source)))), lambda t: F.size(t) > 0), lemmas)
    return kept(reviews, "tokens", processed_tokens(F.col(source)), lambda t: F.size(t) > 0)


def category_is(exploded: DataFrame, name: str) -> DataFrame:
    """Rows of the category with this name in any case, or with the same slug."""
    target = name.strip().lower()
    return exploded.where((F.lower("category") == target) | (slug(F.col("category")) == slug(F.lit(target))))


def category_contains(exploded: DataFrame, part: str) -> DataFrame:
    return exploded.where(F.contains(F.lower("category"), F.lit(part.strip().lower())))


def search_catalogue(catalogue: DataFrame, pattern: str) -> DataFrame:
    """Categories that match a regular expression in any case."""
    return catalogue.where(F.col("category").rlike(f"(?i){pattern}")) if pattern else catalogue


def category_in(exploded: DataFrame, wanted: DataFrame) -> DataFrame:
    """Membership in a table of categories."""
    return exploded.join(wanted.select("category"), "category", "left_semi")
