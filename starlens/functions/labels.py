"""Ratings and labels as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.constants import (
    NEGATIVE, NEGATIVE_MARKS, NEUTRAL, NEUTRAL_MARKS, POSITIVE, SENTIMENTS, UNKNOWN,
)

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def rating_number(rating: Column) -> Column:
    """The rating as a double, null where it is no number."""
    text = rating.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def whole_rating(rating: Column) -> Column:
    """The rating as a number rounded half to even, null where it is no number."""
    return F.rint(rating_number(rating)).cast("int")


def sentiment_of(rating: Column) -> Column:
    """Sentiment class of a star rating; only exact 1..5 are known."""
    number = rating_number(rating)
    return (
        F.when(number.isin(1.0, 2.0, 3.0), NEGATIVE)
        .when(number == 4.0, NEUTRAL)
        .when(number == 5.0, POSITIVE)
        .otherwise(UNKNOWN)
    )


def label_code(sentiment: Column) -> Column:
    """0, 1, 2 in alphabetical order of the class; null for any other label."""
    chain = F
    for code, name in enumerate(SENTIMENTS):
        chain = chain.when(sentiment == name, F.lit(code))
    return chain


def label_name(code: Column) -> Column:
    """Class of a label code; any other code is unknown."""
    chain = F
    for value, name in enumerate(SENTIMENTS):
        chain = chain.when(code == value, F.lit(name))
    return chain.otherwise(UNKNOWN)


def normalised_label(label: Column) -> Column:
    """Class of a label as foreign models write it (``LABEL_0``, ``3 stars``, ``positive``)."""
    upper = F.upper(label)

    def has_any(marks):
        return reduce(lambda a, b: a | b, [F.contains(upper, F.lit(mark)) for mark in marks])

    return F.when(has_any(NEGATIVE_MARKS), NEGATIVE).when(has_any(NEUTRAL_MARKS), NEUTRAL).otherwise(POSITIVE)
