"""Multinomial naive Bayes as aggregations and joins.

The model is a table with one row per term plus one row (empty term) for the
class priors, so scoring is a single equi-join: documents add the empty term
once with value 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.constants import NEUTRAL, SENTIMENTS, VOCABULARY_SIZE
from starlens.functions.text import let
from starlens.operators.features import bounded

BIAS = ""


def log_name(sentiment: str) -> str:
    return f"log_{sentiment.lower()}"


def per_class(value: Column) -> list[Column]:
    """Sum of a value for each class."""
    return [
        F.coalesce(F.sum(F.when(F.col("sentiment") == s, value)), F.lit(0)).cast("double").alias(s) for s in SENTIMENTS
    ]


def class_sums(rows: DataFrame, weight: str = "copies") -> DataFrame:
    """Feature mass per term and class; one row per vocabulary term."""
    return rows.groupBy("term").agg(*per_class(F.col("value") * F.col(weight)))


def class_sizes(documents: DataFrame, weight: str = "copies") -> DataFrame:
    """Document mass per class, as a single row under the empty term."""
    return documents.agg(*per_class(F.col(weight))).select(F.lit(BIAS).alias("term"), *SENTIMENTS)


def log_model(sums: DataFrame, sizes: DataFrame, boosts: dict[str, float], alpha: float = 1.0) -> DataFrame:
    """``model, term, log_negative, log_neutral, log_positive`` for each named boost of the Neutral class.

    A class weight only scales the sums of its class, so all variants come
    from the same sums. Both tables are no longer than the vocabulary.
    """
    variants = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(float(b)).alias("boost")) for m, b in boosts.items()])

    def each(table):
        scaled = {s: F.col(s) * F.col("boost") if s == NEUTRAL else F.col(s) for s in SENTIMENTS}
        return table.select("*", F.inline(variants)).select("model", "term", *[scaled[s].alias(s) for s in SENTIMENTS])

    terms = Window.partitionBy("model")
    likelihoods = each(sums).select("model", "term", *[
        F.ln((F.col(s) + alpha) / (F.sum(s).over(terms) + alpha * F.count("*").over(terms))).alias(log_name(s))
        for s in SENTIMENTS
    ])
    whole = sum((F.col(s) for s in SENTIMENTS), F.lit(0.0))
    priors = each(sizes).select("model", "term", *[F.ln(F.col(s) / whole).alias(log_name(s)) for s in SENTIMENTS])
    return likelihoods.unionByName(priors)


def fit(documents: DataFrame, rows: DataFrame, boosts: dict[str, float] | None = None, weight: str = "copies") -> DataFrame:
    """The model table (see ``log_model``).

    ``documents`` and ``rows`` (their long features) carry ``sentiment`` and a
    weight column, which stands for repeated or weighted training rows.
    """
    return log_model(class_sums(rows, weight), class_sizes(documents, weight), boosts or {"Naive Bayes": 1.0})


def predict(
    documents: DataFrame, rows: DataFrame, model: DataFrame, keys: Sequence[str] = ("review_id", "sentiment"),
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """``model, keys`` with the predicted class, its confidence and all probabilities.

    All models in the table score in the same pass. The true class, where
    there is one, comes out as ``actual``.
    """
    carried = [F.col(k).alias("actual") if k == "sentiment" else F.col(k) for k in keys]
    names = ["model", *["actual" if k == "sentiment" else k for k in keys]]
    entries = rows.select(*carried, "term", "value").unionByName(
        documents.select(*carried, F.lit(BIAS).alias("term"), F.lit(1.0).alias("value"))
    )
    scores = entries.join(bounded(model, size + 1), "term").groupBy(*names).agg(
        *[F.sum(F.col("value") * F.col(log_name(s))).alias(s) for s in SENTIMENTS]
    )
    return with_probabilities(scores, names)


def with_probabilities(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Turn joint log-likelihoods per class into the row layout of a scored review."""
    likely = F.greatest(*SENTIMENTS)
    shares = F.array(*[F.exp(F.col(s) - likely) for s in SENTIMENTS])
    normal = let(shares, lambda a: F.transform(a, lambda x: x / F.aggregate(a, F.lit(0.0), lambda t, y: t + y)))
    chosen = F
    for s in SENTIMENTS:  # ties go to the first class
        chosen = chosen.when(F.round(F.col(s), 6) == F.round(likely, 6), s)
    return scores.select(*keys, chosen.alias("sentiment"), normal.alias("p")).select(
        *keys, "sentiment",
        F.round(F.array_max("p"), 6).alias("confidence"),
        *[F.round(F.get("p", F.lit(i)), 6).alias(f"prob_{s.lower()}") for i, s in enumerate(SENTIMENTS)],
    )
