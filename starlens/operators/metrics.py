"""Evaluation from predictions with columns ``actual`` and ``predicted``.

All measures derive from one wide count of the nine class pairs, so a run
over any number of predictions is one aggregation without joins. ``keys``
evaluates several models in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.constants import SENTIMENTS
from starlens.functions.numbers import ratio


def cell(actual: str, predicted: str) -> str:
    return f"n_{actual.lower()}_{predicted.lower()}"


def total(names: Sequence[str]) -> Column:
    return reduce(add, [F.col(n) for n in names])


def support(s: str) -> Column:
    return total([cell(s, p) for p in SENTIMENTS])


def predicted(s: str) -> Column:
    return total([cell(a, s) for a in SENTIMENTS])


def hits(s: str) -> Column:
    return F.col(cell(s, s))


def precision(s: str) -> Column:
    return ratio(hits(s), predicted(s))


def recall(s: str) -> Column:
    return ratio(hits(s), support(s))


def f1(s: str) -> Column:
    """Harmonic mean of precision and recall, written with counts: 2tp/(actual+predicted)."""
    return ratio(2 * hits(s), support(s) + predicted(s))


def everything() -> Column:
    return total([cell(a, p) for a in SENTIMENTS for p in SENTIMENTS])


def weighted(measure) -> Column:
    return ratio(reduce(add, [measure(s) * support(s) for s in SENTIMENTS]), everything())


def macro(measure) -> Column:
    """Mean over the classes that occur in truth or prediction."""
    seen = {s: support(s) + predicted(s) > 0 for s in SENTIMENTS}
    top = reduce(add, [F.when(seen[s], measure(s)).otherwise(0.0) for s in SENTIMENTS])
    return ratio(top, reduce(add, [seen[s].cast("int") for s in SENTIMENTS]))


def pair_counts(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row (per key) with a count for each of the nine class pairs."""
    counts = [
        F.count_if((F.col("actual") == a) & (F.col("predicted") == p)).alias(cell(a, p))
        for a in SENTIMENTS for p in SENTIMENTS
    ]
    return predictions.groupBy(*keys).agg(*counts)


def confusion_matrix(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``actual, predicted, n`` for all nine pairs, zero-filled."""
    rows = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(cell(a, p)).alias("n"))
        for a in SENTIMENTS for p in SENTIMENTS
    ])
    return pair_counts(predictions, keys).select(*keys, F.inline(rows))


def confusion_table(predictions: DataFrame) -> DataFrame:
    """The same as a square: one row per true class, one column per predicted class."""
    return confusion_matrix(predictions).groupBy("actual").pivot("predicted", list(SENTIMENTS)).agg(F.first("n"))


def summary_metrics(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted precision/recall/F1 and macro F1, one row per key."""
    accuracy = ratio(reduce(add, [hits(s) for s in SENTIMENTS]), everything())
    return pair_counts(predictions, keys).select(
        *keys,
        F.round(accuracy, 6).alias("accuracy"),
        F.round(weighted(precision), 6).alias("precision"),
        F.round(weighted(recall), 6).alias("recall"),
        F.round(weighted(f1), 6).alias("f1"),
        F.round(macro(f1), 6).alias("f1_macro"),
    )


def class_metrics(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each of the three classes."""
    rows = F.array(*[
        F.struct(F.lit(s).alias("sentiment"), F.round(precision(s), 6).alias("precision"),
                 F.round(recall(s), 6).alias("recall"), F.round(f1(s), 6).alias("f1"), support(s).alias("support"))
        for s in SENTIMENTS
    ])
    return pair_counts(predictions, keys).select(*keys, F.inline(rows))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Lines for the classes, then accuracy, macro and weighted averages."""
    def line(name, p, r, f, n):
        return F.struct(F.lit(name).alias("line"), F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"),
                        F.round(f, 6).alias("f1"), n.alias("support"))

    accuracy = ratio(reduce(add, [hits(s) for s in SENTIMENTS]), everything())
    lines = [line(s, precision(s), recall(s), f1(s), support(s)) for s in SENTIMENTS]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, everything()))
    lines.append(line("macro avg", macro(precision), macro(recall), macro(f1), everything()))
    lines.append(line("weighted avg", weighted(precision), weighted(recall), weighted(f1), everything()))
    return pair_counts(predictions).select(F.inline(F.array(*lines)))


def comparison(metrics: DataFrame) -> DataFrame:
    """The table of models with measures rounded to four digits."""
    return metrics.select(
        "vectorizer", "model",
        *[F.round(m, 4).alias(m) for m in ("accuracy", "precision", "recall", "f1", "f1_macro")],
    )


def best_model(metrics: DataFrame, measure: str = "accuracy", vectorizer: str | None = None) -> DataFrame:
    """The row with the highest measure, the first in training order on ties."""
    rows = metrics.where(F.col("vectorizer") == vectorizer) if vectorizer else metrics
    return rows.orderBy(F.desc(measure), "ordinal").limit(1)


def combined_results(baseline: DataFrame, tuned: DataFrame) -> DataFrame:
    return baseline.withColumn("type", F.lit("Baseline")).unionByName(tuned.withColumn("type", F.lit("Tuned")))


def improvement(baseline: DataFrame, tuned: DataFrame, keys: Sequence[str] = ("vectorizer", "model")) -> DataFrame:
    """Change of accuracy by tuning, in points and percent, with its band."""
    before = baseline.select(*keys, F.col("accuracy").alias("baseline"))
    after = tuned.select(*keys, F.col("accuracy").alias("tuned"))
    change = F.round(F.col("tuned") - F.col("baseline"), 6)
    band = F.when(change > 0.05, "significant").when(change > 0.02, "moderate").when(change > 0, "small").otherwise("none")
    return before.join(after, list(keys)).select(
        *keys, "baseline", "tuned", change.alias("improvement"),
        F.round(ratio(change * 100, F.col("baseline")), 4).alias("improvement_pct"), band.alias("band"),
    )
