"""Summary tables over reviews and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.constants import MIN_REVIEW_CHARS, SENTIMENTS, UNKNOWN
from starlens.functions.numbers import percent
from starlens.functions.text import clean_text, processed_tokens


def distribution(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """Rows and share per value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    # The window runs over one row per class, not over the reviews.
    whole = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(column, "n", percent(F.col("n"), whole).alias("pct"))


def scored_summary(scored: DataFrame) -> DataFrame:
    """Rows and share (one decimal) of all three classes, zero where none was predicted."""
    wide = scored.agg(F.count("*").alias("total"), *[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS])
    rows = F.array(*[
        F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("n"),
                 F.when(F.col("total") > 0, percent(F.col(s), F.col("total"), 1)).otherwise(0.0).alias("pct"))
        for s in SENTIMENTS
    ])
    return wide.select(F.inline(rows))


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("data_source").agg(F.count("*").alias("n"))


def rating_sentiment_map(df: DataFrame) -> DataFrame:
    return df.groupBy("rating", "sentiment").agg(F.count("*").alias("n"))


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def cleaning_funnel(reviews: DataFrame) -> DataFrame:
    """Rows before and after every cleaning step, all counted in one pass.

    Each step also demands the ones before it, so the counts of one pass
    equal those of filtering step by step.
    """
    text = F.col("text")
    steps = [
        ("has_text", text.isNotNull() & F.col("sentiment").isNotNull()),
        ("long_enough", F.length(text) >= MIN_REVIEW_CHARS),
        ("known_sentiment", F.col("sentiment") != UNKNOWN),
        ("cleaned", F.length(clean_text(text)) > 0),
        ("processed", F.size(processed_tokens(text)) > 0),
    ]
    # Steps passed per row: 0 to 5. Later steps only run where the earlier ones passed.
    passed = F.lit(len(steps))
    for place, (_, condition) in reversed(list(enumerate(steps))):
        passed = F.when(condition, passed).otherwise(place)
    names = ["start"] + [name for name, _ in steps]
    rows = F.array(*[
        F.struct(F.lit(after).alias("stage"), F.col(before).alias("rows_in"), F.col(after).alias("rows_out"),
                 (F.col(before) - F.col(after)).alias("removed"))
        for before, after in zip(names, names[1:])
    ])
    return reviews.select(passed.alias("passed")).groupBy("passed").agg(F.count("*").alias("n")).agg(*[
        F.coalesce(F.sum(F.when(F.col("passed") >= place, F.col("n"))), F.lit(0)).alias(name)
        for place, name in enumerate(names)
    ]).select(F.inline(rows))


def text_stats(processed: DataFrame) -> DataFrame:
    """Mean length of the raw and of the processed text, and mean word count."""
    joined = F.array_join("tokens", " ")
    return processed.agg(
        F.round(F.avg(F.length("text")), 6).alias("avg_chars_raw"),
        F.round(F.avg(F.length(joined)), 6).alias("avg_chars_processed"),
        F.round(F.avg(F.size("tokens")), 6).alias("avg_words"),
    )


def mean_probabilities(scored: DataFrame) -> DataFrame:
    names = [f"prob_{s.lower()}" for s in SENTIMENTS]
    return scored.agg(*[F.round(F.avg(n), 6).alias(n) for n in names])


def neutral_diagnostics(scored: DataFrame) -> DataFrame:
    """Mean Neutral and Positive probability over the rows that are Neutral in truth."""
    true_neutral = F.col("actual") == "Neutral"
    return scored.agg(
        F.count_if(true_neutral).alias("n_neutral"),
        F.round(F.avg(F.when(true_neutral, F.col("prob_neutral"))), 6).alias("avg_neutral"),
        F.round(F.avg(F.when(true_neutral, F.col("prob_positive"))), 6).alias("avg_positive"),
    )


def worst_neutral(scored: DataFrame, n: int = 5) -> DataFrame:
    """The true-Neutral rows with the lowest Neutral probability."""
    return (
        scored.where(F.col("actual") == "Neutral")
        .select("review_id", F.col("sentiment").alias("predicted"),
                F.round("prob_neutral", 6).alias("prob_neutral"), F.round("prob_positive", 6).alias("prob_positive"))
        .orderBy("prob_neutral", "review_id").limit(n)
    )


def accuracy_by_model(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("model").agg(
        F.round(F.avg("accuracy"), 6).alias("avg_accuracy"), F.round(F.max("accuracy"), 6).alias("max_accuracy")
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in equal-width bins over the range of a column; the last bin is closed."""
    everything = Window.partitionBy(F.lit(1))
    low, high = F.min(column).over(everything), F.max(column).over(everything)
    # One row per model: the window never sees more than the metrics table.
    span = df.select(F.col(column).alias("x"), low.alias("low"), high.alias("high"))
    place = F.when(F.col("high") == F.col("low"), F.lit(bins // 2)).otherwise(
        F.least(F.floor(F.lit(bins) * (F.col("x") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))),
                F.lit(bins - 1))
    )
    return span.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
