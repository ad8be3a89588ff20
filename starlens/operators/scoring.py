"""Scoring of review tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.constants import FAILED_LABEL, FAILED_SCORE, SENTIMENTS
from starlens.functions.labels import label_name, normalised_label
from starlens.functions.text import scored_part


def with_sentiment_columns(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Model output to the row layout of a scored review."""
    p = vector_to_array(F.col("probability"))
    return predicted.select(*keys, label_name(F.col("prediction")).alias("sentiment"), p.alias("p")).select(
        *keys, "sentiment", F.array_max("p").alias("confidence"),
        *[F.get("p", F.lit(i)).alias(f"prob_{s.lower()}") for i, s in enumerate(SENTIMENTS)],
    )


def score_batch(batch: DataFrame, text_column: str, model, keys: Sequence[str] = ()) -> DataFrame:
    """Score a table with a fitted review model; works on batch and streaming tables.

    The model holds text processing, vectorizer and classifier, so that serving
    treats text as training did. Every row gives one row, with the columns
    ``keys`` first; a null text is scored as an empty one and stays null.
    """
    given = F.col(f"`{text_column}`").cast("string")
    shown = batch.select(*keys, given.alias("original"), F.coalesce(given, F.lit("")).alias("text"))
    return with_sentiment_columns(model.transform(shown), [*keys, "original"]).select(
        *keys, F.col("original").alias("Original_Text"), F.col("sentiment").alias("Sentiment"),
        F.col("confidence").alias("Confidence"), *[F.col(f"prob_{s.lower()}").alias(f"Prob_{s}") for s in SENTIMENTS],
    )


def external_scores(
    reviews: DataFrame, model_factory: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], keys=("review_id",)
) -> DataFrame:
    """Score with an outside model: texts in, ``(label, score)`` out.

    The model is built once per task and gets whole batches. Only if a batch
    fails are its texts tried one by one; a text that fails alone gets the
    fixed failure result. Texts are truncated before they are shown.
    """
    keys = list(keys)

    def run(batches):
        model = model_factory()

        def one(text):
            try:
                return model([text])[0]
            except Exception:
                return FAILED_LABEL, FAILED_SCORE

        for batch in batches:
            texts = batch["shown"].tolist()
            try:
                results = model(texts)
            except Exception:
                results = [one(t) for t in texts]
            yield batch[keys].assign(label=[str(r[0]) for r in results], score=[float(r[1]) for r in results])

    types = {f.name: f.dataType.simpleString() for f in reviews.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", label string, score double"
    shown = reviews.select(*keys, scored_part(F.col("text")).alias("shown"))
    return shown.mapInPandas(run, schema).withColumn("sentiment", normalised_label(F.col("label")))


def length_stub() -> Callable[[list[str]], list[tuple[str, float]]]:
    """A stand-in model for tests: label and score depend on the length of the text."""
    names = ("POSITIVE", "LABEL_0", "3 stars", "5 stars", "neutral", "LABEL_1")

    def model(texts):
        if any(len(t) % 7 == 6 for t in texts):
            raise ValueError("text not accepted")
        return [(names[len(t) % 7], len(t) % 7 / 8) for t in texts]

    return model
