"""Scoring of review files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starlens.operators.scoring import score_batch


def arriving_reviews(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """A stream over the Parquet files of a folder; the schema is fixed, never inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def score_arriving(
    reviews: DataFrame, text_column: str, model, target: str, checkpoint: str, available_now: bool = True, keys: Sequence[str] = ()
) -> StreamingQuery:
    """Score a stream and append to Parquet.

    Scoring is stateless, so each file is read once and no state grows; the
    checkpoint and the file sink together write every row exactly once.
    """
    writer = (
        score_batch(reviews, text_column, model, keys).writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
