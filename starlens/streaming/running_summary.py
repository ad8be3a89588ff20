"""Counts of a stream of scored reviews by time window and sentiment, kept up to date while it runs.

The counts live in Spark's state store below the checkpoint folder, so a restarted query goes on where it stopped. Each micro-batch writes the
windows that it changed to a folder of its own, named by the batch: a batch that is repeated after a failure replaces its folder and counts nothing
twice. The latest batch of a window holds its counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starlens.constants import SENTIMENTS
from starlens.functions.numbers import percent

STATE = "window_start timestamp, sentiment string, n bigint"


def window_counts(scored: DataFrame, time: str, window: str = "1 day", lateness: str = "7 days", keys: Sequence[str] = ()) -> DataFrame:
    """``window_start, sentiment, n`` of a stream (or a table) of scored reviews.

    Rows more than ``lateness`` behind the newest one seen are dropped and their windows' state with them, which bounds the state; without a time
    or sentiment a row counts nowhere. With ``keys`` a row that arrives again within that time counts once. Rows of a window are counted in their tasks
    first, so a window that holds most rows is no burden.
    """
    known = scored.where(F.col(time).isNotNull() & F.col("sentiment").isNotNull())
    if scored.isStreaming:
        known = known.withWatermark(time, lateness)
    if keys:
        known = known.dropDuplicatesWithinWatermark(list(keys)) if scored.isStreaming else known.dropDuplicates(list(keys))
    counts = known.groupBy(F.window(time, window).alias("w"), "sentiment").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").cast("timestamp").alias("window_start"), "sentiment", "n")


def keep_summary(scored: DataFrame, time: str, target: str, checkpoint: str, window: str = "1 day", lateness: str = "7 days", keys: Sequence[str] = (), available_now: bool = True) -> StreamingQuery:
    """Run the counts into ``target``, one folder for each micro-batch."""
    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    writer = window_counts(scored, time, window, lateness, keys).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def running_counts(spark: SparkSession, target: str) -> DataFrame:
    """``window_start, sentiment, n`` as of the last batch of each window."""
    written = spark.read.schema(f"{STATE}, batch bigint").parquet(target)
    return written.groupBy("window_start", "sentiment").agg(F.max_by("n", "batch").alias("n"))


def running_shares(counts: DataFrame) -> DataFrame:
    """All three classes of each window with rows and share (one decimal), zero where none was seen."""
    total = F.sum("n")
    wide = counts.groupBy("window_start").agg(total.alias("total"), *(F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("n"))), F.lit(0)).alias(s) for s in SENTIMENTS))
    rows = F.array(*(F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("n"), percent(F.col(s), F.col("total"), 1).alias("pct")) for s in SENTIMENTS))
    return wide.select("window_start", F.inline(rows))
