"""Running counts: restarts, repeated batches, late and repeated rows, and the same table by SQL."""

import datetime as dt

from pyspark.sql import functions as F

from starlens.streaming import running_summary as rs
from starlens.streaming.score_files import arriving_reviews

SCHEMA = "id long, at timestamp, sentiment string"
DAY = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def rows(ids, day=0, sentiment="Positive"):
    return [(i, DAY + dt.timedelta(days=day, hours=i % 20), sentiment) for i in ids]


def test_restart_counts_every_row_once(spark, tmp_path):
    folder, target, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    batches = [
        rows(range(5)) + rows(range(5, 7), 1, "Negative"),
        rows(range(3)) + rows(range(7, 9), 1, "Neutral") + [(50, None, "Positive"), (51, DAY, None)],  # three rows again; no time, no sentiment
        rows(range(9, 12), 20),
        rows(range(20, 23), 0) + rows(range(30, 31), 19, "Negative"),  # the first three are too late by now
    ]
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):  # the second run finds nothing new
            stream = arriving_reviews(spark, folder, spark.createDataFrame([], SCHEMA).schema, 1)
            rs.keep_summary(stream, "at", target, log, lateness="5 days", keys=["id"]).awaitTermination()
    found = {(r.window_start.day, r.sentiment): r.n for r in rs.running_counts(spark, target).collect()}
    assert found == {(1, "Positive"): 5, (2, "Negative"): 2, (2, "Neutral"): 2, (21, "Positive"): 3, (20, "Negative"): 1}
    before = sorted(map(tuple, rs.running_counts(spark, target).collect()))
    spark.read.parquet(f"{target}/batch=0").write.mode("overwrite").parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("overwrite").parquet(f"{target}/batch=0")  # a batch that is written again
    assert sorted(map(tuple, rs.running_counts(spark, target).collect())) == before


def test_shares_and_plain_tables(spark):
    table = spark.createDataFrame(rows(range(3)) + rows(range(3)) + rows([5], 0, "Negative") + rows([6], 1, "Neutral"), SCHEMA)
    counts = rs.window_counts(table, "at", keys=["id"])
    shares = {(r.window_start.day, r.sentiment): (r.n, r.pct) for r in rs.running_shares(counts).collect()}
    assert shares == {(1, "Negative"): (1, 25.0), (1, "Neutral"): (0, 0.0), (1, "Positive"): (3, 75.0), (2, "Negative"): (0, 0.0), (2, "Neutral"): (1, 100.0), (2, "Positive"): (0, 0.0)}
    assert rs.running_shares(rs.window_counts(table.where("id > 99"), "at")).count() == 0
