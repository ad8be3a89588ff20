"""Work that must not gather in one task as tables grow."""

from pyspark.sql import functions as F

from starlens.checks import queries
from starlens.operators import models


def test_csv_files_have_bounded_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "CSV_ROWS", 20, raising=False)
    folder = queries.csv_folder(spark, tables)
    lines = spark.read.option("recursiveFileLookup", "true").option("header", "true").option("multiLine", "true").option("escape", '"')
    most = lines.csv(folder).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most <= 20
    assert queries.csv_read(spark, tables).count() == queries.raw(spark, tables).count()


def test_models_of_reviews_are_fitted_on_small_parts(spark):
    table = spark.range(0, 103, 1, 2)
    parts = models.in_small_parts(table, 10)
    assert parts.rdd.getNumPartitions() == 11 and parts.count() == 103
    assert models.in_small_parts(table, 60).rdd.getNumPartitions() == 2


def test_long_reviews_make_smaller_parts(spark):
    table = spark.range(0, 40, 1, 2).selectExpr("id", "if(id < 20, repeat('long text ', 100), null) as text")
    parts = models.in_small_parts(table, 30, text="text", chars=2_000)
    assert parts.rdd.getNumPartitions() == 10 and parts.count() == 40
    assert models.in_small_parts(table, 30, text="text", chars=20_000).rdd.getNumPartitions() == 2
    assert models.in_small_parts(table.where("id < 0"), 30, text="text").rdd.getNumPartitions() == 2


def test_arriving_files_follow_the_rows_not_the_parts(spark, tables, monkeypatch):
    """A trigger takes two files, so many small ones would leave most of a cluster idle."""
    given = spark.range(0, 90, 1, 15).selectExpr("id as review_id", "concat('text of review ', id) as text")
    seen = []

    def stopped(spark, folder, schema, files):
        seen.append((len(spark.read.parquet(folder).inputFiles()), spark.read.parquet(folder).count()))
        raise KeyError

    monkeypatch.setattr(queries, "raw", lambda s, d: given)
    monkeypatch.setattr(queries.score_files, "arriving_reviews", stopped)
    for rows, files in ((queries.ARRIVING_ROWS, 4), (10, 9)):
        monkeypatch.setattr(queries, "ARRIVING_ROWS", rows)
        try:
            queries.stream_scores(spark, tables)
        except KeyError:
            pass
        assert seen.pop() == (files, 90)
