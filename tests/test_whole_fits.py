"""Models of the queries learn from all labelled rows, however many there are."""

from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import Vectors

from starlens.checks import queries
from starlens.operators import models
from starlens.plans import training

ROWS = 5_040


class Seen(Exception):
    pass


@pytest.fixture
def many(spark, monkeypatch):
    """More rows than the models were once fitted on, in the place of the vectors of the reviews."""
    rows = [(i, ("Negative", "Neutral", "Positive", "Positive")[i % 4], 1, float((0, 1, 2, 2)[i % 4]), Vectors.sparse(2, {0: 1.0 + i % 3})) for i in range(ROWS)]
    train = spark.createDataFrame(rows, ["review_id", "sentiment", "copies", "label", "features"])
    monkeypatch.setattr(queries, "corpus", lambda s, d: None)
    monkeypatch.setattr(training, "ml_tables", lambda c, kind: (train, train))


def stop_at_fit(monkeypatch, fits):
    """No tree is grown: a fit notes how many rows it would read."""

    def noted(jobs, by_level=True):
        fits.extend(table.rows for table, _ in jobs)
        raise Seen

    monkeypatch.setattr(models, "fit_tables", noted)
    monkeypatch.setattr(training, "fit_tables", noted)
    for family in (models.Boosted, models.Forest):
        monkeypatch.setattr(family, "fit", lambda self, train: noted([(models.training_table(train), self)]))


def seen(monkeypatch, spark, query):
    fits = []
    stop_at_fit(monkeypatch, fits)
    with pytest.raises(Seen):
        query(spark, "")
    return fits


def test_boosted_refit_learns_from_all_rows(spark, many, monkeypatch):
    assert seen(monkeypatch, spark, queries.boosted_refit) == [ROWS, ROWS]


def test_feature_importances_learn_from_all_rows(spark, many, monkeypatch):
    assert seen(monkeypatch, spark, queries.feature_importances) == [ROWS]


@pytest.mark.parametrize("name", ["boosted_trees", "gradient_boosting"])
def test_families_learn_from_all_rows(spark, many, monkeypatch, name):
    assert seen(monkeypatch, spark, queries.QUERIES[name]) == [ROWS]


@pytest.mark.parametrize("name", ["grid_boosted", "grid_forest"])
def test_grids_learn_from_all_rows(spark, many, monkeypatch, name):
    fits = []

    def noted(train, **options):
        fits.append(train.count())
        raise Seen

    monkeypatch.setattr(models, name.replace("grid_", "") + "_grid", noted)
    with pytest.raises(Seen):
        queries.QUERIES[name](spark, "")
    assert fits == [ROWS]


def test_comparison_learns_from_all_rows(spark, many, monkeypatch):
    monkeypatch.setattr(training, "model_families", lambda rows: {"XGBoost": models.Boosted(1, 2, 0.5)})
    monkeypatch.setattr(queries, "corpus", lambda s, d: SimpleNamespace(vocab=spark.range(1)))
    assert seen(monkeypatch, spark, queries.QUERIES["model_matrix"]) == [ROWS, ROWS]
