"""Queries against their SQL on the smallest tables, and the chain of models."""

import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from starlens.checks import oracles
from starlens.operators import metrics, models, naive_bayes
from starlens.plans import training
from starlens.sources.reviews import labelled_reviews

TABLES = ("documents", "labels", "conversations", "benchmark", "pages", "embeddings")
SLOW = {"catalogue_read", "class_distribution", "accuracy_by_model", "accuracy_histogram", "best_model", "best_tfidf_model",
        "combined_results", "scored_csv", "mean_probabilities", "neutral_diagnostics", "confusion_table", "class_metrics",
        "summary_metrics", "first_features", "worst_neutral", "nb_predict_boosted", "scored_summary"}
CHECKED = sorted(set(oracles.oracle_sql()) - SLOW)


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def lines(frame):
    frame = frame[sorted(frame.columns)]

    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return ""
        return f"{float(x):.6f}" if not isinstance(x, str) else x

    return sorted(tuple(map(plain, row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, tables, duck, name):
    got = contract.queries()[name](spark, tables).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert lines(got) == lines(expected)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def corpus(spark, tables):
    return training.prepare(labelled_reviews(spark, tables))


def test_relational_bayes_agrees_with_mllib(corpus):
    train, test = training.ml_tables(corpus, "Count")
    fitted = training.fit_family("Naive Bayes", models.naive_bayes(), train)
    theta = fitted.theta.toArray()
    table = naive_bayes.fit(corpus.train, corpus.rows("train", "Count")).join(corpus.vocab, "term").collect()
    assert len(table) == corpus.size
    for row in table:
        assert abs(row.log_negative - theta[0][row.idx]) < 1e-9 and abs(row.log_positive - theta[2][row.idx]) < 1e-9
    # The library also smooths the class priors, so only the term likelihoods must be equal.
    ours = {r.review_id: r for r in training.naive_bayes_scores(corpus).collect()}
    assert len(ours) == models.as_predictions(fitted.transform(test)).count()
    assert all(abs(r.prob_negative + r.prob_neutral + r.prob_positive - 1) < 1e-5 for r in ours.values())


def test_split_is_whole_and_disjoint(corpus):
    train, test = corpus.train.select("review_id"), corpus.test.select("review_id")
    assert train.join(test, "review_id").count() == 0 and train.count() + test.count() == 87


def test_forest_and_evaluator(corpus):
    train, test = training.ml_tables(corpus, "TF-IDF")
    fitted = training.fit_family("Random Forest", models.random_forest(5, 4), train)
    predicted = fitted.transform(test)
    table = metrics.confusion_matrix(models.as_predictions(predicted))
    assert table.agg(F.sum("n")).first()[0] == corpus.test.count()
    assert training.top_importances(fitted, corpus.vocab).count() <= 20
