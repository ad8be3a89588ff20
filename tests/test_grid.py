"""Grid searches over all rows, and the confusion matrix of their best model."""

from starlens.checks import queries
from starlens.constants import SENTIMENTS
from starlens.operators import models, sampling
from starlens.plans import training
from starlens.sources.reviews import labelled_reviews


def test_bounded_rows_keep_every_class(spark):
    rows = spark.createDataFrame([(i, "Neutral" if i < 3 else "Negative" if i < 100 else "Positive") for i in range(1000)], "review_id long, sentiment string")
    assert training.bounded_rows(rows, 1000).count() == 1000
    sizes = {x["sentiment"]: x["count"] for x in training.bounded_rows(rows, 100).groupBy("sentiment").count().collect()}
    assert sizes == {"Neutral": 1, "Negative": 10, "Positive": 90}


def test_grid_has_point_score_and_whole_matrix(spark, tables):
    corpus = training.prepare(labelled_reviews(spark, tables))
    train, test = training.ml_tables(corpus, "TF-IDF")
    assert queries.GRID_ROWS >= 1000 and queries.FIT_ROWS >= 1000
    folded = sampling.cross_folds(training.training_weights(training.bounded_rows(train, queries.GRID_ROWS), "boosted")).cache()
    assert folded.count() == corpus.train.count()
    cells = {f"n_{a}_{b}".lower() for a in SENTIMENTS for b in SENTIMENTS}
    forest = models.forest_grid(folded, trees=(2,), depths=(2, 3), splits=(2,), leaves=(1,))
    boosted = models.boosted_grid(folded, rounds=(1, 2), depths=(2,), rates=(0.5,), by_level=False)
    for result, names in ((forest, {"trees", "depth", "least_split", "least_leaf"}), (boosted, {"rounds", "depth", "rate"})):
        found = {x["name"]: x["value"] for x in queries.grid_result(result, test).collect()}
        assert set(found) == cells | names | {"f1_macro"}
        assert sum(found[c] for c in cells) == test.count() == corpus.test.count()


def test_families_are_compared_in_order(spark, tables, monkeypatch):
    """Both vectorizers, small learners in the places of the large ones."""
    small = {"Naive Bayes": models.naive_bayes(), "Random Forest": models.Forest(3, 2), "XGBoost": models.Boosted(2, 2, 0.5), "Gradient Boosting": models.Boosted(1, 2, 0.5, second_order=False)}
    monkeypatch.setattr(training, "model_families", lambda rows: small)
    corpus = training.prepare(labelled_reviews(spark, tables))
    out = training.compare_models(corpus, fit_rows=60).orderBy("ordinal").collect()
    assert [(r.vectorizer, r.model) for r in out] == [(v, m) for v in training.VECTORIZERS for m in small]
    assert all(0 <= r.accuracy <= 1 and 0 <= r.f1_macro <= 1 for r in out)
