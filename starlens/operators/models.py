"""Classifier families with the parameters of the comparison: MLlib's where it has the method, else the trees and machines of this package."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.constants import MAX_DOCUMENT_SHARE, MIN_DOCUMENTS, SEED, SENTIMENTS, VOCABULARY_SIZE
from starlens.functions.labels import label_name
from starlens.functions.text import ngrams, processed_tokens
from starlens.operators.ensembles import BoostedModel, Boosting, FirstOrder, Fit, ForestModel, Gini, SecondOrder, boost, boost_side_by_side, forest, forest_side_by_side, votes_side_by_side
from starlens.operators.metrics import summary_metrics
from starlens.operators.svm import LinearSvm
from starlens.operators.trees import Binned, Block, binned
from starlens.session import received, sent

COLUMNS = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
#: Rows of texts that a task holds as lists of terms, about 40 kB each, and their characters, about 12 bytes each.
PART_ROWS, PART_CHARS = 5_000, 1 << 24
#: More levels than any tree has.
ANY_DEPTH = 1 << 30


def naive_bayes():
    return NaiveBayes(modelType="multinomial", smoothing=1.0, **COLUMNS)


def logistic_regression(rows: int, iterations: int = 1000):
    """Multinomial regression; weighted rows make its loss the class-weighted cross-entropy."""
    return LogisticRegression(family="multinomial", maxIter=iterations, regParam=1.0 / max(rows, 1),
                              standardization=False, **COLUMNS)


def linear_svm() -> LinearSvm:
    return LinearSvm()


def training_table(train: DataFrame) -> Binned:
    """The binned form of rows with ``review_id, label, features`` and, if they are there, ``copies``, ``weight`` and ``fold``."""
    have = lambda name: F.col(name) if name in train.columns else F.lit(1)
    fold = [F.col("fold")] if "fold" in train.columns else []
    return binned(train.select(
        F.xxhash64("review_id").alias("key"), F.col("label").cast("int").alias("label"), have("copies").cast("int").alias("copies"),
        have("weight").cast("double").alias("weight"), "features", *fold,
    ))


@dataclass(frozen=True)
class Boosted:
    """Softmax boosting; ``second_order`` for gradients and Hessians with the rows' weights, else residuals with their copies.

    ``by_level`` grows on any number of rows with one job a level; without it a task grows the whole model, on at most ``ensembles.TASK_ROWS`` rows.
    """

    rounds: int
    depth: int
    rate: float
    second_order: bool = True
    by_level: bool = True

    def learner(self, table: Binned, fits: Sequence[Fit] = ()) -> Boosting:
        fits = fits or [Fit(self.depth, self.rate)]
        if self.second_order:
            return SecondOrder(fits, np.zeros(len(SENTIMENTS)))
        return FirstOrder(fits, np.log(np.maximum(table.copies / max(table.copies.sum(), 1), 1e-15)))

    def fit_table(self, table: Binned) -> BoostedModel:
        learner = self.learner(table)
        return (boost(table, learner, self.rounds) if self.by_level else boost_side_by_side([(table, learner, self.rounds)]))[0]

    def fit(self, train: DataFrame) -> BoostedModel:
        return self.fit_table(training_table(train))


def boosted_trees(rounds: int = 200, depth: int = 8, rate: float = 0.2) -> Boosted:
    return Boosted(rounds, depth, rate)


def gradient_boosting(rounds: int = 100, depth: int = 6, rate: float = 0.1) -> Boosted:
    return Boosted(rounds, depth, rate, second_order=False)


@dataclass(frozen=True)
class Forest:
    """Trees on bootstrap draws, or extremely randomised ones on all rows.

    Classes are balanced within each tree's draw, or weigh what the rows' ``weight`` says with ``row_weights``. ``by_level`` as for ``Boosted``.
    """

    trees: int
    depth: int = ANY_DEPTH
    least_split: int = 2
    least_leaf: int = 1
    extra: bool = False
    row_weights: bool = False
    by_level: bool = True

    def fit_table(self, table: Binned) -> ForestModel:
        weights = table.weights / np.maximum(table.copies, 1) if self.row_weights else None
        fits = [Fit(self.depth, least=self.least_leaf)] * self.trees
        learner = Gini(tree_seeds(self.trees), fits, not self.extra, self.extra, self.least_split)
        return (forest if self.by_level else forest_side_by_side)(table, learner, max(1, int(table.bins.size ** 0.5)), weights)

    def fit(self, train: DataFrame) -> ForestModel:
        return self.fit_table(training_table(train))


def tree_seeds(count: int) -> list[int]:
    return [SEED * 1_000_003 + i for i in range(count)]


def random_forest(trees: int = 400, depth: int | None = None) -> Forest:
    return Forest(trees, depth or ANY_DEPTH)


def extra_trees(trees: int = 100, depth: int = 10) -> Forest:
    return Forest(trees, depth, extra=True)


# Which row weight a model family trains with: plain copies of over-sampled rows, these times balanced class weights, or these times
# weights with the Neutral class boosted. Forests balance the copies themselves.
WEIGHTING = {
    "Naive Bayes": "copies", "Logistic Regression": "balanced", "SVM": "balanced", "Random Forest": "copies",
    "XGBoost": "boosted", "Gradient Boosting": "copies", "Extra Trees": "copies",
}


def model_families(rows: int) -> dict:
    """The seven families in training order, for a training set of so many rows."""
    return {
        "Naive Bayes": naive_bayes(),
        "Logistic Regression": logistic_regression(rows),
        "SVM": linear_svm(),
        "Random Forest": random_forest(),
        "XGBoost": boosted_trees(),
        "Gradient Boosting": gradient_boosting(),
        "Extra Trees": extra_trees(),
    }


def fit_tables(jobs: Sequence[tuple[Binned, Boosted | Forest]], by_level: bool = True) -> list:
    """Models of several families on binned tables, in order; without ``by_level`` tasks grow whole trees, the boosted ones side by side in one job."""
    models = {}
    if not by_level:
        places = [i for i, (_, family) in enumerate(jobs) if isinstance(family, Boosted)]
        if places:
            grown = boost_side_by_side([(jobs[i][0], jobs[i][1].learner(jobs[i][0]), jobs[i][1].rounds) for i in places])
            models = dict(zip(places, grown, strict=True))
    return [models[i] if i in models else replace(family, by_level=by_level).fit_table(table) for i, (table, family) in enumerate(jobs)]


def as_predictions(predicted: DataFrame) -> DataFrame:
    return predicted.select(
        "review_id", F.col("sentiment").alias("actual"), label_name(F.col("prediction")).alias("predicted")
    )


# --- grid searches ----------------------------------------------------------------------


@dataclass
class GridResult:
    """Mean macro F1 over the folds of each point, and the model of the best point on all rows (the first of equal scores)."""

    points: list[dict[str, float]]
    scores: list[float]
    model: object

    @property
    def best(self) -> int:
        return int(np.argmax(self.scores))

    def best_point(self) -> dict[str, float]:
        return self.points[self.best] | {"f1_macro": self.scores[self.best]}


def fold_scores(table: Binned, variants: dict[int, list]) -> list[float]:
    """Mean macro F1 of each point; ``variants`` has, for each held-out fold, one function from binned cells to classes for each point."""
    task = sent(table.blocks.sparkSession, (table.bins, variants))
    names = list(SENTIMENTS)

    def run(batches):
        bins, known = received(task)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, bins)
                cells = block.dense()
                for fold, points in known.items():
                    at = np.flatnonzero(block.fold == fold)
                    cache: dict = {}
                    for number, point in enumerate(points):
                        guess = point(cells[at], cache)
                        columns = [np.full(len(at), number), np.full(len(at), fold)]
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.array(c.astype(np.int32)) for c in columns), pa.array([names[k] for k in block.label[at]], pa.string()), pa.array([names[k] for k in guess], pa.string())],
                            names=["point", "fold", "actual", "predicted"],
                        )

    predictions = table.blocks.mapInArrow(run, "point int, fold int, actual string, predicted string")
    return mean_scores(predictions)


def mean_scores(predictions: DataFrame) -> list[float]:
    """Mean macro F1 over the folds of each point, by ``point, fold, actual, predicted``."""
    scores = summary_metrics(predictions, ("point", "fold")).groupBy("point").agg(F.avg("f1_macro").alias("score"))
    found = {row.point: row.score for row in scores.collect()}
    return [float(found[i]) for i in range(len(found))]


@dataclass
class StagedRounds:
    """Classes by a boosted model after some of its rounds."""

    model: BoostedModel
    rounds: int

    def __call__(self, cells: np.ndarray, cache: dict) -> np.ndarray:
        return self.model.probabilities(cells, self.rounds).argmax(axis=1)


@dataclass
class StagedForest:
    """Classes by the first trees of a forest, cut at a depth and a least number of rows to split; walks are shared between points."""

    name: tuple
    model: ForestModel
    trees: int
    depth: int

    def __call__(self, cells: np.ndarray, cache: dict) -> np.ndarray:
        walk = (*self.name, self.depth)
        if walk not in cache:
            cache[walk] = self.model.trees.value[self.model.trees.walk(cells, depth=self.depth)]
        return cache[walk][:, : self.trees].mean(axis=1).argmax(axis=1)


def boosted_grid(train: DataFrame, rounds: Sequence[int] = (100, 200), depths: Sequence[int] = (4, 6, 8), rates: Sequence[float] = (0.05, 0.1, 0.2), by_level: bool = True) -> GridResult:
    """All points over a given ``fold`` column: a fit of many rounds holds those of fewer, so there is one fit for each depth, rate and fold, all side by side on one binned table."""
    table = training_table(train)
    folds = [row.fold for row in train.select("fold").distinct().orderBy("fold").collect()]
    shapes = [(depth, rate) for depth in depths for rate in rates]
    family = Boosted(max(rounds), max(depths), max(rates), by_level=by_level)
    learner = family.learner(table, [Fit(depth, rate, fold) for depth, rate in shapes for fold in folds])
    models = boost(table, learner, max(rounds)) if by_level else boost_side_by_side([(table, learner, max(rounds))])
    points = [{"rounds": float(n), "depth": float(depth), "rate": float(rate)} for n in rounds for depth, rate in shapes]
    variants = {fold: [StagedRounds(models[i * len(folds) + f], n) for n in rounds for i in range(len(shapes))] for f, fold in enumerate(folds)}
    scores = fold_scores(table, variants)
    best = points[int(np.argmax(scores))]
    return GridResult(points, scores, replace(family, rounds=int(best["rounds"]), depth=int(best["depth"]), rate=best["rate"]).fit_table(table))


def forest_grid(train: DataFrame, trees: Sequence[int] = (200, 400), depths: Sequence[int | None] = (None, 20, 40), splits: Sequence[int] = (2, 5), leaves: Sequence[int] = (1, 2), by_level: bool = True) -> GridResult:
    """All points over a given ``fold`` column: smaller, shallower and earlier stopped forests are part of the largest, so all trees of all leaf sizes and folds grow in one set."""
    table = training_table(train)
    folds = [row.fold for row in train.select("fold").distinct().orderBy("fold").collect()]
    most = max(trees)
    shapes = [(leaf, fold) for leaf in leaves for fold in folds]
    features = max(1, int(table.bins.size ** 0.5))
    grid = [(n, depth or ANY_DEPTH, split, leaf) for n in trees for depth in depths for split in splits for leaf in leaves]
    points = [{"trees": float(n), "depth": float(0 if depth == ANY_DEPTH else depth), "least_split": float(split), "least_leaf": float(leaf)} for n, depth, split, leaf in grid]
    if by_level:
        fits = [Fit(ANY_DEPTH, fold=fold, least=leaf) for leaf, fold in shapes for _ in range(most)]
        whole = forest(table, Gini(tree_seeds(most) * len(shapes), fits, True, least_split=min(splits)), features)
        models = {}
        for i, shape in enumerate(shapes):
            part = ForestModel(whole.trees.part(np.arange(i * most, (i + 1) * most)), table.bins)
            models |= {(*shape, split): part.stopped(least_split=split).walkable() for split in splits}
        variants = {fold: [StagedForest((leaf, split), models[leaf, fold, split], n, depth) for n, depth, split, leaf in grid] for fold in folds}
        scores = fold_scores(table, variants)
    else:
        scores = forest_scores(table, shapes, grid, features, min(splits))
    n, depth, split, leaf = grid[int(np.argmax(scores))]
    return GridResult(points, scores, Forest(n, depth, split, leaf, by_level=by_level).fit_table(table))


def forest_scores(table: Binned, shapes: Sequence[tuple[int, int]], grid: Sequence[tuple[int, int, int, int]], features: int, least_split: int) -> list[float]:
    """Mean macro F1 of each point by votes that tasks add up; a shape is (least leaf, fold)."""
    most = max(point[0] for point in grid)
    learners = [Gini(tree_seeds(most), [Fit(ANY_DEPTH, fold=fold, least=leaf)] * most, True, least_split=least_split) for leaf, fold in shapes]
    staged = list(dict.fromkeys(point[:3] for point in grid))
    votes = votes_side_by_side(table, learners, features, staged)
    # (learner, point of the staged ones) to the point of the grid
    places = [(s, staged.index(point[:3]), number, fold) for number, point in enumerate(grid) for s, (leaf, fold) in enumerate(shapes) if leaf == point[3]]
    known = table.blocks.sparkSession.createDataFrame(places, "learner int, at int, number int, fold int").withColumnRenamed("learner", "of")
    return mean_scores(votes.join(F.broadcast(known), (F.col("learner") == F.col("of")) & (F.col("point") == F.col("at"))).select(
        F.col("number").alias("point"), "fold", label_name(F.col("label")).alias("actual"), label_name(F.col("guess")).alias("predicted")))


class ReviewTerms(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Raw text to its words and word pairs, as a stage that can be saved with a model."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), ngrams(processed_tokens(F.col(self.getInputCol()))))


def in_small_parts(rows: DataFrame, most: int = PART_ROWS, text: str | None = None, chars: int = PART_CHARS) -> DataFrame:
    """A staged table of texts in parts of about ``most`` rows and ``chars`` characters of ``text`` at most, as the vectorizer holds the term lists of a part; small tables stay as they are."""
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(text)) if text else F.lit(0), F.lit(0)).alias("chars")).first()
    parts = max(-(-size["n"] // most), -(-size["chars"] // chars))
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def review_model(classifier, size: int = VOCABULARY_SIZE, min_documents: float = MIN_DOCUMENTS) -> Pipeline:
    """Text processing, count vectorizer and classifier as one estimator."""
    return Pipeline(stages=[
        ReviewTerms(inputCol="text", outputCol="terms"),
        CountVectorizer(inputCol="terms", outputCol="features", vocabSize=size, minDF=float(min_documents),
                        maxDF=MAX_DOCUMENT_SHARE),
        classifier,
    ])
