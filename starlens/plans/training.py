"""From rated reviews to compared models."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.constants import NEUTRAL_BOOST, NEUTRAL_REBOOST, VOCABULARY_SIZE
from starlens.functions.labels import label_code
from starlens.operators import naive_bayes
from starlens.operators.ensembles import TASK_ROWS
from starlens.operators.features import feature_rows, ml_vectors, vocabulary, with_terms
from starlens.operators.filters import usable, with_processed_tokens, with_sentiment
from starlens.operators.metrics import summary_metrics
from starlens.operators.models import WEIGHTING, Boosted, Forest, as_predictions, fit_tables, model_families, training_table
from starlens.operators.sampling import class_weights, quota_cut, stratified_split, with_copies, within_cut
from starlens.session import stage

VECTORIZERS = ("Count", "TF-IDF")


def review_terms(reviews: DataFrame) -> DataFrame:
    """``review_id, sentiment, terms`` of the reviews that can be used."""
    ready = with_processed_tokens(usable(with_sentiment(reviews)))
    return with_terms(ready.select("review_id", "sentiment", "tokens"))


@dataclass
class Corpus:
    """Staged train and test documents and the vocabulary of the train part."""

    train: DataFrame  # review_id, sentiment, copies, terms
    test: DataFrame  # review_id, sentiment, terms
    vocab: DataFrame
    size: int

    def rows(self, part: str, kind: str) -> DataFrame:
        return feature_rows(getattr(self, part), self.vocab, kind, self.size)


def prepare(reviews: DataFrame, size: int = VOCABULARY_SIZE) -> Corpus:
    """Process the texts once, stage them, split, and learn the vocabulary on train only.

    The texts are the only large thing; split, copies, vocabulary and every fit
    read the staged terms.
    """
    documents = stratified_split(stage(review_terms(reviews), "terms"))
    train = with_copies(documents.where(F.col("split") == "train").drop("split"))
    test = documents.where(F.col("split") == "test").drop("split")
    vocab = stage(vocabulary(train, size), "vocabulary")
    # The true number of terms: model smoothing depends on it, and it may be below the limit.
    return Corpus(train, test, vocab, vocab.count())


# Models with a relational form: name, and the weight of Neutral rows.
RELATIONAL = {
    "Naive Bayes": 1.0, "Naive Bayes boosted": NEUTRAL_BOOST, "Naive Bayes reboosted": NEUTRAL_BOOST * NEUTRAL_REBOOST,
}
MODEL_KEYS = ("vectorizer", "model", "ordinal")


def naive_bayes_scores(corpus: Corpus, kind: str = "Count", boosts: dict[str, float] | None = None) -> DataFrame:
    """Scored test rows of the relational naive Bayes, for one or several boosts of the Neutral class."""
    model = naive_bayes.fit(corpus.train, corpus.rows("train", kind), boosts)
    scored = naive_bayes.predict(corpus.test, corpus.rows("test", kind), model, size=corpus.size * len(boosts or "1"))
    return scored if boosts else scored.drop("model")


def relational_metrics(corpus: Corpus, models: dict[str, float] = RELATIONAL) -> DataFrame:
    """Metrics of the relational models for both vectorizers: one fit and one scoring pass for each vectorizer."""
    names = list(models)
    frames = []
    for v, vectorizer in enumerate(VECTORIZERS):
        scored = naive_bayes_scores(corpus, vectorizer, models)
        place = F.array_position(F.array(*map(F.lit, names)), F.col("model")) - 1 + v * len(names)
        frames.append(scored.select(
            F.lit(vectorizer).alias("vectorizer"), "model", place.cast("int").alias("ordinal"), "actual",
            F.col("sentiment").alias("predicted"),
        ))
    return summary_metrics(reduce(DataFrame.unionByName, frames), MODEL_KEYS)


def training_weights(train: DataFrame, mode: str, boost: float = NEUTRAL_BOOST) -> DataFrame:
    """Add ``weight``: copies, times the balanced (or boosted) class weight of the over-sampled set."""
    if mode == "copies":
        return train.withColumn("weight", F.col("copies").cast("double"))
    if mode == "boosted":
        # The boosted weights are those of the set before over-sampling.
        weights = class_weights(train, boost).select("sentiment", F.col("weight").alias("w"))
    else:
        sizes = train.groupBy("sentiment").agg(F.sum("copies").alias("n"))
        classes = Window.partitionBy(F.lit(1))  # one row per class
        balanced = F.sum("n").over(classes) / (F.count("*").over(classes) * F.col("n"))
        weights = sizes.select("sentiment", balanced.alias("w"))
    return train.join(F.broadcast(weights), "sentiment").withColumn("weight", F.col("copies") * F.col("w")).drop("w")


def ml_tables(corpus: Corpus, kind: str) -> tuple[DataFrame, DataFrame]:
    """Train and test tables with ``label`` and a vector column, staged once for all fits."""
    tables = []
    for part in ("train", "test"):
        documents = getattr(corpus, part)
        vectors = ml_vectors(documents, corpus.rows(part, kind), corpus.size, f"vectors-{part}")
        tables.append(vectors.withColumn("label", label_code(F.col("sentiment")).cast("double")))
    return tables[0], tables[1]


def fit_family(name: str, estimator, train: DataFrame, boost: float = NEUTRAL_BOOST):
    return estimator.fit(training_weights(train, WEIGHTING[name], boost))


def bounded_rows(train: DataFrame, limit: int | None, label: str = "sentiment", row_id: str = "review_id") -> DataFrame:
    """At most ``limit`` training rows and one a class, the same share of every class, rounded up; all of them without a limit or if they are fewer."""
    total = train.count() if limit is not None else 0
    if limit is None or total <= limit:
        return train
    cuts = quota_cut(train, label, lambda n: F.ceil(n * F.lit(limit) / F.lit(total)), row_id)
    return train.where(within_cut(cuts, F.col(label), F.col(row_id)))


def compare_models(corpus: Corpus, names=None, fit_rows: int | None = None, parallelism: int = 6) -> DataFrame:
    """Metrics of all families (or those in ``names``) with both vectorizers.

    The models are fitted on all labelled rows, or on ``fit_rows`` of them if the caller says so; every
    model has its full number of trees, rounds and iterations. Trees read one
    binned table per vectorizer; if a task may hold the rows, tasks grow
    whole trees, and the boosted models of both vectorizers grow side by side. ``parallelism`` fits run at
    once, as their many small jobs leave most of a cluster idle; forests follow when these are done.

    The metrics of all models come from one aggregation over the union of their
    predictions.
    """
    tables, single, jobs = [], {}, []
    for v, vectorizer in enumerate(VECTORIZERS):
        train, test = ml_tables(corpus, vectorizer)
        train = bounded_rows(train, fit_rows)
        tables.append(test)
        families = {n: f for n, f in model_families(train.count()).items() if names is None or n in names}
        grown = {n: f for n, f in families.items() if isinstance(f, (Boosted, Forest))}
        if grown:
            table = training_table(training_weights(train, "boosted"))
            jobs += [((v, name), table, family) for name, family in grown.items()]
        single |= {(v, name): partial(fit_family, name, family, train) for name, family in families.items() if name not in grown}
    by_level = any(table.rows > TASK_ROWS for _, table, _ in jobs)
    boosted = [job for job in jobs if isinstance(job[2], Boosted)]
    forests = {place: partial(replace(family, by_level=by_level).fit_table, table) for place, table, family in jobs if isinstance(family, Forest)}
    spark = corpus.vocab.sparkSession
    with ThreadPool(parallelism) as pool:
        together = pool.apply_async(inheritable_thread_target(spark)(lambda: fit_tables([(table, family) for _, table, family in boosted], by_level)))
        # Forests come last: their long tasks would keep the many short jobs of the others waiting.
        fitted = {}
        for some in (single, forests):
            fitted |= dict(zip(some, pool.map(inheritable_thread_target(spark)(lambda fit: fit()), some.values(), chunksize=1), strict=True))
        fitted |= {place: model for (place, _, _), model in zip(boosted, together.get(), strict=True)}
    frames, order = [], list(WEIGHTING)
    for (v, name), model in sorted(fitted.items(), key=lambda x: (x[0][0], order.index(x[0][1]))):
        ordinal = v * len(order) + order.index(name)
        frames.append(as_predictions(model.transform(tables[v])).select(
            F.lit(VECTORIZERS[v]).alias("vectorizer"), F.lit(name).alias("model"), F.lit(ordinal).alias("ordinal"), "actual", "predicted",
        ))
    return summary_metrics(reduce(DataFrame.unionByName, frames), MODEL_KEYS)


def top_importances(model, vocab: DataFrame, n: int = 20) -> DataFrame:
    """The most important terms of a fitted forest; the list is bounded by the vocabulary."""
    weights = model.featureImportances
    pairs = [(int(i), float(w)) for i, w in zip(weights.indices, weights.values)]
    table = vocab.sparkSession.createDataFrame(pairs, "idx bigint, importance double")
    return table.join(vocab, "idx").orderBy(F.desc("importance"), "term").limit(n).select("term", "importance")
