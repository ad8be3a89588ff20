"""Shared pieces of the corpus operators: labelled rows, logistic fits, staging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.session import stage

#: Labelled rows that a fit uses at most, on average; 12 bytes each when sent to the executors.
LABELLED_ROWS = 200_000
#: Rows of texts that a worker is given at once.
BATCH_ROWS = 1_000
#: Rows up to which a table of a few numbers a row is sent to all executors.
SMALL_ROWS = 100_000


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most ``BATCH_ROWS`` rows, so that those of long texts fit the workers; lasts for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def known(df: DataFrame, text: str = "text") -> DataFrame:
    """Null texts as empty ones."""
    return df.withColumn(text, F.coalesce(F.col(text), F.lit("")))


def labelled_rows(labels: DataFrame, key: str, label: str, use: Column) -> DataFrame:
    """One row per labelled key with the label 0 or 1; keys or labels that are null are left out, of several labels the largest counts."""
    return (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & use)
        .groupBy(F.col(key).alias("labelled_key")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
    )


def label_sample(labels: DataFrame, key: str, label: str, use: Column, limit: int = LABELLED_ROWS) -> DataFrame:
    """One row per labelled key with the label 0 or 1, a hash sample of about ``limit`` rows at most.

    Keys or labels that are null are left out; of several labels the largest counts.
    """
    rows = labelled_rows(labels, key, label, use)
    slots = 1 << 20
    share = min(slots, slots * limit // max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("labelled_key", F.lit("labelled")), F.lit(slots)) < share)


def with_labels(docs: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """The documents with their label or null; the sample is bounded, so it goes to the documents."""
    return docs.join(F.broadcast(sample), docs[key] == sample["labelled_key"], "left").drop("labelled_key")


def per_slice(slice_rows: Callable[[pa.Array], Iterator[tuple[int, int]]], run: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text"):
    """A function for ``mapInArrow`` that runs on parts of a batch with a bounded amount of text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slice_rows(batch[text]):
                out = run(batch.slice(low, high - low))
                if out.num_rows:
                    yield out

    return each


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression with an intercept first, by damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * penalty @ (v * v))

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-9 * max(1.0, abs(before)):
            break
    return w


def newton(total: Callable[[Callable], np.ndarray], width: int, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """As ``logistic_fit`` on rows that tasks hold: ``total`` adds up, over all of them, what the function that it is given makes of (x, y)."""
    penalty = np.full(width + 1, ridge)
    penalty[0] = 1e-6

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            x = np.column_stack([np.ones(len(x)), x])
            z = x @ w
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            return np.concatenate([[(np.logaddexp(0, z) - y * z).sum()], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])

        found = total(sums)
        k = len(w)
        return float(found[0] + 0.5 * penalty @ (w * w)), found[1 : k + 1] + penalty * w, found[k + 1 :].reshape(k, k) + np.diag(penalty)

    w = np.zeros(width + 1)
    now, gradient, curve = at(w)
    for _ in range(steps):
        step, size = np.linalg.solve(curve, gradient), 1.0
        after = at(w - step)
        while size > 1e-4 and after[0] > now:
            size /= 2
            after = at(w - size * step)
        w, before = w - size * step, now
        now, gradient, curve = after
        if before - now < 1e-9 * max(1.0, abs(before)):
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def sized(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A staged table of few numbers a row: marked for broadcast if it has at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


class Memory:
    """What a worker knows by key, in two generations: when the younger is full, the older is forgotten, so frequent keys stay."""

    def __init__(self, limit: int):
        self.limit = limit
        self.known: dict = {}
        self.older: dict = {}

    def missing(self, wanted: set) -> list:
        """Those of ``wanted`` that are not known; afterwards all others are in ``known``, until ``turn``."""
        new = wanted.difference(self.known)
        fresh = new.difference(self.older)
        for key in new.difference(fresh):
            self.known[key] = self.older[key]
        return list(fresh)

    def turn(self) -> None:
        """Call between batches: forget the older generation if the younger is full."""
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id", text: str = "text", name: str = "dropped") -> DataFrame:
    """The documents whose (key, xxhash64 of the text) is not in ``dropped`` (key, text_hash); null keys match null keys."""
    out = stage(dropped.select(F.col(key).alias("dropped_key"), F.col("text_hash").alias("dropped_hash")).distinct(), name)
    out = sized(out)
    return docs.join(out, docs[key].eqNullSafe(out["dropped_key"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == out["dropped_hash"]), "left_anti")
