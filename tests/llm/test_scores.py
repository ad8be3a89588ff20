"""Toxicity and quality."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starlens.llm import quality as q
from starlens.llm import toxicity as t

COMMON = [f"word{i}" for i in range(40)]
TOXIC = ["trashy", "scummy", "vilest"]


def brute_segments(x):
    """All maximal segments by their definition: best segment first, then left and right of it."""
    best, at = 0.0, None
    for i in range(len(x)):
        total = 0.0
        for j in range(i, len(x)):
            total += x[j]
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    left = [(a, b) for a, b in brute_segments(x[: at[0]])]
    return [*left, at, *((a + at[1], b + at[1]) for a, b in brute_segments(x[at[1] :]))]


def test_maximal_segments_follow_their_definition():
    draw = random.Random(3)
    for _ in range(400):
        x = np.array([draw.choice([-3, -2, -1.5, -1, 1, 2, 4]) + draw.random() / 1000 for _ in range(draw.randint(0, 25))])
        found = t.maximal_segments(x)
        assert [(a, b) for a, b, _ in found] == brute_segments(x.tolist())
        assert all(abs(s - x[a:b].sum()) < 1e-9 for a, b, s in found)


def test_decay_solves_its_equation():
    values, counts = np.array([-1.0, 2.0]), np.array([9.0, 1.0])
    x = t.decay_of(values, counts)
    assert x > 0 and abs(0.9 * np.exp(-x) + 0.1 * np.exp(2 * x) - 1) < 1e-6
    assert t.decay_of(np.array([-1.0]), np.array([5.0])) == 0.0


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = draw.choices(COMMON, k=draw.randint(20, 60))
        if i % 5 == 0:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(TOXIC))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_toxicity(spark, table, corpus):
    rows, labels = corpus
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (0, 0)], "doc_id long, toxic int")  # the larger label of document 0 counts
    docs = table([*rows, (500, None), (501, ""), (502, "only trashy"), (None, "word1 word2"), (7, rows[7][1])])
    model = t.fit_toxicity(docs, marks, use=F.col("doc_id") % 4 != 0)
    out = t.toxic_passages(docs, model).collect()
    assert len(out) == 405 and {"label", "score", "bucket", "t", "k"} < set(out[0].asDict())
    for x in out:
        assert 0 <= x["toxic_score"] <= 1
        if x["doc_id"] is not None and x["doc_id"] < 400:
            assert (x["toxic_score"] >= 0.5) == (x["doc_id"] % 5 == 0), x
        for p in x["toxic_passages"]:
            assert x["text"].encode()[p["begin"] : p["end"]].decode() == p["passage"]
            assert p["passage"].split()[0] in TOXIC and p["passage"].split()[-1] in TOXIC
    by = {x["doc_id"]: x for x in out}
    assert by[500]["toxic_score"] == by[501]["toxic_score"] < 0.5 and by[500]["toxic_passages"] == []
    assert by[502]["toxic_score"] >= 0.5
    twice = [x["toxic_score"] for x in out if x["doc_id"] == 7]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_toxicity_without_labels_or_rows(spark, table):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = table([(1, "a b"), (2, None)])
    model = t.fit_toxicity(docs, none)
    assert all(x["toxic_score"] < 0.5 for x in t.toxic_passages(docs, model).collect())
    assert t.toxic_passages(table([]), t.fit_toxicity(table([]), none)).count() == 0


def test_quality(spark, table):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        words = draw.choices(COMMON, k=60)
        good = i % 4 != 0
        rows.append((i, ". ".join([" ".join(words[:20]), " ".join(words[20:])]) + "." if good else draw.choice([" ".join(words[:1] * 60), "###".join(words), " ".join(words).upper()])))
        labels.append((i, int(good)))
    docs = table([*rows, (400, None), (401, ""), (402, "x" * 5000), (5, rows[5][1])])
    model = q.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), use=F.col("doc_id") % 3 != 0)
    out = q.quality_scores(docs, model).collect()
    assert len(out) == 304
    wrong = [x["doc_id"] for x in out if x["doc_id"] < 300 and (x["quality_score"] >= q.THRESHOLD) != (x["doc_id"] % 4 != 0)]
    assert len(wrong) <= 3
    assert all(0 <= x["quality_score"] <= 1 for x in out)
    assert len({x["quality_score"] for x in out if x["doc_id"] in (400, 401)}) == 1
    none = q.fit_quality(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {round(x["quality_score"], 6) for x in q.quality_scores(docs, none).collect()} == {q.THRESHOLD}
    assert q.quality_scores(table([]), model).count() == 0


def test_bradley_terry_weights_order_the_pairs():
    draw = np.random.default_rng(6)
    good, bad = draw.normal(1, 1, (200, 3)), draw.normal(0, 1, (40, 3))
    w = q.preferences(good, bad)
    assert (good @ w).mean() > (bad @ w).mean() and (w > 0).all()


def test_features_of_odd_texts():
    x = q.features(pa.array([None, "", "\n\n\n", "###", "a", "é" * 10, "a b\n" * 1000]))
    assert np.isfinite(x).all() and (x[0] == x[1]).all()
