"""Sentence weights and scores from blocks of sentences, against a plain computation."""

import math
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starlens.operators import summaries
from starlens.session import staging_root

SCHEMA = "category string, rating int, review_id bigint, pos int, sentence string"
NAMES = [f"word{i}" for i in range(40)]


def drawn(n, seed=1):
    rng = random.Random(seed)
    return [("ab"[i % 2], 1, i // 3, i % 3, " ".join(["common", *rng.choices(NAMES[: 3 + i % 37], k=rng.randint(0, 9))])) for i in range(n)]


def plain(rows):
    """Weights by (sentence, term) and the score of each sentence; rows of one id and place are one vector."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[:2]].append(row)
    weights, scores = {}, {}
    for group, own in groups.items():
        counted = [Counter(row[4].split()) for row in own]
        df, n = Counter(t for c in counted for t in c), len(own)
        vectors = defaultdict(list)
        for row, c in zip(own, counted):
            vectors[row[:4]] += [(t, k * (math.log((1 + n) / (1 + df[t])) + 1)) for t, k in c.items() if df[t] <= 0.9 * n]
        mean = Counter()
        for key, vector in vectors.items():
            length = math.sqrt(sum(w * w for _, w in vector))
            vectors[key] = [(t, w / length) for t, w in vector]
            for t, w in vectors[key]:
                mean[t] += w / n
        norm = math.sqrt(sum(m * m for m in mean.values()))
        for key, vector in vectors.items():
            weights[key] = sorted((t, round(w, 6)) for t, w in vector)
            scores[key] = sum(w * mean[t] for t, w in vector) / norm if vector else 0.0
    return {k: v for k, v in weights.items() if v}, scores


def some(spark, n):
    rows = drawn(n) + [("a", 1, 5, 0, "word1 word2 second text"), ("a", 1, 5, 0, "word2 third")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(params=[1, 60, 1 << 20])
def block_words(request, monkeypatch):
    monkeypatch.setattr(summaries.staged_blocks, "__defaults__", (summaries.GROUP, request.param))


def test_weights_and_scores_in_blocks_of_any_size(spark, block_words):
    rows, df = some(spark, 120)
    weights, scores = plain(rows)
    got = defaultdict(list)
    for x in summaries.sentence_tfidf(df).collect():
        got[x.category, x.rating, x.review_id, x.pos].append((x.term, round(x.weight, 6)))
    assert {k: sorted(v) for k, v in got.items()} == weights
    found = summaries.sentence_scores(df).collect()
    assert len(found) == len(rows)
    for x in found:
        assert abs(x.score - scores[x.category, x.rating, x.review_id, x.pos]) < 2e-6


def test_rows_without_group_or_id_have_no_score(spark):
    rows = [("a", 1, i, 0, f"word{i} word{i + 1}") for i in range(4)] + [(None, 1, 9, 0, "word1 word2"), ("a", 1, None, 0, "word1 word3")]
    got = {x.review_id: x.score for x in summaries.sentence_scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[9] == got[None] == 0.0 and all(got[i] > 0 for i in range(4))
    assert summaries.sentence_scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_groups_meet_by_terms_of_blocks_not_of_sentences(spark):
    # Once a row for each sentence and term was shuffled, several times.
    df = spark.createDataFrame(drawn(600), SCHEMA)
    blocks = summaries.staged_blocks(df)
    terms = summaries.term_idf(blocks).count()
    entries = blocks.where("slots is not null").agg(F.sum(F.size("slots"))).first()[0]
    assert entries > 2000 and terms < entries / 5


def test_texts_are_kept_once_and_blocks_are_dropped(spark):
    """What is staged or shuffled beside the sentences themselves has no texts, and blocks go when their products are known."""
    kept = lambda: {x for x in os.listdir(f"{staging_root(spark).removeprefix('file://')}/starlens") if x.startswith("sentence-blocks")}
    df = spark.createDataFrame(drawn(60), SCHEMA)
    assert "sentence" not in summaries.staged_blocks(df).columns
    before = kept()
    scores = summaries.sentence_scores(df)
    assert kept() == before and scores.count() == 60
