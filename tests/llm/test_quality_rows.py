"""The quality model learns from every labelled row, whatever the number of groups they are held in."""

import numpy as np
import pyarrow as pa

from starlens.llm import quality as q


def test_statistics_and_cut_are_those_of_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(q, "GROUP_ROWS", 40)
    draw = np.random.default_rng(1)
    words = ["alpha", "Beta", "gamma,", "delta.", "EPS", "12", "!!", "zeta zeta"]
    rows = [(i, " ".join(draw.choice(words, draw.integers(1, 30), p=np.roll([0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05], i % 3))), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = q.fit_quality(docs, labels)
    x, y = q.features(pa.array([r[1] for r in rows])), np.array([r[2] for r in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, np.maximum(x.std(axis=0), 1e-6))
    rank = model.rank(x)
    cuts = np.quantile(rank, np.linspace(0.002, 0.998, 499))
    right = [np.mean(rank[y == 1] >= c) + np.mean(rank[y == 0] < c) for c in cuts]
    assert np.isclose(model.cut, cuts[np.flatnonzero(right >= max(right) - 1e-9)].mean())
    assert rank[y == 1].mean() > rank[y == 0].mean()
