"""Hard negatives against all products, and intervals against exact products."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starlens.llm import negatives as hn
from starlens.llm import queries


def brute(rows, is_anchor, scale=256.0, positives=5, negatives=10):
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            row = (label, [max(-(1 << 63), min((1 << 63) - 1, math.floor(scale * x))) for x in v])
            known[i] = min(known.get(i, row), row)
    out = []
    clip = lambda s: max(1 - (1 << 63), min((1 << 63) - 1, s))
    for a, (label, v) in known.items():
        if is_anchor(a):
            score = {i: clip(sum(x * y for x, y in zip(v, w))) for i, (_, w) in known.items() if i != a and len(w) == len(v)}
            first = lambda ids, n: sorted(ids, key=lambda i: (-score[i], i))[:n]  # noqa: B023, E731
            for p in first([i for i in score if known[i][0] == label], positives):
                fit = [i for i in score if known[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
                out += [(a, p, n, i, score[p], score[i]) for n, i in enumerate(first(fit, negatives), 1)]
    return sorted(out)


def sample(count, width, clusters, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, width))
    return [(i, [float(np.float32(x)) for x in np.round(0.1 * (centres[i % clusters] + draw.normal(size=width)), 2)], int(i % clusters)) for i in range(count)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, width int, `group` string")


ODD = [(1000, None, 1), (1001, [], 1), (1002, [float("nan")] * 16, 2), (1003, [None] + [0.1] * 15, 1), (1100, [float("inf")] * 16, 1), (None, [0.1] * 16, 1), (1200, [0.5, 0.5], 1), (1201, [0.25, 0.5], 1),
       (1202, [0.25, 0.25], 2), (1300, [0.3] * 16, None), (1400, [0.0] * 16, 1), (1401, [0.0] * 16, 2), (1402, [0.0] * 16, 1)]


@pytest.mark.parametrize("values", [(1 << 20, 1 << 17), (16 * 50, 16 * 3)])
def test_against_all_products(spark, values):
    rows = sample(900, 16, 4, 1)
    rows += [(i, rows[7][1], 3 + i % 2) for i in range(900, 960)] + [rows[5], rows[100], (100, [0.2] * 16, 9)] + ODD  # ties, repeated rows, two rows of one key
    out = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, candidate_values=values[0], anchor_values=values[1])
    got = sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    want = brute(rows, lambda i: i % 50 == 0)
    assert len(want) > 300 and got == want


def test_values_beyond_floats(spark):
    rows = [(i, [float(np.float32(x * 10.0 ** (i % 5 * 9))) for x in v], label) for i, v, label in sample(200, 16, 3, 2)]
    out = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, out.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_nothing_and_few(spark):
    empty = frame(spark, sample(5, 16, 2, 3)).where("vec_id > 10")
    assert hn.hard_negatives(empty, F.col("vec_id") % 2 == 0).count() == 0
    one_label = frame(spark, [(i, v, 1) for i, v, _ in sample(40, 16, 2, 3)])
    assert hn.hard_negatives(one_label, F.col("vec_id") % 10 == 0).count() == 0
    no_anchor = frame(spark, sample(40, 16, 2, 3))
    assert hn.hard_negatives(no_anchor, F.col("vec_id") < 0).count() == 0


def test_intervals_hold_and_prune():
    """Exact products lie in their intervals, and in tight clusters few rows are left to multiply."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(8, 32))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    v = np.floor(256 * (centres[np.arange(4000) % 8] + 0.02 * draw.normal(size=(4000, 32)))).astype(np.int64)
    v[0] = 0
    v[1] = v[9]
    norm = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    angles = np.arccos(np.clip(hn.unit(v.astype(float)) @ centres.T, -1, 1))
    table = pa.table({"key": np.arange(4000), "label": np.arange(4000) % 8, "norm": norm, "width": np.full(4000, 32), "v": list(v), "angles": list(angles)})
    side = hn.Side(table)
    least, most = hn.bounds(side, np.arange(40), side)
    exact = v[:40] @ v.T
    assert (least <= exact).all() and (exact <= most).all()
    best = np.partition(exact, -5, axis=1)[:, -5]
    assert (most >= best[:, None]).mean() < 0.3


def test_query_against_sql(spark, tables):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tables}/embeddings.parquet'")
    got = queries.op13_hard_negatives(spark, tables)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.HARD_NEGATIVES_SQL})").fetchall()
    assert want and sorted(map(tuple, got.collect())) == sorted(want)
