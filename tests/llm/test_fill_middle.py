"""Wavelet matrix against counting, cuts against slicing, forms against the plain rule."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlens.llm import fill_middle as fm

TEXTS = [(1, "naïve 😀 text\nof two lines "), (2, None), (3, ""), (4, "has <P> inside"), (5, " \n\n"), (6, "<S"), (7, "ab" * 40), (8, "éé 中文字 <"), (9, "x"), (9, "x"), (None, "no key at all")]


def test_ranks_and_selects_against_counting():
    draw = np.random.default_rng(3)
    for length in (0, 1, 63, 64, 65, 1000):
        symbols = draw.integers(0, 8, length).astype(np.uint8)
        matrix = fm.WaveletMatrix(symbols)
        ends = np.sort(draw.integers(0, length + 1, (40, 2)), axis=1)
        for wanted in [*fm.UNITS.values(), (0,), (3, 4), (0, 7), tuple(range(8)), ()]:
            held = np.isin(symbols, wanted)
            want = [int(held[a:b].sum()) for a, b in ends]
            assert matrix.rank(wanted, ends[:, 0], ends[:, 1]).tolist() == want
            for k in (1, 2, 9):
                place = [next((e for e in range(a, b + 1) if held[a:e].sum() >= k), b) for a, b in ends]
                assert matrix.select(wanted, ends[:, 0], ends[:, 1], np.full(40, k)).tolist() == place


def parts(text, i, j, unit):
    """Three parts by plain slicing."""
    if unit == "character":
        edges = list(range(len(text) + 1))
    elif unit == "line":
        edges = [0] + [k + 1 for k, c in enumerate(text) if c == "\n"]
    else:
        blank = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
        edges = [k for k, c in enumerate(text) if c not in blank and (k == 0 or text[k - 1] in blank)] + [len(text)]
    n = len(edges) - 1
    a, b = sorted((i % (n + 1), j % (n + 1)))
    return n, text[: edges[a]], text[edges[a] : edges[b]], text[edges[b] :]


@pytest.mark.parametrize("unit", list(fm.UNITS))
def test_cuts_against_slicing(spark, table, unit):
    draw = random.Random(unit)
    rows = TEXTS + [(100 + i, "".join(draw.choices("ab 1.\n\té中😀", k=draw.randrange(200)))) for i in range(150)] + [(400, "é wörd\n" * 60_000)]
    docs = table(rows).withColumn("n", F.lit("clash")).withColumn("prefix", F.lit(1)).repartition(2)
    out = fm.split_texts(docs, F.col("doc_id") * 7919, F.col("doc_id") * 104729, unit=unit).collect()
    assert len(out) == len(rows)
    for r in out:
        i = r.doc_id or 0
        n, a, b, c = parts(r.text, i * 7919, i * 104729, unit)
        assert (r.n, r.prefix, r.middle, r.suffix) == (n, a, b, c)
        assert (r.prefix_chars, r.middle_chars, r.label) == (len(a), len(b), "x")


def test_forms_and_way_back(spark, table):
    rows = TEXTS + [(i, f"text <{i}> é" * (i % 5)) for i in range(100, 500)]
    made = fm.fill_in_middle(table(rows))
    out = made.withColumn("back", fm.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows) and {r.form for r in out} == {"plain", "psm", "spm"}
    for r in out:
        text = r.text
        digits = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
        n = len(text)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        if not text or any(x in text for x in fm.SENTINELS) or h3 % 100 >= 90:
            want = ("plain", text)
        elif h4 % 100 < 20:
            want = ("spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}")
        else:
            want = ("psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}")
        assert (r.form, r.output) == want and r.back == text
    assert fm.fill_in_middle(table(rows).where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        fm.restored(F.col("output"), F.col("form"), ("<P>", "aba", "<M>"))


def test_query_against_sql(spark, tables):
    import duckdb

    from starlens.llm import queries

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    got = queries.op12_fill_in_middle(spark, tables)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.FILL_IN_MIDDLE_SQL})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
