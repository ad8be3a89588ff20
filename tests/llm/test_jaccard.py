import random
import re

import numpy as np
import pytest

from starlens.llm import jaccard as j
from starlens.llm.components import components


def sets(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, threshold=0.8):
    """doc index -> (class as least id, links, copies)."""
    s = [sets(x) for _, x in rows]
    linked = [[b for b in range(len(rows)) if a != b and s[a] and s[b] and len(s[a] & s[b]) >= threshold * len(s[a] | s[b]) - 1e-9] for a in range(len(rows))]
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in linked[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((min(rows[b][0] for b in seen), len(linked[a]), sum(1 for b in linked[a] if rows[b][1] == rows[a][1])))
    return out


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    out = []
    for base in range(12):
        words = [f"b{base}w{draw.randrange(400)}" for _ in range(draw.choice([30, 120, 400]))]
        for _ in range(draw.randint(2, 9)):
            out.append(edited(draw, words, draw.choice([0, 0, 1, 2, 4, 8])))
    hot = [f"h{k}" for k in range(200)]
    out += [edited(draw, hot, draw.choice([0, 1, 2, 3])) for _ in range(80)]
    shared = " ".join(f"s{k}" for k in range(60))
    out += [shared + " " + " ".join(f"own{i}x{k}" for k in range(60)) for i in range(30)]
    out += ["", None, "###", "###", "one two", "One, two", "one two three", "x " * 3000]
    draw.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("blocks", [(2048, 1024), (7, 5)])
def test_links_and_classes_against_all_pairs(table, rows, monkeypatch, blocks):
    monkeypatch.setattr(j, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(j, "GROUP_BLOCK", blocks[1])
    monkeypatch.setattr(j, "FEW", 20)
    found = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in j.near_duplicates(table(rows)).collect()}
    assert found == {i: x[:2] for (i, _), x in zip(rows, brute(rows))}


def test_copies_repeated_rows_and_nulls(table):
    text = "a b c d e f g"
    rows = [(3, text), (3, text), (1, text), (9, None), (8, ""), (None, "p q r s t u"), (5, "p q r s t u"), (6, "alone in all this here now")]
    out = sorted(((x["doc_id"] is None, x["doc_id"] or 0, x["class_id"], x["n_links"], x["n_copies"]) for x in j.near_duplicates(table(rows)).collect()))
    assert out == [(False, 1, 1, 2, 2), (False, 3, 1, 2, 2), (False, 3, 1, 2, 2), (False, 5, 5, 1, 1), (False, 6, 6, 0, 0), (False, 8, 8, 0, 0), (False, 9, 9, 0, 0), (True, 0, 5, 1, 1)]
    assert j.near_duplicates(table([])).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = j.least_matches()
    assert least == sorted(least) and least[0] < 0.8 * j.STEP
    draw = np.random.default_rng(9)
    a = draw.integers(0, 65536, (5000, j.HASHES), dtype=np.uint16)
    b = np.where(draw.random(a.shape) < 0.8, a, a + np.uint16(1))
    assert j.may_reach(a, b, least).mean() > 0.999
    c = np.where(draw.random(a.shape) < 0.3, a, a + np.uint16(1))
    assert not j.may_reach(a, c, least).any()


def test_minhash_estimates_the_similarity():
    import pyarrow as pa

    words = [f"w{k}" for k in range(400)]
    _, s = j.signatures(pa.array([" ".join(words), " ".join(words[:300]), "", " ".join(words)]))
    assert abs((s[0] == s[1]).mean() - 296 / 396) < 0.12 and (s[0] == s[3]).all() and not s[2].any()


def test_components(spark):
    draw = random.Random(10)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)] + [(5, 5)]
    label = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    found = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: v for k, v in label.items() if k not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
