import random
import re

import numpy as np
import pyarrow as pa

from starlens.llm import words as w


def parts(texts):
    x = w.words_of(pa.array(texts, pa.string()))
    return [[bytes(x.data[b:e]).decode() for b, e in zip(x.begin[x.first[i] : x.first[i + 1]], x.end[x.first[i] : x.first[i + 1]])] for i in range(len(texts))], x


def test_words_are_those_of_the_regular_expression():
    draw = random.Random(1)
    texts = ["".join(draw.choice("abC deß É,.-_\n012 «»—") for _ in range(draw.randint(0, 80))) for _ in range(300)]
    assert parts(texts)[0] == [re.findall(r"\w+", x) for x in texts]


def test_case_and_position_do_not_matter():
    _, x = parts(["École über x", "ÉCOLE", "ÜBER", "", None, "École"])
    h = x.hashes
    assert h[0] == h[3] == h[5] and h[1] == h[4] and len(set(h[:3].tolist())) == 3
    assert x.first.tolist() == [0, 3, 4, 5, 5, 5, 6]


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = ["alpha beta gamma " * 50, None, "delta", "", "x" * 500]
    whole = w.words_of(pa.array(texts, pa.string()))
    monkeypatch.setattr(w, "CHUNK", 64)
    small = w.words_of(pa.array(texts[:4], pa.string()))
    assert small.hashes.tolist() == whole.hashes[:-1].tolist() and small.first.tolist() == whole.first[:-1].tolist()


def test_no_word_reaches_over_a_row_or_a_slice():
    texts = pa.array(["ab", "cd", "", "ef gh"]).slice(1, 3)
    assert [w.words_of(texts).first.tolist()] == [[0, 1, 1, 3]]
    assert list(w.slices(pa.array(["aaaa", "b", "cc", "dddd"]), 3)) == [(0, 1), (1, 3), (3, 4)]
    assert list(w.slices(pa.array([], pa.string()))) == []


def test_shingles_are_sets_of_five_words():
    draw = random.Random(2)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 12))) for _ in range(60)]
    values, first = w.shingles(w.words_of(pa.array(texts)), 5)
    names = {}
    for i, x in enumerate(texts):
        words = x.split()
        mine = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
        assert first[i + 1] - first[i] == len(mine)
        for value, name in zip(values[first[i] : first[i + 1]].tolist(), mine):
            assert names.setdefault(name, value) == value
    assert len(set(names.values())) == len(names)
    assert len(np.unique(values)) == len(names)
