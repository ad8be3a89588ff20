"""Documents that lack an item's words are left out before the windows near it are sorted and counted."""

import numpy as np
import pyarrow as pa

from starlens.llm import contamination as c


def made(texts):
    """Items of texts, with latent vectors that do not matter."""
    return c.Items(list(range(len(texts))), texts, [None] * len(texts), np.ones((c.TERMS + 1, 4), np.float32))


def some(seed):
    draw = np.random.default_rng(seed)
    word = lambda n: " ".join(f"w{x}" for x in draw.integers(0, 30, n))
    items = made([word(n) for n in draw.integers(5, 30, 11)])
    docs = c.hashed(pa.array([word(n) for n in draw.integers(0, 45, 70)] + ["", "elsewhere only"]))
    return items, docs


def wanted(items, docs, share):
    rows = []
    for low, high in zip(docs.first, docs.first[1:], strict=False):
        have = dict(zip(*np.unique(docs.words[low:high], return_counts=True), strict=True))
        rows.append([sum(min(n, have.get(w, 0)) for w, n in zip(*own, strict=True)) >= share * len(items.words[i]) for i, own in enumerate(items.counted)])
    return np.array(rows)


def test_documents_with_enough_of_an_items_words_are_those_of_a_plain_count(monkeypatch):
    for seed, matrix in ((1, 1 << 20), (2, 40), (3, 1)):
        monkeypatch.setattr(c, "MATRIX", matrix)  # rows are counted in blocks
        items, docs = some(seed)
        for share in (0.3, 0.6, 1.0):
            got = c.rows_with_enough(c.Places(docs.words, items.vocabulary), docs, items, share)
            want = wanted(items, docs, share)
            assert (got == want).all() and (share == 1.0 or 0 < want.sum() < want.size)


def test_no_document_or_no_item():
    items, docs = some(4)
    empty = c.hashed(pa.array(["", ""]))
    assert not c.rows_with_enough(c.Places(empty.words, items.vocabulary), empty, items, 0.6).any()
    none = made([])
    assert c.rows_with_enough(c.Places(docs.words, none.vocabulary), docs, none, 0.6).shape == (72, 0)
    assert list(c.candidates(docs, np.ones((c.TERMS + 1, 4), np.float32), none, 0.35)) == []


def test_windows_near_an_item_that_its_row_cannot_hold_are_not_counted(monkeypatch):
    items = made(["one two three four five six seven eight nine ten"])
    texts = ["ten words of another kind that are near by their directions", "so one two three four five six seven eight nine ten it is"]
    docs = c.hashed(pa.array(texts))
    counted = []
    enough = c.enough_words
    monkeypatch.setattr(c, "enough_words", lambda places, items, i, low, high, share: counted.extend(low.tolist()) or enough(places, items, i, low, high, share))
    found = list(c.candidates(docs, np.ones((c.TERMS + 1, 4), np.float32), items, 0.35))
    assert {row for row, *_ in found} == {1}
    assert counted and min(counted) >= docs.first[1]
