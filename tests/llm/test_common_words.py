"""The bound of common words: the same as counting every word of every stretch, without looking at frequent words everywhere."""

from collections import Counter

import numpy as np

from starlens.llm import contamination as c


def made(seed=5):
    draw = np.random.default_rng(seed)
    said = [f"w{k}" for k in draw.zipf(1.3, 4000) if k < 3000]
    texts = [" ".join(said[i : i + n]) for i, n in ((40, 6), (300, 25), (900, 60), (1500, 33))] + ["only words that nobody else says"]
    items = c.Items(list(range(len(texts))), texts, [None] * len(texts), np.ones((c.TERMS + 1, 2), np.float32))
    words = c.hashed(c.pa.array([" ".join(said)])).words
    low = draw.integers(0, len(words), 3000)
    return items, words, low, np.minimum(low + draw.integers(1, 150, 3000), len(words))


def test_bound_counts_each_word_as_often_as_the_item_has_it():
    items, words, low, high = made()
    places = c.Places(words, items.vocabulary)
    for item in range(len(items.ids)):
        own = Counter(items.words[item])
        for share in (0.3, 0.6, 1.0):
            want = [sum((Counter(words[a:b].tolist()) & own).values()) >= share * len(items.words[item]) for a, b in zip(low, high, strict=True)]
            assert c.enough_words(places, items, item, low, high, share).tolist() == want
            assert item > 3 or share > 0.3 or any(want)


def test_frequent_words_are_not_looked_for_where_the_others_are_missing(monkeypatch):
    items, words, low, high = made()
    places = c.Places(words, items.vocabulary)
    asked = []
    of = c.Places.of
    monkeypatch.setattr(c.Places, "of", lambda self, codes: asked.extend(self.counts[codes].tolist()) or of(self, codes))
    empty = np.zeros(10, np.int64)
    assert not c.enough_words(places, items, 2, empty, empty, 0.6).any()
    assert asked and max(asked) < places.counts[items.codes[2]].max()


def test_set_places_are_those_of_all_flags():
    draw = np.random.default_rng(3)
    for shape in ((0, 3), (1, 5), (8, 8), (513, 7)):
        flags = draw.random(shape) < 0.05
        assert c.set_places(flags).tolist() == np.flatnonzero(flags).tolist()
