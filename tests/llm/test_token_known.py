"""What the encoder of token files knows, and what it asks the library for."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starlens.llm import token_files as tf
from tests.llm.test_tokens import WORDS


@pytest.fixture
def encoder():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(WORDS, "rb") as file:
        return tf.Encoder(file.read())


def agrees(encoder, texts):
    theirs = Tokenizer.from_file(WORDS)
    theirs.no_truncation()
    for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text or "", add_special_tokens=False).ids


def test_known_pieces_keep_their_ids_when_slots_collide_and_grow():
    known, ids = tf.Known(16), {}
    draw = random.Random(3)
    for _ in range(40):
        # Few different low bits, so that most want the same slots.
        new = [h for h in {draw.getrandbits(50) << 10 | draw.randrange(1, 4) for _ in range(60)} if h not in ids]
        ids |= {h: np.arange(draw.randrange(5), dtype="<u4").tobytes() + np.array([h % 1000], "<u4").tobytes() for h in new}
        known.add(np.array(new, np.uint64), [ids[h] for h in new])
    at = known.places(np.array([*ids], np.uint64))
    assert (known.keys[at] == np.array([*ids], np.uint64)).all() and 2 * known.pieces <= len(known.keys)
    assert [known.ids[s : s + n].tobytes() for s, n in zip(known.start[at], known.size[at], strict=True)] == [*ids.values()]
    assert (known.keys[known.places(np.array([2**63 + 1, 7, 16], np.uint64))] == 0).all()


def test_words_with_runs_of_signs_are_asked_of_the_model_once(encoder, monkeypatch):
    texts = ["Größe!!! LEENPA,!!  erßster&&& it.%%% (a) end.", None, "größe!!! _x_ ÉTÉ((", ""]
    agrees(encoder, texts)
    monkeypatch.setattr(encoder, "ask", lambda some: [b""] * len(some) if not some else pytest.fail(f"asked whole: {some}"))
    words = ["Neue##", "neue###", "GRÖSSE@@", "süß.%%%"]
    agrees(encoder, [" ".join(words)])
    monkeypatch.setattr(encoder, "ask_model", lambda some: pytest.fail(f"asked again: {some}"))
    agrees(encoder, [" ".join(words * 3)])


def test_texts_of_all_kinds_encode_as_the_library_does(encoder, monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 300)
    draw = random.Random(5)
    letters = [*"abcdeéñßöÄÉÑẞİKſ'’.,!?0123<|>_-́漢字", " ", "  ", "\n", " ", "\xa0", "'s", "<|endoftext|>", "ǅ", "ΑΣ ", "0"]
    for _ in range(60):
        agrees(encoder, ["".join(draw.choices(letters, k=draw.randrange(120))) for _ in range(12)])
    assert encoder.known.pieces < 5_000
