"""Texts of more than a chunk without white space."""

import os

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from starlens.llm import token_files as tf
from tests.llm.test_tokens import WORDS


def test_long_runs_encode_as_whole_texts():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(WORDS, "rb") as file:
        encoder = tf.Encoder(file.read())
    theirs = Tokenizer.from_file(WORDS)
    mine = ["short one", "漢字かな" * 90_000, "a " + "éü" * 270_000 + " end", None, "x" + "abc,de" * 175_000, "last. one"]
    assert tf.unbroken(pa.array(mine)) == [1, 2, 4]
    for text, ids in zip(mine, encoder.encode(pa.array(mine)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text or "", add_special_tokens=False).ids
