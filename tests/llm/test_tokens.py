"""BPE and token files, against the tokenizers library."""

import os
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import zstandard
from tokenizers import Tokenizer

from starlens.llm import bpe
from starlens.llm import token_files as tf

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABETS = ["abcdefghij'sd re'll", "ÉÀéüñßΣσçИжЯ", "漢字かな한", "0123456789٣Ⅷ½", "!?.,;:()[]{}<>|$%&*#@\"", "\x1c\x85\xa0 　​ \t\n\r", "😀🏽‍́̈", "ӿẞꟿ͸ᲉꟋ"]


def texts(n, seed):
    draw = random.Random(seed)
    out = ["".join(draw.choice(draw.choice(ALPHABETS)) for _ in range(draw.randint(0, 70))) for _ in range(n)]
    return [x + "<|endoftext|>" + x[:4] if k % 9 == 0 else x for k, x in enumerate(out)] + ["", "aaaaaaaaaaa" * 50, "ab" * 5000, " " * 300, "the quick brown fox " * 20]


def library(path):
    out = Tokenizer.from_file(path)
    out.no_padding()
    out.no_truncation()
    return out


@pytest.fixture(scope="module")
def model():
    with open(BYTES, "rb") as file:
        return bpe.ByteBpe(file.read())


def test_ids_and_texts_are_the_library_s(model):
    mine, theirs = texts(1500, 1), library(BYTES)
    coded = model.encode(mine)
    for text, ids in zip(mine, coded):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
        assert model.decode(ids) == theirs.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False) == text
    assert 0 < model.failed < model.speculated


def test_compatible_pairs_are_those_that_encode_to_themselves(model):
    draw = np.random.default_rng(2)
    a, b = draw.integers(0, 3000, 3000), draw.integers(0, 3000, 3000)
    letters = {i: model.bytes[model.ids[i]] for i in range(3000)}
    flat = [letters[x] + letters[y] for x, y in zip(a.tolist(), b.tolist())]
    first = np.concatenate([[0], np.cumsum([len(x) for x in flat])])
    tokens, bounds = model.merged(model.byte_tokens[np.frombuffer(b"".join(flat), np.uint8)], first)
    again = [tokens[bounds[k] : bounds[k + 1]].tolist() == [x, y] for k, (x, y) in enumerate(zip(a.tolist(), b.tolist()))]
    assert model.compatible(a, b).tolist() == again and any(again) and not all(again)


def test_decoding_of_bad_ids(model):
    assert model.decode(struct.pack("<3I", 10**6, model.ids[0xE9], model.ids[97])) == "�a" and model.decode(b"") == ""


def test_memory_forgets_only_old_words(model, monkeypatch):
    monkeypatch.setattr(model.memory, "limit", 50)
    mine = texts(200, 3)
    assert [model.encode([x])[0] for x in mine] == model.encode(mine)


def test_encode_and_decode_tables(spark, table):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "é" * 3000)]
    out = bpe.bpe_decode(bpe.bpe_encode(table(rows), BYTES), BYTES).collect()
    assert sorted((x["doc_id"] or 0, x["decoded"]) for x in out) == sorted((i or 0, x or "") for i, x in rows)
    assert all(x["n_tokens"] * 4 == len(x["token_ids"]) and x["t"] == "y" for x in out)
    assert bpe.bpe_encode(table([]), BYTES).count() == 0
    with pytest.raises(ValueError, match="byte-level"):
        bpe.ByteBpe(open(WORDS, "rb").read())


def test_pieces_encode_as_whole_texts():
    with open(WORDS, "rb") as file:
        encoder = tf.Encoder(file.read())
    theirs = library(WORDS)
    assert encoder.by_piece and encoder.small
    mine = texts(1500, 4)
    for text, ids in zip(mine, encoder.encode(pa.array(mine))):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("frame", [16, 1 << 18])
def test_token_files(spark, table, frame):
    rows = [(k, x) for k, x in enumerate(texts(40, 5))] + [(7, "again seven"), (None, "no id"), (900, None)]
    files = tf.write_token_files(table(rows), WORDS, frame_bytes=frame)
    theirs, start = library(WORDS), 0
    got = sorted(tf.read_token_files(files).collect(), key=lambda x: x["start"])
    for (i, text), x in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), got, strict=True):
        ids = theirs.encode(text or "", add_special_tokens=False).ids + [2]
        assert (x["doc_id"], x["start"], np.frombuffer(x["token_ids"], "<u4").tolist()) == (i, start, ids)
        start += len(ids)
    some = tf.read_token_files(files, [7, 900]).collect()
    assert sorted(x["doc_id"] for x in some) == [7, 7, 900]
    assert tf.read_token_files(tf.write_token_files(table([]), WORDS)).count() == 0


def test_frames_stand_alone_and_are_checked(tmp_path):
    path = str(tmp_path / "a.tokens")
    with open(path, "wb") as out:
        writer = tf.Writer(out, 32)
        docs = {k: np.arange(k, dtype="<u4").tobytes() for k in range(12)}
        for k, ids in docs.items():
            writer.add(k, ids)
        writer.close()
    plain = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()  # any reader takes the file
    assert plain == b"".join(docs.values())
    store = pafs.LocalFileSystem()
    reader = tf.Reader(store.open_input_file(path))
    fetched = []
    reader.frame = lambda k, get=reader.frame: (fetched.append(k), get(k))[1]
    assert [(d, ids) for d, _, ids in reader.documents({4, 9})] == [(4, docs[4]), (9, docs[9])] and len(fetched) == 2 < len(reader.table) - 1
    data = bytearray(open(path, "rb").read())
    reader.table.setflags(write=False)
    other = dict(enumerate(reader.starts.tolist()))
    frame = zstandard.ZstdCompressor(level=tf.LEVEL).compress(b"\x01" * int(reader.table[0, 1]))
    damaged = bytes(frame) + bytes(data[other[1] :])
    table = bytearray(damaged)
    at = len(table) - 9 - 12 * len(reader.table)
    table[at : at + 4] = struct.pack("<I", len(frame))
    open(path, "wb").write(bytes(table))
    with pytest.raises(ValueError, match="damaged"):
        tf.Reader(store.open_input_file(path)).frame(0)


def test_stores():
    assert isinstance(tf.file_system("/x/y")[0], pafs.LocalFileSystem) and tf.file_system(f"file://{os.sep}x/y")[1] == "/x/y"
    assert pa.types.is_int64(tf.rows_of([1], [0], [b""]).schema.field("doc_id").type)
