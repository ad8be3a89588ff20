"""Byte-level BPE encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest known tokens. The cut is the true one exactly if every adjacent
pair of tokens is compatible, that is, if merging the two tokens' bytes by rank gives these two tokens again; all
pairs of a batch are tested together with array operations. Only words with an incompatible pair are merged step by step.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from starlens.llm.common import Memory, per_slice
from starlens.llm.words import slices, worker_memory

#: Fixed value of the byte-level vocabularies: the pattern that cuts a text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words in each of the two generations whose ids a worker remembers.
REMEMBERED = 120_000
#: Bytes of text that are encoded together; the same words are looked up once.
TOGETHER = 1 << 21
NEVER = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(plain))}
    return [chr(moved.get(b, b)) for b in range(256)]


def unsettled() -> re.Pattern:
    """Characters whose kind (letter, number, other) differs between Unicode versions; a text with one is cut by the library itself."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(points)
    letters, numbers = set(regex.findall(r"\p{L}", everything)), set(regex.findall(r"\p{N}", everything))
    odd = [ord(x) for x in points if ((k := unicodedata.category(x)[0]) == "L") != (x in letters) or (k == "N") != (x in numbers)]
    ranges: list[list[int]] = []
    for c in odd:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]")


class ByteBpe:
    """A vocabulary file of the tokenizers library, for byte-level BPE without a normaliser."""

    def __init__(self, file: bytes):
        data = json.loads(file)
        model, cut = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or data.get("normalizer") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError("this is not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        back = {x: b for b, x in enumerate(letters)}
        vocab = model["vocab"]
        self.spelling = {b: x for b, x in enumerate(letters)} | {255: "\n"}  # no text has the byte 255; it parts words
        # inside, a token is numbered by its rank: the 256 bytes first, then the merges in their order
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        names = [*letters, *(a + b for a, b in merges)]
        number = {x: i for i, x in enumerate(names)}
        if len(number) != len(names):
            raise ValueError("two merges make the same token")
        self.left = np.array([-1] * 256 + [number[a] for a, _ in merges])
        self.right = np.array([-1] * 256 + [number[b] for _, b in merges])
        keys = self.left[256:] * len(names) + self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_merge = keys[order], order + 256
        self.byte_tokens = np.arange(256)
        self.ids = np.array([vocab[x] for x in names], dtype="<u4")
        self.special = sorted(((x["content"], x["id"]) for x in data["added_tokens"]), key=lambda x: -len(x[0]))
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in data["added_tokens"]):
            raise ValueError("added tokens must match as they are")
        self.longest = ahocorasick.Automaton()
        for i, x in enumerate(names):
            self.longest.add_word(x, i)
        self.longest.make_automaton()
        size = max(max(vocab.values()), *(i for _, i in self.special)) + 1 if self.special else max(vocab.values()) + 1
        self.bytes = [b""] * size
        for x, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in x)
        for x, i in self.special:
            self.bytes[i] = x.encode()
        self.word = regex.compile(PATTERN)
        self.unsettled = unsettled()
        self.library_cut = ByteLevel(add_prefix_space=False)
        self.at_special = regex.compile("(" + "|".join(regex.escape(x) for x, _ in self.special) + ")") if self.special else None
        self.special_ids = {x: np.array([i], dtype="<u4").tobytes() for x, i in self.special}
        self.memory = Memory(REMEMBERED)
        self.speculated = self.failed = 0

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a and b merge to, by pair; NEVER without one."""
        keys = a * len(self.ids) + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_merge[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a and b gives a and b again, by pair.

        Both tokens are taken apart from the last merge to the first. The pieces that touch at the border must have no merge
        that ranks before the one that takes the next piece away.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b, before = a.copy(), b.copy(), np.full(len(a), NEVER - 1)
        while len(live):
            broken = self.merge(a, b) < before
            good[live[broken]] = False
            from_a = a > b
            last = np.where(from_a, a, b)
            stay = ~broken & (last >= 256)
            live, a, b, from_a = live[stay], a[stay], b[stay], from_a[stay]
            before = np.where(from_a, a, b + 1)  # of equal ranks the one further left comes first
            a, b = np.where(from_a, self.right[a], a), np.where(from_a, b, self.left[b])
        return good

    def merged(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words by merging, in each word at once, all pairs of its lowest rank from left to right, until none merges.

        ``tokens[first[i]:first[i + 1]]`` are the bytes of word i; the result has the same form.
        """
        sizes = np.diff(first)
        alive = np.arange(len(sizes))  # the words that still merge, whose tokens these are
        rows = np.repeat(alive, sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self.ranks(tokens, rows)
        while len(tokens):
            starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(rows))))
            ended = least == NEVER
            if ended.any():
                done.append((rows[ended], tokens[ended]))
                tokens, rows, rank, least = tokens[~ended], rows[~ended], rank[~ended], least[~ended]
                if not len(tokens):
                    break
            hit = rank == least
            if (hit[1:] & hit[:-1]).any():  # of overlapping pairs (a a a) every second one counts, from the left
                at = np.arange(len(hit))
                run = at - np.maximum.accumulate(np.where(hit, -1, at))
                hit &= run % 2 == 1
            tokens = np.where(hit, rank, tokens)
            gone = np.append(False, hit[:-1])
            stale = hit | np.append(hit[1:], False) | np.append(hit[2:], [False, False])[: len(hit)]
            tokens, rows, rank, stale = tokens[~gone], rows[~gone], rank[~gone], stale[~gone]
            fresh = np.flatnonzero(stale)
            rank[fresh] = self.ranks(tokens, rows, fresh)
        if not done:
            return tokens, first
        rows, tokens = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(rows, kind="stable")
        return tokens[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(sizes)))])

    def ranks(self, tokens: np.ndarray, rows: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The merge of each token (or of those at the places ``at``) with the next one of its word."""
        at = np.arange(len(tokens)) if at is None else at
        after = np.minimum(at + 1, len(tokens) - 1)
        inside = (at + 1 < len(tokens)) & (rows[at] == rows[after])
        return np.where(inside, self.merge(tokens[at], tokens[after]), NEVER)

    def learn(self, words: list[str]) -> None:
        """Add the ids of new words to the known ones."""
        known = self.memory.known
        coded = [x.encode() for x in words]
        sizes = np.array([len(x) for x in coded])
        ends = np.cumsum(sizes + 1) - 1  # of each word's letters in the joined string
        spelt = b"\xff".join(coded).decode("latin-1").translate(self.spelling)
        found = list(self.longest.iter_long(spelt))
        guess = np.array([t for _, t in found], dtype=np.int64)
        rows = np.searchsorted(ends, np.array([e for e, _ in found], dtype=np.int64), side="right")
        inner = np.flatnonzero(rows[1:] == rows[:-1])
        pairs, back = np.unique(guess[inner] * len(self.ids) + guess[inner + 1], return_inverse=True)
        fit = self.compatible(pairs // len(self.ids), pairs % len(self.ids))[back] if len(pairs) else np.zeros(0, bool)
        failed = np.zeros(len(words), bool)
        failed[rows[inner[~fit]]] = True
        self.speculated += len(words)
        self.failed += int(failed.sum())
        ids, bounds = self.ids[guess].tobytes(), np.searchsorted(rows, np.arange(len(words) + 1)).tolist()
        for i in np.flatnonzero(~failed).tolist():
            known[words[i]] = ids[4 * bounds[i] : 4 * bounds[i + 1]]
        if failed.any():
            again = np.flatnonzero(failed)
            flat = np.frombuffer(b"".join(coded[i] for i in again), dtype=np.uint8)
            tokens, first = self.merged(self.byte_tokens[flat], np.concatenate([[0], np.cumsum(sizes[again])]))
            ids, bounds = self.ids[tokens].tobytes(), first.tolist()
            for k, i in enumerate(again.tolist()):
                known[words[i]] = ids[4 * bounds[k] : 4 * bounds[k + 1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.cut(x) for x in texts]
        self.memory.turn()
        fresh = self.memory.missing(set().union(*cut).difference(self.special_ids))
        if fresh:
            self.learn(fresh)
        known = self.memory.known
        out = []
        for text, words in zip(texts, cut, strict=True):
            if any(x in text for x in self.special_ids):
                out.append(b"".join(self.special_ids.get(x) or known[x] for x in words))
            else:
                out.append(b"".join(map(known.__getitem__, words)))
        return out

    def cut(self, text: str) -> list[str]:
        """The words of a text, and its special strings as they are."""
        if self.at_special is None or not any(x in text for x, _ in self.special):
            return self.words(text)
        return [w for part in self.at_special.split(text) if part for w in ([part] if part in self.special_ids else self.words(part))]

    def words(self, text: str) -> list[str]:
        if not text.isascii() and self.unsettled.search(text):
            return [text[a:b] for _, (a, b) in self.library_cut.pre_tokenize_str(text)]
        return self.word.findall(text)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        size = len(self.bytes)
        return b"".join([self.bytes[i] if i < size else b"" for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def loaded(file: bytes) -> ByteBpe:
    """The vocabulary of a worker, parsed once."""
    memory, key = worker_memory(), ("byte bpe", hash(file))
    if key not in memory:
        memory[key] = ByteBpe(file)
    return memory[key]


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """All columns of ``docs`` with the ids of each whole text, as little-endian unsigned 32-bit integers in a binary column, and ``n_tokens``.

    ``vocabulary`` is a file of the driver; its content goes to the executors. Null texts count as empty: no ids.
    Strings of added tokens in a text become their ids, as in the tokenizers library. With ``decoded`` the ids are also decoded, in the same
    workers, into a column of that name. Columns that are called as the new ones are replaced.
    """
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    fresh = {ids: "binary", "n_tokens": "long"} | ({decoded: "string"} if decoded else {})
    kept = docs.drop(*fresh)
    names = kept.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch[text]
        model = loaded(sent.value)
        coded = model.encode((texts.fill_null("") if texts.null_count else texts).to_pylist())
        new = [pa.array(coded, pa.binary()), pa.array([len(x) // 4 for x in coded], pa.int64())]
        if decoded:
            new.append(pa.array([model.decode(x) for x in coded], pa.string()))
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, *fresh])

    return kept.mapInArrow(per_slice(lambda texts: slices(texts, TOGETHER), run, text), ", ".join([kept.schema.toDDL(), *(f"{c} {kind}" for c, kind in fresh.items())]))


def bpe_decode(coded: DataFrame, vocabulary: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """All columns of ``coded`` with the text of the ids; null ids give the empty text. A column called as the new one is replaced."""
    with open(vocabulary, "rb") as file:
        sent = coded.sparkSession.sparkContext.broadcast(file.read())
    kept = coded.drop(text)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [model.decode(x or b"") for x in part[ids].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), pa.array(texts, pa.string())], names=[*names, text])

    return kept.mapInArrow(run, f"{kept.schema.toDDL()}, {text} string")


def digests(coded: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded documents."""
    return coded.select("doc_id", "n_tokens", F.sha2(F.col(ids), 256).alias("ids_sha256"), F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))
