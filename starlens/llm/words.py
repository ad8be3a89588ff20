"""Words of whole texts as 64-bit hashes, computed over the bytes of an Arrow batch.

A word is a longest run of ASCII letters, digits, underscores and non-ASCII
characters; general punctuation and the Latin-1 signs separate words. ASCII and
Latin-1 letters are compared without case, other scripts as written. Null texts
count as empty.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; longer texts are cut between words.
CHUNK = 1 << 20
#: Bytes whose 64-bit parts are added up together, few enough for a core's cache.
AT_ONCE = 1 << 15
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def worker_memory() -> dict:
    """What a worker process keeps from task to task.

    Functions of this package travel to the workers by value, so a global of the package would be new for every task.
    """
    return sys.modules.setdefault("starlens_worker_memory", ModuleType("starlens_worker_memory")).__dict__


def powers(base: int) -> np.ndarray:
    """The powers of ``base`` modulo 2^64, up to the length of a chunk."""
    memory = worker_memory()
    if (base, CHUNK) not in memory:
        out = np.full(CHUNK + 1, base, dtype=np.uint64)
        out[0] = 1
        memory[base, CHUNK] = np.multiply.accumulate(out)
    return memory[base, CHUNK]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


@dataclass
class Words:
    """``hashes[first[i]:first[i + 1]]`` are the words of row i; begin and end are byte offsets in ``data``."""

    hashes: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    heads: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers after which all bits depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without copying, and the rows' offsets in them."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes without case, and which of them belong to words."""
    low = LOWER[data]
    inside = WORD[low]
    if (data >= 128).any():
        at = np.flatnonzero(low[:-1] == 0xC3) + 1
        upper = at[(low[at] >= 0x80) & (low[at] <= 0x9E) & (low[at] != 0x97)]
        low[upper] += 0x20
        at = np.flatnonzero(low[:-1] == 0xC2)
        sign = at[~np.isin(low[at + 1], (0xAA, 0xB5, 0xBA))]
        inside[sign] = inside[sign + 1] = False
        at = np.flatnonzero((low[:-2] == 0xE2) & (low[1:-1] == 0x80))
        inside[at] = inside[at + 1] = inside[at + 2] = False
    return low, inside


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of ``inside``; no run reaches over a row's end."""
    n = len(inside)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[offsets < n]] = False
    after[offsets[offsets > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def run_hashes(low: np.ndarray, begin: np.ndarray, end: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte runs, and of their first ``head`` bytes (none if ``head`` is 0)."""
    sums = np.zeros(len(low) + 1, dtype=np.uint64)
    power = powers(BASE)
    for at in range(0, len(low), AT_ONCE):
        to = min(at + AT_ONCE, len(low))
        part = low[at:to].astype(np.uint64)
        part += np.uint64(1)
        part *= power[at:to]
        part[:1] += sums[at : at + 1]
        np.cumsum(part, out=sums[at + 1 : to + 1])
    undo = powers(INVERSE)[begin]
    left = sums[begin]
    heads = mix((sums[np.minimum(end, begin + head)] - left) * undo) if head else np.zeros(0, np.uint64)
    return mix((sums[end] - left) * undo), heads


def words_of(texts: pa.Array, head: int = 0, separate=folded) -> Words:
    """All words of an array of texts; use ``slices`` for arrays of any size.

    ``separate`` gives the bytes to compare, which of them belong to words, and perhaps places where one word ends and the next begins.
    """
    data, offsets = text_bytes(texts)
    parts: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(data):
        to = min(at + CHUNK, len(data))
        low, inside, *more = separate(data[at:to])
        if to < len(data):  # cut between words; a longer run without a break is cut where the chunk ends
            gaps = np.flatnonzero(~inside)
            edges = offsets[(offsets > at) & (offsets < to)] - at
            cut = max(int(gaps[-1]) if len(gaps) else 0, int(edges[-1]) if len(edges) else 0)
            if cut:
                to, low, inside = at + cut, low[:cut], inside[:cut]
        begin, end = spans(inside, np.concatenate([offsets[(offsets >= at) & (offsets <= to)] - at, *(x[x < to - at] for x in more)]))
        parts.append((*run_hashes(low, begin, end, head), begin + at, end + at))
        at = to
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(len(offsets), np.int64), none, none, none.astype(np.uint64), data, offsets)
    hashes, heads, begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(hashes, np.searchsorted(begin, offsets), begin, end, heads, data, offsets)


def slices(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text, or of one row."""
    _, offsets = text_bytes(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield low, high
        low = high


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and their row bounds.

    A row of fewer words has one shingle, made of all of them; a row without words has none.
    """
    counts = np.diff(words.first)
    n = len(words.hashes)
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    value = np.zeros(n, np.uint64)
    last = np.repeat(words.first[1:], counts)
    place = np.arange(n)
    for k in range(size):
        part = np.where(place + k < last, padded[k : n + k], np.uint64(0))
        value = (value * np.uint64(BASE)) + part
    keep = (place + size <= last) | ((place == np.repeat(words.first[:-1], counts)) & (np.repeat(counts, counts) < size))
    totals = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix(value[keep]), np.concatenate([[0], np.cumsum(totals)])
