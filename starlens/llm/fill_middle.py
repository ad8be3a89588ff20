"""Fill-in-the-middle texts, cut by a wavelet matrix over character classes.

The UTF-8 bytes of many texts are one sequence of eight classes, held as a wavelet matrix of three bit vectors with
rank counts. Sums of ranks say how many characters, words or lines begin between two places, and bisection on them finds the
place of a given one; both work on all texts of a batch at once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, per_slice
from starlens.llm.words import slices, text_bytes

#: Bytes of text whose wavelet matrix a worker holds at once; a longer text is one of its own.
TOGETHER = 1 << 20
LEVELS = 3
CONTINUED, SPACE, LINE_END, INSIDE, LETTER, DIGIT, SIGN, WIDE = range(8)
#: The classes whose bytes begin a unit of each kind; lines are counted by their ends.
UNITS = {
    "character": (SPACE, LINE_END, INSIDE, LETTER, DIGIT, SIGN, WIDE),
    "word": (LETTER, DIGIT, SIGN, WIDE),
    "line": (LINE_END,),
}
SENTINELS = ("<P>", "<S>", "<M>")


def byte_classes() -> np.ndarray:
    """The class of each byte that begins a word."""
    kinds = np.full(256, SIGN, np.uint8)
    for byte in range(128):
        letter = chr(byte)
        if letter.isspace():
            kinds[byte] = LINE_END if letter == "\n" else SPACE
        elif letter.isalpha():
            kinds[byte] = LETTER
        elif letter.isdigit():
            kinds[byte] = DIGIT
    kinds[0x80:0xC0] = CONTINUED
    kinds[0xC0:] = WIDE
    return kinds


CLASSES = byte_classes()


def class_sequence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of each byte; words are runs without ASCII white space and do not cross rows."""
    kinds = CLASSES[data]
    blank = (kinds == SPACE) | (kinds == LINE_END)
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = blank[:-1]
    begins[offsets] = True  # rows, empty ones at the end included
    kinds[~(blank | begins[:-1] | (kinds == CONTINUED))] = INSIDE
    return kinds


class Bits:
    """A bit vector with the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(-(-(len(bits) + 1) // 64) * 8, np.uint8)
        packed[: -(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))


class WaveletMatrix:
    """Ranks of the symbols 0 to 7 in a sequence: one stably partitioned bit vector a level, the highest bit first."""

    def __init__(self, symbols: np.ndarray):
        self.length = len(symbols)
        self.levels = []
        for bit in reversed(range(LEVELS)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append(Bits(ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, wanted: tuple[int, ...], low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many of the places ``low`` to ``high`` (exclusive) hold one of the ``wanted`` symbols.

        Both ends go down the levels together; a subtree whose symbols are all wanted counts at once.
        """
        total = np.zeros(len(low), np.int64)
        open_nodes = [(0, 0, low, high)]
        while open_nodes:
            level, prefix, a, b = open_nodes.pop()
            size = 1 << (LEVELS - level)
            inside = sum(prefix * size <= s < (prefix + 1) * size for s in wanted)
            if inside == size:
                total += b - a
            elif inside:
                bits = self.levels[level]
                first, last = bits.ones(a), bits.ones(b)
                open_nodes += [(level + 1, 2 * prefix, a - first, b - last), (level + 1, 2 * prefix + 1, bits.zeros + first, bits.zeros + last)]
        return total

    def select(self, wanted: tuple[int, ...], low: np.ndarray, high: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The smallest ends such that ``count`` of the places from ``low`` on are wanted; ``high`` if there are not so many."""
        first, a, b = low, low.copy(), high.copy()
        while (a < b).any():
            middle = (a + b) >> 1
            enough = self.rank(wanted, first, middle) >= count
            a, b = np.where(enough | (a >= b), a, middle + 1), np.where(enough, middle, b)
        return a


def cuts(matrix: WaveletMatrix, offsets: np.ndarray, unit: str, *draws: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The units of each row, and the places after the drawn numbers of units modulo units + 1, in rising order."""
    wanted, low, high = UNITS[unit], offsets[:-1], offsets[1:]
    n = matrix.rank(wanted, low, high)
    counts = np.sort(np.stack([(draw % (n + 1)).astype(np.int64) for draw in draws]), axis=0)
    if unit == "line":
        return n, [np.where(k == 0, low, matrix.select(wanted, low, high, k)) for k in counts]
    # a unit ends where the next one begins, which is the last place of the shortest stretch that holds it
    return n, [np.where(k == n, high, matrix.select(wanted, low, high, k + 1) - 1) for k in counts]


def draw(seed: int, key: str, part: int) -> Column:
    """The ``part``-th group of eight digits of the SHA-256 of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 8 * part + 1, 8), 16, 10).cast("long")


def split_texts(docs: DataFrame, first: Column, second: Column, text: str = "text", unit: str = "character") -> DataFrame:
    """All columns of ``docs`` and ``n`` (units), ``prefix``, ``middle``, ``suffix``, ``prefix_chars``, ``middle_chars``.

    The prefix ends after the smaller of ``first`` and ``second`` modulo (n + 1) units, the middle after the larger; null numbers count as 0. Units are
    characters (code points), words (runs without ASCII white space; white space goes with what is before it) or lines (with their ends). Null texts
    count as empty: no units, three empty parts. Columns called as the new ones are replaced.
    """
    fresh = {"n": "long", "prefix": "string", "middle": "string", "suffix": "string", "prefix_chars": "long", "middle_chars": "long"}
    draws = {f"fim_draw_{i}": F.coalesce(column.cast("long"), F.lit(0)) for i, column in enumerate((first, second))}
    kept = known(docs, text).drop(*(c for c in fresh if c != text)).withColumns(draws)
    drawn = list(draws)
    names = [c for c in kept.columns if c not in draws]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch[text])
        offsets = offsets.astype(np.int64)
        matrix = WaveletMatrix(class_sequence(data, offsets))
        n, (p, m) = cuts(matrix, offsets, unit, *(batch[c].to_numpy() for c in drawn))
        characters = UNITS["character"]
        counts = [matrix.rank(characters, offsets[:-1], p), matrix.rank(characters, p, m)]
        whole = data.tobytes()
        part = lambda low, high: pa.array([whole[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)], pa.binary()).cast(pa.string())
        new = [pa.array(n), part(offsets[:-1], p), part(p, m), part(m, offsets[1:]), *map(pa.array, counts)]
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, *fresh])

    kinds = ", ".join([kept.select(*names).schema.toDDL(), *(f"{c} {kind}" for c, kind in fresh.items())])
    return kept.mapInArrow(per_slice(lambda texts: slices(texts, TOGETHER), run, text), kinds)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, unit: str = "character", rate: int = 90, spm_rate: int = 20, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns of ``docs`` with the parts of ``split_texts``, ``form`` and ``output``.

    Of the texts ``rate`` % are reordered, of these ``spm_rate`` % with the suffix first (``spm``), else the prefix first (``psm``); the others, empty texts
    and texts that hold a sentinel stay ``plain``. All draws come from the SHA-256 of seed and key, so repeated rows are cut alike; null keys count
    as empty. Columns called as the new ones are replaced.
    """
    p, s, m = (F.lit(x) for x in sentinels)
    parts = split_texts(docs, draw(seed, key, 0), draw(seed, key, 1), text, unit)
    unfit = (F.col(text) == "") | F.contains(text, p) | F.contains(text, s) | F.contains(text, m)
    form = F.when(unfit | (draw(seed, key, 2) % 100 >= rate), "plain").when(draw(seed, key, 3) % 100 < spm_rate, "spm").otherwise("psm")
    output = F.when(F.col("form") == "plain", F.col(text)).when(F.col("form") == "psm", F.concat(p, "prefix", s, "suffix", m, "middle")).otherwise(F.concat(s, "suffix", p, "prefix", m, "middle"))
    return parts.withColumn("form", form).withColumn("output", output)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text of an output, from it and its form alone: its parts end at the first place of the next sentinel.

    No part holds a sentinel, and one that does not overlap itself cannot begin before the seam either.
    """
    p, s, m = sentinels
    if any(x[:i] == x[-i:] for x in sentinels for i in range(1, len(x))):
        raise ValueError("a sentinel must not begin as it ends")
    cut = lambda x, mark: F.split(x, re.escape(mark), 2)
    head, tail = cut(F.substr(output, F.lit(len(p) + 1)), s), cut(F.substr(output, F.lit(len(s) + 1)), p)
    psm, spm = cut(head[1], m), cut(tail[1], m)
    return F.when(form == "plain", output).when(form == "psm", F.concat(head[0], psm[1], psm[0])).otherwise(F.concat(spm[0], spm[1], tail[0]))
