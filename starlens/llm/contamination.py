"""Benchmark passages in documents, found by latent semantic retrieval and verified word by word.

The corpus is cut in passages; their TF-IDF matrix over hashed terms is never built. One pass sums A'A times a
sparse random matrix, from which the leading right singular vectors follow (a randomised decomposition of Nystrom type). Every term then has a latent
vector, and windows of all documents are compared with the benchmark items of about their length by cosine. A
candidate is verified by the longest common subsequence of its words with the item's; a paraphrase, with fewer
words in common, must also hold the item's answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, per_slice
from starlens.llm.words import mix, slices, text_bytes, words_of
from starlens.session import stage

#: Hashed terms, latent dimensions, words to a passage, and words to the blocks that windows are made of.
TERM_BITS, RANK, PASSAGE, BLOCK = 14, 48, 48, 4
TERMS = 1 << TERM_BITS
#: Directions whose singular value is so many times the median are common to all texts of a kind (a language, say) and say nothing of a passage.
COMMON = 1.5
#: Least cosine of a candidate; share of an item's words in order that proves it alone, and together with the answer. At this cosine
#: 98 to 100 % of planted items of 6 to 59 words with 62 % of their words kept were candidates on the smaller table (at 0.5: 82 to 95 %).
COSINE, COVERED, PARAPHRASED = 0.35, 0.75, 0.6
#: Items of fewer words are no passages and not looked for; items that one pass looks for.
LEAST_WORDS, ITEM_BLOCK = 5, 4000
#: Sizes of the windows that are compared with an item, in halves of its own: insertions make its place up to twice as long.
HALVES = (2, 3, 4)
#: Windows of one width that are measured together.
WINDOWS = 8192
#: Multiplications up to which a product is filled up with empty windows: libraries round small products in another way, and no cosine is to depend on the other rows.
SMALL = 1_000_000
#: Pairs of a stretch and a word, and of a document and an item, that are counted together.
TOGETHER, MATRIX = 1 << 18, 1 << 20
#: Entries of each row of the random matrix.
SPARSE = 3


@dataclass
class Rows:
    """The words of some documents as 32-bit hashes; those of document i are ``words[first[i]:first[i + 1]]``."""

    words: np.ndarray
    first: np.ndarray

    @property
    def terms(self) -> np.ndarray:
        return (self.words >> np.uint32(32 - TERM_BITS)).astype(np.int64)


def hashed(texts: pa.Array) -> Rows:
    words = words_of(texts)
    return Rows((words.hashes >> np.uint64(32)).astype(np.uint32), words.first)


def unpacked(column: pa.Array) -> Rows:
    """The documents of a binary column of hashes."""
    data, offsets = text_bytes(column)
    return Rows(np.frombuffer(data.tobytes(), np.uint32), offsets // 4)


def passages(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(passage, term, count) of all different terms of the passages, by passage, and the number of passages."""
    counts = np.diff(rows.first)
    inside = np.arange(len(rows.words)) - np.repeat(rows.first[:-1], counts)
    per_row = -(-counts // PASSAGE)
    owner = np.repeat(np.concatenate([[0], np.cumsum(per_row)])[:-1], counts) + inside // PASSAGE
    keys = np.sort(owner * TERMS + rows.terms)
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[new] // TERMS, keys[new] % TERMS, np.diff(np.append(new, len(keys))), int(per_row.sum())


def words_staged(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, text_hash, words) of each document with words, and per task one row of passage counts (n_passages, frequencies) instead."""
    rows = known(docs, text).select(F.col(key).alias("k"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, kind = np.zeros(TERMS, np.int64), 0, None
        names = ["k", "text_hash", "words", "n_passages", "frequencies"]
        for batch in batches:
            kind = batch["k"].type
            for low, high in slices(batch["t"]):
                part = batch.slice(low, high - low)
                found = hashed(part["t"])
                _, term, _, some = passages(found)
                total += np.bincount(term, minlength=TERMS)
                n += some
                packed = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(found.first.astype(np.int64) * 4), pa.py_buffer(found.words)]).cast(pa.binary())
                none = [pa.nulls(part.num_rows, x) for x in (pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([part["k"], part["text_hash"], packed, *none], names=names)
        if n:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([n]), pa.array([total.tobytes()], pa.binary())], names=names)

    schema = f"k {rows.schema['k'].dataType.simpleString()}, text_hash long, words binary, n_passages long, frequencies binary"
    return stage(rows.mapInArrow(run, schema), "passage-words")


def term_weights(staged: DataFrame) -> np.ndarray:
    """The inverse passage frequency of each hashed term, over all passages."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, coded in zip(batch["n_passages"].to_pylist(), batch["frequencies"].to_pylist(), strict=True):
                total = np.frombuffer(coded, np.int64)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], names=["term", "n"])

    counts = staged.where(F.col("frequencies").isNotNull()).select("n_passages", "frequencies")
    table = counts.mapInArrow(spread, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = table["term"].to_numpy(), table["n"].to_numpy()
    total = float(n[at < 0].sum())
    frequency = np.zeros(TERMS)
    frequency[at[at >= 0]] = n[at >= 0]
    return np.log((total + 1) / (frequency + 0.5)).clip(0)


def sparse_random() -> tuple[np.ndarray, np.ndarray]:
    """The columns and signs of the random matrix's entries: ``SPARSE`` in each row."""
    h = mix(np.arange(TERMS * SPARSE, dtype=np.uint64) + np.uint64(77)).reshape(TERMS, SPARSE)
    return (h % np.uint64(RANK)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0) / np.sqrt(SPARSE)


def latent_terms(staged: DataFrame, weights: np.ndarray) -> np.ndarray:
    """A latent vector for each hashed term: its weight times the right singular vectors, scaled by the singular values. A zero vector follows."""
    sent = staged.sparkSession.sparkContext.broadcast(weights)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, sign = sparse_random()
        total = np.zeros((RANK, TERMS))
        for batch in batches:
            for low, high in slices(batch["words"]):
                passage, term, count, n = passages(unpacked(batch["words"].slice(low, high - low)))
                if not n:
                    continue
                value = count * sent.value[term]
                norm = np.sqrt(np.bincount(passage, value * value, minlength=n))
                value = value / np.maximum(norm, 1e-12)[passage]
                product = np.zeros(n * RANK)
                for k in range(SPARSE):
                    product += np.bincount(passage * RANK + column[term, k], value * sign[term, k], minlength=n * RANK)
                for k, own in enumerate(np.ascontiguousarray(product.reshape(n, RANK).T)):
                    total[k] += np.bincount(term, value * own[passage], minlength=TERMS)
        some = np.flatnonzero(total.any(axis=0))
        listed = pa.FixedSizeListArray.from_arrays(pa.array(total[:, some].T.astype(np.float32).ravel()), RANK).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), listed], names=["term", "v"])

    added = staged.where(F.col("words").isNotNull()).select("words").mapInArrow(sums, "term int, v array<float>").groupBy("term").agg(*(F.sum(F.get("v", F.lit(k)).cast("double")).alias(f"v{k}") for k in range(RANK))).toArrow()
    g = np.zeros((TERMS, RANK))
    g[added["term"].to_numpy()] = np.column_stack([added[f"v{k}"].to_numpy() for k in range(RANK)]) if added.num_rows else np.zeros((0, RANK))
    column, sign = sparse_random()
    omega = np.zeros((TERMS, RANK))
    for k in range(SPARSE):
        np.add.at(omega, (np.arange(TERMS), column[:, k]), sign[:, k])
    core = omega.T @ g
    value, vector = np.linalg.eigh((core + core.T) / 2)
    use = value > 1e-7 * max(value.max(), 1e-30)
    u, s, _ = np.linalg.svd(g @ (vector[:, use] / np.sqrt(value[use])), full_matrices=False)
    use = s > 1e-4 * max(s.max(initial=0), 1e-30)
    shared = s > COMMON * np.median(s[use]) if use.any() else use
    use &= ~shared | (shared.sum() > use.sum() // 2)
    return np.vstack([weights[:, None] * u[:, use] / s[use], np.zeros((1, int(use.sum())))]).astype(np.float32)


class Items:
    """Benchmark items of one pass: words, answers and latent directions, by window size."""

    def __init__(self, ids: list[int], texts: list[str], answers: list[str | None], latent: np.ndarray):
        words = hashed(pa.array(texts, pa.string()))
        self.ids, self.words, self.terms, self.counted, self.answers, self.masks = [], [], [], [], [], []
        rows: dict[int, list[np.ndarray]] = {}
        self.members: dict[int, list[int]] = {}
        for i, (item, text, answer) in enumerate(zip(ids, texts, answers, strict=True)):
            own = words.words[words.first[i] : words.first[i + 1]]
            if len(own) < LEAST_WORDS:
                continue
            direction = latent[Rows(own, words.first).terms].sum(axis=0)
            blocks = window_blocks(len(own))
            self.members.setdefault(blocks, []).append(len(self.ids))
            rows.setdefault(blocks, []).append(direction / max(np.linalg.norm(direction), 1e-12))
            asked = hashed(pa.array([answer if answer is not None else last_sentence(text)], pa.string())).words
            self.ids.append(item)
            self.words.append(own.tolist())
            self.terms.append(np.unique(Rows(own, words.first).terms))
            self.counted.append(np.unique(own, return_counts=True))
            self.answers.append(asked.tolist())
            masks: dict[int, int] = {}
            for k, h in enumerate(own.tolist()):
                masks[h] = masks.get(h, 0) | 1 << k
            self.masks.append(masks)
        self.directions = {k: np.array(v, dtype=np.float32).T.copy() for k, v in rows.items()}
        self.vocabulary = np.unique(np.concatenate([own for own, _ in self.counted] or [np.zeros(0, np.uint32)]))
        self.codes = [np.searchsorted(self.vocabulary, own) for own, _ in self.counted]
        codes = np.concatenate([*self.codes, np.zeros(0, np.int64)])
        order = np.argsort(codes, kind="stable")  # the items of each word, and how often they have it
        self.holders = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.codes])[order]
        self.held = np.concatenate([*(n for _, n in self.counted), np.zeros(0, np.int64)])[order]
        self.first_holder = np.searchsorted(codes[order], np.arange(len(self.vocabulary) + 1))

    def verify(self, item: int, text: list[int]) -> tuple[float, bool]:
        """The share of the item's words that the text has in their order, and whether it has the answer's words in theirs."""
        n = len(self.words[item])
        masks = self.masks[item]
        covered = common_subsequence(masks, n, text) / n
        answer = self.answers[item]
        if not answer:
            return covered, False
        own: dict[int, int] = {}
        for k, h in enumerate(answer):
            own[h] = own.get(h, 0) | 1 << k
        return covered, common_subsequence(own, len(answer), text) >= 0.9 * len(answer)


def window_blocks(words: int) -> int:
    """The size in blocks of the windows that are compared with an item: its own up to 16, then within an eighth of it."""
    blocks = max(1, round(words / BLOCK))
    step = 1 << max(0, blocks.bit_length() - 4)
    return -(-blocks // step) * step


def last_sentence(text: str) -> str:
    """What stands for the answer of an item without one: the words after its last inner end of a sentence."""
    body = text.rstrip(" \n.!?")
    at = max(body.rfind(x) for x in ".!?\n")
    return body[at + 1 :]


def common_subsequence(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Length of the longest common subsequence, one machine operation for all of the item's words at once."""
    full = (1 << n) - 1
    row = full
    for h in text:
        hit = row & masks.get(h, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


class Places:
    """Where the words of the items, by their number in the vocabulary, are among the words of some documents."""

    def __init__(self, words: np.ndarray, vocabulary: np.ndarray):
        self.words = len(words) + 1
        begins = np.zeros(1 << 16, bool)
        begins[vocabulary >> np.uint32(16)] = True
        place = np.flatnonzero(begins[words >> np.uint32(16)])  # few others begin like a word of the items
        code = np.searchsorted(vocabulary, words[place])
        same = vocabulary[np.minimum(code, len(vocabulary) - 1)] == words[place]
        place, code = place[same], code[same]
        self.by_place = place, code
        order = np.argsort(code.astype(np.uint16) if len(vocabulary) < 1 << 16 else code, kind="stable")
        self.place, self.counts = place[order], np.bincount(code, minlength=len(vocabulary))
        self.last = np.cumsum(self.counts)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of some words, word after word, and how many each has."""
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        return self.place[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.last[codes] - ends, counts)], counts


def enough_words(places: Places, items: Items, item: int, low: np.ndarray, high: np.ndarray, share: float) -> np.ndarray:
    """Which stretches of words have ``share`` of the item's words in common with it, each as often as the item has it: a bound of the common subsequence that loses none.

    The words that are most frequent here are first taken as found, up to half of what is needed, and only the others are looked for; in the stretches that are left all are counted.
    """
    need = share * len(items.words[item])
    codes, times = items.codes[item], items.counted[item][1]
    order = np.argsort(-places.counts[codes], kind="stable")
    codes, times = codes[order], times[order]
    given = int(np.searchsorted(np.cumsum(times), need / 2, side="right"))
    rare = np.sort(places.of(codes[given:])[0])
    out = rare.searchsorted(high) - rare.searchsorted(low) + times[:given].sum() >= need
    some = np.flatnonzero(out)
    if len(some):
        place, counts = places.of(codes)
        word = np.arange(len(codes)) * places.words  # every word has a line of its own, one after the other
        lines = place + np.repeat(word, counts)
        for some in np.array_split(some, -(-len(some) * len(codes) // TOGETHER)):
            has = lines.searchsorted(high[some, None] + word) - lines.searchsorted(low[some, None] + word)
            out[some] = np.minimum(has, times).sum(axis=1) >= need
    return out


def rows_with_enough(places: Places, words: Rows, items: Items, share: float) -> np.ndarray:
    """Which documents (rows) have ``share`` of the words of which items (columns), each as often as the item has it: in others no stretch has."""
    rows, n = len(words.first) - 1, len(items.ids)
    out = np.zeros((rows, n), bool)
    need = share * np.array([len(x) for x in items.words])
    place, code = places.by_place
    size = len(items.vocabulary)
    pair, times = np.unique((np.searchsorted(words.first, place, side="right") - 1) * size + code, return_counts=True)
    step = max(1, MATRIX // max(n, 1))
    for low in range(0, rows, step):
        high = min(low + step, rows)
        here = slice(*np.searchsorted(pair, (low * size, high * size)))
        row, code = np.divmod(pair[here], size)
        holders = items.first_holder[code + 1] - items.first_holder[code]
        ends = np.cumsum(holders)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(items.first_holder[code + 1] - ends, holders)
        has = np.minimum(items.held[at], np.repeat(times[here], holders))
        out[low:high] = np.bincount(np.repeat((row - low) * n, holders) + items.holders[at], has, (high - low) * n).reshape(high - low, n) >= need
    return out


def set_places(flags: np.ndarray) -> np.ndarray:
    """The places of the few set flags of a table, row by row; eight at a time are passed over if none is set."""
    flat = flags.ravel()
    whole = flat[: len(flat) // 8 * 8]
    some = np.flatnonzero(whole.view(np.uint64) != 0)  # flags are passed over faster than numbers
    at = np.flatnonzero(whole.reshape(-1, 8)[some])
    return np.concatenate([some[at >> 3] * 8 + (at & 7), len(whole) + np.flatnonzero(flat[len(whole) :])])


def near_windows(words: Rows, latent: np.ndarray, items: Items, least: float, padded: np.ndarray, possible: np.ndarray) -> np.ndarray:
    """(row, item, first word, last word) and the cosine of all windows near an item that is ``possible`` in their row; of windows of one size in a row that are near one item, each that is no farther than its neighbours.

    The windows of one width are made and measured once, for all items that look at this width, in the rows where one of them is possible.
    """
    counts = np.diff(words.first)
    per_row = -(-counts // BLOCK)
    whole_first = np.concatenate([[0], np.cumsum(per_row)])
    per_row = np.where(possible.any(axis=1), per_row, 0)  # rows without a possible item have no blocks
    block_first = np.concatenate([[0], np.cumsum(per_row)])
    n = int(block_first[-1])
    none = np.zeros((5, 0))
    if not n:
        return none
    rows = np.repeat(np.arange(len(counts)), per_row)
    place = np.arange(n) - block_first[:-1][rows]
    starts = words.first[:-1][rows] + place * BLOCK
    last = block_first[1:][rows]
    row_end = words.first[1:][rows]
    sums = np.zeros((n, latent.shape[1]), np.float32)
    for k in range(BLOCK):
        sums += latent.take(padded[np.where(starts + k < row_end, starts + k, -1)], axis=0)
    asked: dict[tuple[int, int], list[int]] = {}
    for blocks in items.directions:
        for half in HALVES:
            asked.setdefault((-(-blocks * half // 2), 1 << max(0, blocks.bit_length() - 5)), []).append(blocks)
    looked = []
    for (width, stride), sizes in sorted(asked.items()):
        members = np.concatenate([items.members[b] for b in sizes])
        looked.append((width, stride, members, np.concatenate([items.directions[b] for b in sizes], axis=1), possible[:, members].any(axis=1)[rows]))
    widest = looked[-1][0] if looked else 0
    whole = np.zeros((len(counts), sums.shape[1]), np.float32)  # of the rows that are shorter than a window
    some = np.flatnonzero((per_row > 0) & (per_row < widest))
    if len(some):
        ends = np.cumsum(per_row[some])
        whole[some] = np.add.reduceat(sums[np.arange(ends[-1]) + np.repeat(block_first[some + 1] - ends, per_row[some])], ends - per_row[some], axis=0)
    sums = np.concatenate([sums, np.zeros((widest, sums.shape[1]), np.float32)])
    left = last - np.arange(n)
    found = [none]
    edges = np.append(np.arange(0, whole_first[-1], WINDOWS), whole_first[-1])  # of all blocks, so that leaving rows out moves none
    cuts = np.searchsorted(whole_first[rows] + place, edges).tolist()
    for low, high, size in zip(cuts, cuts[1:], np.diff(edges).tolist(), strict=False):
        here = np.arange(low, high)
        window = np.zeros((high - low, sums.shape[1]), np.float32)
        heads = np.flatnonzero(place[low:high] == 0)
        made = 0
        for width, stride, members, directions, worth in looked:
            while made < width:  # a block more for all windows; those that leave their row are not used
                window += sums[low + made : high + made]
                made += 1
            fits = left[low:high] >= width
            use = fits if stride == 1 else fits & ((place[low:high] % stride == 0) | (left[low:high] == width))
            short = heads[~fits[heads]]  # a row shorter than the window is one
            if len(short):
                use, apart = use.copy(), window[short]
                window[short] = whole[rows[low + short]]
                use[short] = True
            use = np.flatnonzero(use & worth[low:high])
            measured = window[use]
            if len(short):
                window[short] = apart
            norm = np.sqrt(np.einsum("ij,ij->i", measured, measured))
            fill = max(0, min(size, SMALL // directions.size + 1) - len(use))
            product = (np.pad(measured, ((0, fill), (0, 0))) @ directions)[: len(use)] if fill else measured @ directions
            hit = set_places(product >= np.maximum(least * norm, 1e-12)[:, None])
            if not len(hit):
                continue
            own, k = np.divmod(hit, len(members))
            at = use[own]
            kept = possible[rows[here[at]], members[k]]
            own, at, k = own[kept], at[kept], k[kept]
            if not len(at):
                continue
            order = np.argsort(k.astype(np.uint16), kind="stable")  # of at most ITEM_BLOCK
            own, at, k = own[order], at[order], k[order]
            value, block = product[own, k] / norm[own], here[at]
            new = np.append(True, (k[1:] != k[:-1]) | (at[1:] > at[:-1] + stride) | (rows[block[1:]] != rows[block[:-1]]))
            top = (new | (value >= np.append(0, value[:-1]))) & (np.append(new[1:], True) | (value >= np.append(value[1:], 0)))  # the local maxima of each run
            block, k, value = block[top], k[top], value[top]
            until = np.minimum(block + width, last[block])
            ends = np.where(until == last[block], row_end[block], starts[np.minimum(until, n - 1)])
            found.append(np.stack([rows[block], members[k], starts[block], ends, value]))
    return np.concatenate(found, axis=1)


def candidates(words: Rows, latent: np.ndarray, items: Items, least: float, share: float = PARAPHRASED) -> Iterator[tuple[int, int, int, int, float]]:
    """(row, item, first word, last word, cosine) of all different stretches around windows near an item that have enough of its words to be verified."""
    padded = np.append(words.terms, TERMS)  # the last latent vector is zero
    places = Places(words.words, items.vocabulary)
    near = near_windows(words, latent, items, least, padded, rows_with_enough(places, words, items, share))
    row, item, begin, end = near[:4].astype(np.int64)
    size = np.array([len(x) for x in items.words] or [0])[item]
    low, high = np.maximum(words.first[row], begin - size // 2), np.minimum(words.first[row + 1], end + size // 2)
    order = np.argsort(item.astype(np.uint16), kind="stable")  # of at most ITEM_BLOCK
    edges = np.concatenate([[0], np.cumsum(np.bincount(item, minlength=len(items.ids)))])
    for i in np.flatnonzero(np.diff(edges)).tolist():
        mine = order[edges[i] : edges[i + 1]]
        mine = mine[enough_words(places, items, i, low[mine], high[mine], share)]
        if not len(mine):
            continue
        mine = mine[np.argsort(-near[4, mine], kind="stable")]
        _, first = np.unique(low[mine] * (len(words.words) + 1) + high[mine], return_index=True)  # the nearest of equal stretches
        for j in mine[np.sort(first)].tolist():
            yield int(row[j]), i, int(low[j]), int(high[j]), float(near[4, j])


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", answer: str | None = None, cosine: float = COSINE, covered: float = COVERED, paraphrased: float = PARAPHRASED) -> DataFrame:
    """(key, text_hash, item_id, cosine, coverage, answered) of each document and benchmark item that it holds.

    ``coverage`` is the largest share of the item's words found in order near a candidate window. It must reach ``covered``, or ``paraphrased`` if the
    answer's words are there too; without a column ``answer`` the item's last sentence stands for it. Items without text or of fewer than
    ``LEAST_WORDS`` words are not looked for; null, empty and clean texts have no row. Repeated documents of one key and text give one row per item.
    The benchmark goes to the executors in blocks of ``ITEM_BLOCK`` items, each block in one pass.
    """
    spark = docs.sparkSession
    staged = words_staged(docs, key, text)
    latent = latent_terms(staged, term_weights(staged))
    asked = benchmark.where(F.col(item_text).isNotNull() & F.col(item).isNotNull()).select(
        F.col(item).cast("long").alias("i"), F.col(item_text).alias("x"), (F.col(answer) if answer else F.lit(None).cast("string")).alias("a")
    )
    blocks = max(1, -(-asked.count() // ITEM_BLOCK))
    rows = staged.where(F.col("words").isNotNull()).select("k", "text_hash", "words")
    kind = rows.schema["k"].dataType.simpleString()
    found = None
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("i", "x"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast((latent, Items([x["i"] for x in some], [x["x"] for x in some], [x["a"] for x in some], latent)))

        def search(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            vectors, items = sent.value
            words = unpacked(batch["words"])
            best: dict[tuple[int, int], list] = {}
            for row, i, low, high, near in candidates(words, vectors, items, cosine, min(covered, paraphrased)):
                if best.get((row, i), [0, 0])[1] >= 0.999:
                    continue
                share, answered = items.verify(i, words.words[low:high].tolist())
                if (share >= covered or share >= paraphrased and answered) and share > best.get((row, i), [0, -1])[1]:
                    best[row, i] = [near, share, answered]
            at = [row for row, _ in best]
            return pa.RecordBatch.from_arrays(
                [
                    batch["k"].take(pa.array(at, pa.int64())), batch["text_hash"].take(pa.array(at, pa.int64())), pa.array([items.ids[i] for _, i in best], pa.int64()),
                    *(pa.array([x[c] for x in best.values()], kind) for c, kind in enumerate((pa.float64(), pa.float64(), pa.bool_()))),
                ],
                names=["k", "text_hash", "item_id", "cosine", "coverage", "answered"],
            )

        part = rows.mapInArrow(per_slice(slices, search, "words"), f"k {kind}, text_hash long, item_id long, cosine double, coverage double, answered boolean")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("coverage", "cosine", "answered"))
    return found.groupBy(F.col("k").alias(key), "text_hash", "item_id").agg(best.alias("b")).select(key, "text_hash", "item_id", "b.cosine", "b.coverage", "b.answered")
