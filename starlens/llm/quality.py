"""Document quality by Bradley-Terry ranking of preference pairs.

Documents are described by the make-up of their characters, words and lines. Each labelled pair of
a good and a bad document is a preference; the chance that one document is preferred is the logistic of
the difference of their scores, so the weights come from a logistic regression on differences of
features. The threshold is the quantile of the labelled documents' scores that separates the two
labels best, and scores are scaled so that it lies at ``THRESHOLD``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, labelled_rows, logistic_fit, newton, per_slice, sigmoid, sized
from starlens.llm.words import Words, mix, slices, spans, text_bytes, run_hashes, words_of
from starlens.session import received, sent, stage

#: Labelled rows of a group in which pairs are drawn, on average, and rows of the smaller class in each.
GROUP_ROWS = 4_096
GROUP_LEAST = 32
#: Bins of the scores by which the rows around a quantile are found.
RANK_BINS = 1 << 16
#: Preference pairs in which each labelled document of the larger class takes part.
PAIRS_EACH = 2
#: Added to the label of a row that stands in for itself in another group.
COPY = 2
THRESHOLD = 0.7
SHARE_STEP = 1e-3
CLASSES = 9
KIND = np.full(256, 7, np.int64)  # symbols
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 0, 1, 2, 8
KIND[[32, 9, 13]], KIND[10] = 3, 4
KIND[[ord(x) for x in ".,"]], KIND[[ord(x) for x in "!?;:'\"-()"]] = 5, 6


def repeats(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By row, how many different keys there are and how often the most frequent one occurs."""
    own = mix(keys + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at, count = np.unique(own, return_index=True, return_counts=True)
    different, most = np.zeros(n), np.zeros(n)
    np.add.at(different, rows[at], 1)
    np.maximum.at(most, rows[at], count)
    return different, most


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def features(texts: pa.Array, words: Words | None = None) -> np.ndarray:
    """One row of numbers per text; all are defined for an empty text."""
    data, offsets = text_bytes(texts)
    words = words or words_of(texts)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * CLASSES + KIND[data], minlength=n * CLASSES).reshape(n, CLASSES)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 8], 1)
    count = np.diff(words.first)
    some = np.maximum(count, 1)
    length = (words.end - words.begin).astype(np.float64)
    different, most = repeats(words.hashes, words.rows, n)
    same = np.zeros(len(words.hashes))
    if len(same) > 1:
        same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (np.diff(words.rows) == 0)
    first = words.data[words.begin] if len(length) else np.zeros(0, np.uint8)
    begin, end = spans(data != 10, offsets)
    line_first = np.searchsorted(begin, offsets)
    lines = np.diff(line_first)
    line_rows = np.repeat(np.arange(n), lines)
    line_different, _ = repeats(line_hashes(data, begin, end), line_rows, n)
    some_lines = np.maximum(lines, 1)
    ended = np.isin(data[end - 1], [ord(x) for x in ".!?"]) if len(end) else np.zeros(0, bool)
    share = lambda x, of: np.log(x / of + SHARE_STEP)
    mean = row_sums(length, words.first) / some
    return np.column_stack([
        np.log1p(count), mean, row_sums(np.maximum(length - 14, 0), words.first) / some, row_sums(length <= 2, words.first) / some,
        share(kinds[:, 1], letters), share(kinds[:, 2], size), share(kinds[:, 3], size), share(kinds[:, 4], size), share(kinds[:, 5], size),
        share(kinds[:, 6], size), share(kinds[:, 7], size), share(kinds[:, 8], size), kinds[:, 1] / letters, kinds[:, 7] / size,
        different / some, share(most, some), most / some, share(row_sums(same, words.first), some), share(row_sums((first >= 65) & (first <= 90), words.first), some),
        1 - line_different / some_lines, np.log1p(count / some_lines), row_sums(ended, line_first) / some_lines, share(kinds[:, 5], some), np.log1p(lines),
    ])


def line_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of lines; a line longer than a chunk of text counts by its first chunk and its length."""
    out = np.zeros(len(begin), np.uint64)
    step = 1 << 20
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(end, begin[at] + step, side="right")))
        low, high = int(begin[at]), int(min(end[to - 1], begin[at] + step))
        out[at:to] = run_hashes(data[low:high], begin[at:to] - low, np.minimum(end[at:to], high) - low, 1)[0] + (end[at:to] - begin[at:to]).astype(np.uint64)
        at = to
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    slope: float = 1.0

    def rank(self, x: np.ndarray) -> np.ndarray:
        """The Bradley-Terry score of each row of features."""
        return self.standard(x) @ self.weights

    def standard(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.mean) / self.spread)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.rank(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)))


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised features and how far they lie outside the usual range on either side."""
    z = np.clip(z, -8, 8)
    return np.column_stack([z, np.maximum(z - 1.5, 0), np.maximum(-z - 1.5, 0)])


def best_cut(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The cut at which the mean accuracy of both labels is highest; ``good`` and ``bad`` count the scores below each cut, and all."""
    right = (1 - good[:-1] / good[-1]) + bad[:-1] / bad[-1]
    best = np.flatnonzero(right >= right.max() - 1e-9)
    return float(cuts[best].mean())


def gathered(groups: DataFrame, run: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> list[np.ndarray]:
    """Arrays of numbers that ``run`` makes of features, labels and number of each group, added up or listed by the caller; one a group."""
    task = sent(groups.sparkSession, run)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, total = received(task), None
        for batch in batches:
            for x, y, number in zip(batch["x"], batch["y"], batch["number"], strict=True):
                y = np.frombuffer(y.as_buffer(), np.int8)
                out = call(np.frombuffer(x.as_buffer(), np.float64).reshape(len(y), -1), y, number.as_py())
                total = out if total is None else total + out
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(total, np.float64).tobytes()], pa.binary())], names=["sums"])

    return [np.frombuffer(row.sums, np.float64) for row in groups.mapInArrow(each, "sums binary").collect()]


def summed(groups: DataFrame, run: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> np.ndarray:
    return np.sum(gathered(groups, run), axis=0)


def grouped_rows(seen: DataFrame, n: int, least: int) -> DataFrame:
    """(number, x, y) of groups of about ``GROUP_ROWS`` labelled rows, dealt by hash; the rows come in the order of their keys.

    If the smaller class has few rows, each of them is in several groups (negative labels there), so that each group can pair its rows.
    """
    count = max(1, n // GROUP_ROWS)
    times = min(count, -(-GROUP_LEAST * count // least))
    place = F.xxhash64("k", "x")
    shifts = F.sequence(F.lit(0), F.when(F.col("rare"), times - 1).otherwise(0))
    dealt = seen.withColumn("shift", F.explode(shifts)).withColumn("number", F.pmod(place + F.col("shift"), F.lit(count)).cast("int"))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("k", "ascending"), ("shift", "ascending")]).combine_chunks()
        y = rows["label"].to_numpy().astype(np.int8) + np.where(rows["shift"].to_numpy() > 0, COPY, 0).astype(np.int8)
        x = rows["x"].combine_chunks().flatten().to_numpy()
        return pa.table({"number": pa.array([key[0].as_py()], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    return stage(dealt.select("number", "k", "label", "x", "shift").groupBy("number").applyInArrow(pack, "number int, x binary, y binary"), "quality-groups")


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", use: Column | None = None) -> QualityModel:
    """Learn from all labelled rows that ``use`` (over ``labels``) admits.

    The features of labelled documents are staged in groups; each pass adds up a few thousand numbers a task.
    Without labelled rows of both kinds every document scores ``THRESHOLD``.
    """
    known_labels = sized(stage(labelled_rows(labels, key, label, F.lit(True) if use is None else use), "quality-labels"))
    slim = known(docs, text).select(key, text)
    joined = slim.join(known_labels, slim[key] == known_labels["labelled_key"]).select(key, text, "label")

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch[text])
        rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch[key].cast(pa.string()), batch["label"], rows], names=["k", "label", "x"])

    seen = stage(joined.mapInArrow(per_slice(slices, describe, text), "k string, label int, x array<double>"), "quality-features")
    sizes = {row.label: row.n for row in seen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        k = features(pa.array([""])).shape[1]
        return QualityModel(np.zeros(k), np.ones(k), np.zeros(3 * k))
    n, rare = sum(sizes.values()), min(sizes, key=lambda x: (sizes[x], x))
    groups = grouped_rows(seen.withColumn("rare", F.col("label") == rare), n, sizes[rare])
    mean = summed(groups, lambda x, y, _: x[y < COPY].sum(axis=0)) / n
    spread = np.sqrt(summed(groups, lambda x, y, _: ((x[y < COPY] - mean) ** 2).sum(axis=0)) / n)
    model = QualityModel(mean, np.maximum(spread, 1e-6), np.zeros(0))
    model.weights = newton(lambda at: summed(groups, lambda x, y, number: at(*differences(model.standard(x), y % COPY, number))), 3 * len(mean), ridge=1.0)[1:]
    model.cut = best_quantile(groups, model, n)
    rank = lambda x, y: (model.rank(x[y < COPY])[:, None], (y[y < COPY] > 0).astype(float))
    model.slope = max(1e-3, float(newton(lambda at: summed(groups, lambda x, y, _: at(*rank(x, y))), 1)[1]))
    return model


def best_quantile(groups: DataFrame, model: QualityModel, n: int) -> float:
    """The quantile of the scores of all labelled rows at which the mean accuracy of both labels is highest.

    Scores are counted in bins first; only those in the bins around a quantile go to the driver, each value once.
    """
    extremes = np.stack(gathered(groups, lambda x, y, _: Extremes(model.rank(x[y < COPY]))))
    low, high = -extremes[:, 0].max(), extremes[:, 1].max()
    bin_of = lambda r: np.clip((r - low) * (RANK_BINS / max(high - low, 1e-300)), 0, RANK_BINS - 1).astype(np.int64)
    upto = np.cumsum(summed(groups, lambda x, y, _: np.bincount(bin_of(model.rank(x[y < COPY])), minlength=RANK_BINS).astype(float)))
    place = np.linspace(0.002, 0.998, 499) * (n - 1)
    below = np.floor(place).astype(np.int64)
    wanted = np.zeros(RANK_BINS, bool)
    wanted[np.searchsorted(upto, np.concatenate([below, np.minimum(below + 1, n - 1)]), side="right")] = True
    task = sent(groups.sparkSession, (model, bin_of, wanted))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_model, to_bin, kept = received(task)
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"], strict=True):
                y = np.frombuffer(y.as_buffer(), np.int8)
                r = known_model.rank(np.frombuffer(x.as_buffer(), np.float64).reshape(len(y), -1)[y < COPY])
                yield pa.RecordBatch.from_arrays([pa.array(r[kept[to_bin(r)]])], names=["rank"])

    found = groups.mapInArrow(near, "rank double").groupBy("rank").agg(F.count("*").alias("n")).toArrow().sort_by("rank")
    values, times = found["rank"].to_numpy(), found["n"].to_numpy()
    bins = bin_of(values)
    first = np.searchsorted(bins, bins)  # of the same bin
    running = np.cumsum(times) - times
    before = np.where(bins > 0, upto[bins - 1], 0) + running - running[first]  # scores below each value
    at = lambda i: values[np.searchsorted(before, i, side="right") - 1]
    lower, upper = at(below), at(np.minimum(below + 1, n - 1))
    cuts = lower + (upper - lower) * (place - below)
    edges = len(cuts) + 1
    counts = summed(groups, lambda x, y, _: np.bincount(np.searchsorted(cuts, model.rank(x[y < COPY]), side="right") + edges * (y[y < COPY] > 0), minlength=2 * edges).astype(float))
    bad, good = np.cumsum(counts.reshape(2, edges), axis=1)
    return best_cut(cuts, good, bad)


class Extremes(np.ndarray):
    """The least (negative) and largest of some numbers; adding two of them gives that of both."""

    def __new__(cls, numbers: np.ndarray):
        return np.array([-numbers.min(initial=np.inf), numbers.max(initial=-np.inf)]).view(cls)

    def __add__(self, other):
        return np.maximum(self, other).view(Extremes)


def differences(z: np.ndarray, label: np.ndarray, number: int = 0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Differences of good rows and their bad partners, in either order, and whether the good one comes first; no pairs without rows of both kinds."""
    good, bad = z[label > 0], z[label == 0]
    draw = np.random.default_rng(seed + number)
    pairs = max(len(good), len(bad)) if len(good) and len(bad) else 0
    difference = np.concatenate([good[draw.permutation(np.resize(np.arange(len(good)), pairs))] - bad[draw.permutation(np.resize(np.arange(len(bad)), pairs))] for _ in range(PAIRS_EACH)])
    side = np.where(draw.random(len(difference)) < 0.5, 1.0, -1.0)  # either order of a pair says the same
    return difference * side[:, None], (side > 0).astype(float)


def preferences(good: np.ndarray, bad: np.ndarray, seed: int = 7) -> np.ndarray:
    """Weights that make each ``good`` row score above its ``bad`` partners, by logistic loss on differences."""
    x, y = differences(np.concatenate([good, bad]), np.repeat([1, 0], [len(good), len(bad)]), seed=seed)
    return logistic_fit(x, y, np.ones(len(y)), ridge=1.0)[1:]


def quality_scores(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``quality_score`` (0 to 1) and ``quality_rank`` (the Bradley-Terry score).

    Every text is read whole; null and empty texts score as a text without words. Columns that are called as the new ones are replaced.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("quality_score", "quality_rank")
    names = kept.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(batch[text])
        new = [pa.array(given.value.probability(x)), pa.array(given.value.rank(x))]
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, "quality_score", "quality_rank"])

    return kept.mapInArrow(per_slice(slices, run, text), kept.schema.toDDL() + ", quality_score double, quality_rank double")
