"""Toxic passages by maximum-scoring segment search.

Every word has a log-odds score of toxic against other text. Counts come from
labelled documents under Dirichlet priors: a word starts from the odds of its
first letters, and these from their share of the whole corpus. A linear-time scan
finds all maximal segments of positive total score. Karlin-Altschul statistics
turn segment scores into expected counts in text without toxicity; the best
segment of a document, so calibrated, gives its evidence, and a logistic curve
over the evidence gives its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import LABELLED_ROWS, known, label_sample, logistic_fit, per_slice, sigmoid, with_labels
from starlens.llm.words import Words, slices, words_of

#: Pseudo-counts: of a word at the odds of its beginning; of a beginning at even odds, plus these times its share of the corpus.
WORD_PRIOR = 2.0
HEAD_LEAST = 3.0
HEAD_PRIOR = 200.0
#: Words and word beginnings are counted in 2^BITS buckets each, so the model has one size for every corpus.
BITS = 20
HEAD = 4
#: Standard deviations by which log-odds are drawn towards 0, so that words seen in few documents prove nothing.
CAUTION = 1.5
#: Taken from every score, so that text without toxic words has a negative drift.
DRIFT = 0.5
#: Segments expected less often than this in a document without toxicity are reported.
SIGNIFICANT = 0.01
EVIDENCE_STEP = 0.25
EVIDENCE_MOST = 60.0


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class ToxicModel:
    toxic: np.ndarray  # balanced counts by word bucket
    other: np.ndarray
    head: np.ndarray  # share of toxic in the odds of a word beginning
    decay: float = 0.0  # lambda and K of the segment statistics; decay 0: no word scores above 0
    rate: float = 1.0
    curve: tuple[float, float] = (-3.0, 0.0)

    def scores(self, words: Words) -> np.ndarray:
        at, q = buckets(words.hashes), self.head[buckets(words.heads)]
        toxic, other = self.toxic[at] + WORD_PRIOR * q, self.other[at] + WORD_PRIOR * (1 - q)
        log_odds = np.log(toxic / other)
        sure = np.maximum(np.abs(log_odds) - CAUTION / np.sqrt(toxic + other), 0)
        return np.copysign(sure, log_odds) - DRIFT

    def expected(self, length: float, score: np.ndarray | float) -> np.ndarray | float:
        """How many segments of such a score a document of that many words has without toxicity."""
        return self.rate * length * np.exp(-self.decay * score)

    def evidence(self, length: np.ndarray, best: np.ndarray) -> np.ndarray:
        """-ln of the chance that a document without toxicity has so good a segment; 0 without one."""
        chance = -np.expm1(-self.expected(length, best))
        return np.where((best > 0) & (length > 0), np.minimum(-np.log(np.maximum(chance, 1e-300)), EVIDENCE_MOST), 0.0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return sigmoid(self.curve[0] + self.curve[1] * evidence)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (begin, end, score), in linear time.

    Only words of positive score are visited: each opens a segment that is merged
    with earlier ones as long as this raises the total. ``link`` leads from a segment to the
    last one before it with a lower sum on its left, so no segment is passed twice.
    """
    plus = np.flatnonzero(scores > 0)
    if not len(plus):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    left: list[float] = []
    right: list[float] = []
    begin: list[int] = []
    end: list[int] = []
    link: list[int] = []
    for i, low, high in zip(plus.tolist(), sums[plus].tolist(), sums[plus + 1].tolist(), strict=True):
        first, stop = i, i + 1
        at = len(left) - 1
        while True:
            while at >= 0 and left[at] >= low:
                at = link[at]
            if at < 0 or right[at] >= high:
                break
            low, first = left[at], begin[at]
            del left[at:], right[at:], begin[at:], end[at:]
            before = link[at]
            del link[at:]
            at = before
        left.append(low)
        right.append(high)
        begin.append(first)
        end.append(stop)
        link.append(at)
    return [(b, e, r - x) for b, e, r, x in zip(begin, end, right, left, strict=True)]


def best_scores(model: ToxicModel, words: Words) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int, float]]]]:
    """Length, best segment score and segments (in words of the row) of every row."""
    scores = model.scores(words)
    first = words.first
    lengths = np.diff(first)
    found: list[list[tuple[int, int, float]]] = []
    has = np.add.reduceat(np.append(scores > 0, False).astype(np.int64), np.minimum(first[:-1], len(scores))) if len(lengths) else np.zeros(0)
    for row in range(len(lengths)):
        found.append(maximal_segments(scores[first[row] : first[row + 1]]) if lengths[row] and has[row] else [])
    best = np.array([max((s for _, _, s in x), default=0.0) for x in found])
    return lengths, best, found


def word_counts(labelled: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays of 3 x 2^BITS, for words and for word beginnings: by bucket, how many words all documents have, and how many toxic and other documents have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 3, 1 << BITS), np.int64)
        for batch in batches:
            for low, high in slices(batch[text]):
                part = batch.slice(low, high - low)
                words = words_of(part[text], HEAD)
                label = np.array([-1 if x is None else x for x in part["label"].to_pylist()], np.int64)
                rows = words.rows
                for kind, hashes in enumerate((words.hashes, words.heads)):
                    at = buckets(hashes)
                    sums[kind, 0] += np.bincount(at, minlength=1 << BITS)
                    for column, want in ((1, 1), (2, 0)):
                        if (mine := label[rows] == want).any():
                            once = np.unique((rows[mine] << BITS) | at[mine]) & ((1 << BITS) - 1)
                            sums[kind, column] += np.bincount(once, minlength=1 << BITS)
        kind, bucket = np.nonzero(sums[:, 0])
        names = ["kind", "bucket", "n_all", "n_toxic", "n_other"]
        columns = [kind.astype(np.int32), bucket.astype(np.int32), *(sums[kind, c, bucket] for c in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    table = (
        labelled.mapInArrow(count, "kind int, bucket int, n_all long, n_toxic long, n_other long")
        .groupBy("kind", "bucket").agg(*(F.sum(c).alias(c) for c in ("n_all", "n_toxic", "n_other"))).toArrow()
    )
    out = np.zeros((2, 3, 1 << BITS))
    for c, name in enumerate(("n_all", "n_toxic", "n_other")):
        out[table["kind"].to_numpy(), c, table["bucket"].to_numpy()] = table[name].to_numpy()
    return out[0], out[1]


def odds(words: np.ndarray, heads: np.ndarray) -> ToxicModel:
    """The word model out of the counts (all, toxic, other) of words and word beginnings."""
    totals = np.maximum(words[1:].sum(axis=1), 1)
    even = totals.min() / totals
    prior = HEAD_LEAST + HEAD_PRIOR * heads[0] / max(1.0, heads[0].sum())
    toxic, other = heads[1] * even[0] + prior, heads[2] * even[1] + prior
    q = toxic / (toxic + other)
    return ToxicModel((words[1] * even[0]).astype(np.float32), (words[2] * even[1]).astype(np.float32), np.clip(q, 1e-4, 1 - 1e-4).astype(np.float32))


def decay_of(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lambda x)] = 1 over a distribution of word scores; 0 if it has none."""
    share = counts / max(1.0, counts.sum())
    if not (share[values > 0] > 0).any() or share @ values >= 0:
        return 0.0
    excess = lambda x: share @ np.exp(np.minimum(x * values, 700)) - 1
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", use: Column | None = None, limit: int = LABELLED_ROWS) -> ToxicModel:
    """Learn from the labelled rows that ``use`` (over ``labels``) admits, about ``limit`` of them at most.

    The labels are joined by broadcast: ``limit`` bounds them. Word totals cover all documents. Without
    labelled rows of both kinds every document scores the same low value.
    """
    spark = docs.sparkSession
    sample = label_sample(labels, key, label, F.lit(True) if use is None else use, limit)
    slim = known(docs, text).select(key, text)
    model = odds(*word_counts(with_labels(slim, sample, key).select(text, "label"), text))
    sent = spark.sparkContext.broadcast(model)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(batch[text], HEAD)
        scores = np.round(sent.value.scores(words) * 64).astype(np.int64)
        label = np.array(batch["label"].to_pylist(), np.int64)
        kinds = label[words.rows]
        parts = [np.unique(scores[kinds == k], return_counts=True) for k in (0, 1)]
        value, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        marks = np.repeat([-1, -2], [len(x) for x, _ in parts])
        lengths, best, _ = best_scores(sent.value, words)
        known_rows = len(lengths)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[label, marks].astype(np.int32)),
                pa.array(np.r_[np.round(best * 64).astype(np.int64), value]),
                pa.array(np.r_[np.round(np.log2(np.maximum(lengths, 1)) * 8).astype(np.int64), np.zeros(len(value), np.int64)]),
                pa.array(np.r_[np.ones(known_rows, np.int64), count]),
            ],
            names=["label", "score", "length", "n"],
        )

    # labels -1 and -2: words of other and of toxic texts by score; 0 and 1: documents by best segment and length, all in steps
    joined = slim.join(F.broadcast(sample), slim[key] == sample["labelled_key"]).select(text, "label")
    seen = joined.mapInArrow(per_slice(slices, measure, text), "label int, score long, length long, n long").groupBy("label", "score", "length").agg(F.sum("n").alias("n")).toArrow()
    kind, score, length, n = (seen[c].to_numpy() for c in ("label", "score", "length", "n"))
    score, length = score / 64, 2.0 ** (length / 8)
    plus = (kind == -2) & (score > 0)  # half a word of the toxic ones is granted to the other texts, which may have none
    granted = n[plus] * (0.5 / max(1, n[plus].sum()))
    model.decay = decay_of(np.r_[score[kind == -1], score[plus]], np.r_[n[kind == -1], granted])
    clean = kind == 0
    if model.decay:
        model.rate = float(n[clean].sum() / max(1e-12, n[clean] @ (length[clean] * np.exp(-model.decay * score[clean]))))
    rows = kind >= 0
    if model.decay and n[kind == 1].sum():
        evidence = np.round(model.evidence(length[rows], score[rows]) / EVIDENCE_STEP) * EVIDENCE_STEP
        fitted = logistic_fit(evidence[:, None], (kind[rows] == 1).astype(float), n[rows].astype(float))
        model.curve = (float(fitted[0]), max(0.0, float(fitted[1])))
    return model


def toxic_passages(docs: DataFrame, model: ToxicModel, text: str = "text", significant: float = SIGNIFICANT) -> DataFrame:
    """All columns of ``docs`` with score, evidence and the significant toxic passages, best first.

    A passage has its text, its bytes in the text's UTF-8 form, its score and how often such a passage is
    expected without toxicity. Every text is read whole; null and empty texts have no passage and the lowest score. Equal texts
    score alike. Columns that are called as the new ones are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    passage = "array<struct<passage:string,begin:long,end:long,score:double,expected:double>>"
    fresh = {"toxic_score": "double", "toxic_evidence": "double", "toxic_passages": passage}
    kept = docs.drop(*fresh)
    names = kept.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(batch[text], HEAD)
        lengths, best, found = best_scores(sent.value, words)
        evidence = sent.value.evidence(lengths, best)
        listed = []
        for row, segments in enumerate(found):
            mine = []
            for b, e, s in segments:
                expected = float(sent.value.expected(lengths[row], s))
                if expected <= significant:
                    low, high = int(words.begin[words.first[row] + b]), int(words.end[words.first[row] + e - 1])
                    start = int(words.offsets[row])
                    mine.append({"passage": bytes(words.data[low:high]).decode("utf-8", "replace"), "begin": low - start, "end": high - start, "score": float(s), "expected": expected})
            listed.append(sorted(mine, key=lambda x: (-x["score"], x["begin"])))
        kind = pa.list_(pa.struct([("passage", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
        new = [pa.array(sent.value.probability(evidence)), pa.array(evidence), pa.array(listed, kind)]
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), *new], names=[*names, *fresh])

    schema = ", ".join([kept.schema.toDDL(), *(f"{c} {kind}" for c, kind in fresh.items())])
    return kept.mapInArrow(per_slice(slices, run, text), schema)
