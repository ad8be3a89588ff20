"""Hard negatives by angular triangle filtering.

Every vector is stored with its angles to a few reference directions. The angle between two vectors lies between the
difference of their angles to a direction and the sum of them, which gives an interval for the cosine and, times both norms, for
the product. Only rows whose interval, widened for rounding, meets the window of scores that is looked for are
multiplied, in integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import sized
from starlens.session import stage

#: Components of candidates and of anchors that one task holds at once.
CANDIDATE_VALUES = 1 << 20
ANCHOR_VALUES = 1 << 17
#: Anchors whose intervals are computed together.
SLICE = 32
#: Reference directions for each width, learned from about so many rows; they change the work and never the result.
DIRECTIONS = 16
SAMPLE_ROWS = 4_096
#: More than the error of an angle in 64-bit floats, in radians, and of a product in shares of both norms.
ANGLE_SLACK = 2e-6
SCORE_SLACK = 1e-9
LARGEST = (1 << 63) - 1


def integer_rows(vectors: DataFrame, is_anchor: Column, key: str, label: str, vector: str, scale: float) -> DataFrame:
    """(key, label, width, v, is_anchor): floor(scale * x) of each component, one row a key.

    Null keys and labels and vectors that are null, empty or hold null or non-finite components are left out. Of several rows of a key the one of the
    smallest (label, v) counts. Components beyond 64 bits become the nearest 64-bit integer.
    """
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    usable = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    rows = vectors.where(usable).select(F.col(key).cast("long").alias("key"), F.struct(F.col(label).cast("long").alias("label"), v.alias("v"), is_anchor.alias("is_anchor")).alias("row"))
    return rows.groupBy("key").agg(F.min("row").alias("row")).select("key", "row.label", F.size("row.v").alias("width"), "row.v", "row.is_anchor")


def directions(rows: DataFrame, total: int, count: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """Unit vectors near which the rows of each width lie: spherical k-means over a hash sample of about ``SAMPLE_ROWS`` rows."""
    slots = 1 << 20
    share = min(slots, slots * SAMPLE_ROWS // max(1, total))
    sample = rows.where(F.pmod(F.xxhash64("key", F.lit("directions")), F.lit(slots)) < share).select("key", "v").collect()
    found = {}
    for width in sorted({len(r.v) for r in sample}):
        x = unit(np.array([r.v for r in sorted(sample, key=lambda r: r.key) if len(r.v) == width], float))
        x = x[np.abs(x).sum(axis=1) > 0]
        if not len(x):
            continue
        centres = [x[0]]
        nearest = x @ x[0]
        while len(centres) < min(count, len(x)):  # the row farthest from all so far
            centres.append(x[int(nearest.argmin())])
            nearest = np.maximum(nearest, x @ centres[-1])
        c = np.array(centres)
        for _ in range(5):
            mine = (x @ c.T).argmax(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, mine, x)
            c = np.where((np.abs(sums).sum(axis=1) > 0)[:, None], unit(sums), c)
        found[width] = c
    return found


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def with_angles(rows: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``norm`` and ``angles`` to the directions of the row's width (none if it has none)."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            widths = batch["width"].to_numpy()
            norms, angles = np.zeros(len(widths)), [[]] * len(widths)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                x = matrix(batch["v"].take(pa.array(at)), int(width)).astype(float)
                norms[at] = np.sqrt((x * x).sum(axis=1))
                if width in known:
                    for i, a in zip(at, np.arccos(np.clip(unit(x) @ known[width].T, -1, 1)), strict=True):
                        angles[i] = a
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(norms), pa.array(angles, pa.list_(pa.float64()))], names=[*names, "norm", "angles"])

    return rows.mapInArrow(run, f"{rows.schema.toDDL()}, norm double, angles array<double>")


def matrix(lists, width: int) -> np.ndarray:
    """Lists of one length as a matrix."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


class Side:
    """Vectors of one width with what is stored of them; anchors in an order in which neighbours are alike."""

    def __init__(self, table: pa.Table, ordered: bool = False):
        self.keys, self.labels, self.norm = (table[c].to_numpy() for c in ("key", "label", "norm"))
        self.v = matrix(table["v"], int(table["width"][0].as_py()))
        self.angles = matrix(table["angles"], len(table["angles"][0].as_py()))
        self.rows = np.arange(len(self.keys))
        if ordered and self.angles.shape[1]:
            self.rows = np.lexsort((self.angles.min(axis=1), self.angles.argmin(axis=1)))


def bounds(anchors: Side, at: np.ndarray, others: Side) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest products that the angles of the anchors ``at`` and all others allow."""
    low = np.zeros((len(at), len(others.keys)))
    high = np.full_like(low, math.pi)
    for a, x in zip(anchors.angles[at].T, others.angles.T, strict=True):
        total = a[:, None] + x
        np.maximum(low, np.abs(a[:, None] - x), out=low)
        np.minimum(high, np.minimum(total, 2 * math.pi - total), out=high)
    norms = anchors.norm[at][:, None] * others.norm
    slack = SCORE_SLACK * norms + 1
    most = np.cos(np.maximum(low - ANGLE_SLACK, 0)) * norms + slack
    least = np.cos(np.minimum(high + ANGLE_SLACK, math.pi)) * norms - slack
    return np.clip(least, -float(LARGEST), float(LARGEST)), np.clip(most, -float(LARGEST), float(LARGEST))


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows; those beyond 64 bits become the nearest of -LARGEST and LARGEST."""
    largest = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    most = largest(a) * largest(x) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(float) @ x.T.astype(float)).astype(np.int64)
    if most <= LARGEST:
        return a @ x.T
    return np.clip(a.astype(object) @ x.T.astype(object), -LARGEST, LARGEST).astype(np.int64)


def best_positives(anchors: Side, others: Side, count: int) -> dict[str, list]:
    """Each anchor's ``count`` best rows of a group of its label."""
    out: dict[str, list] = {"anchor": [], "positive": [], "positive_score": []}
    for start in range(0, len(anchors.rows), SLICE):
        at = anchors.rows[start : start + SLICE]
        least, most = bounds(anchors, at, others)
        own = anchors.keys[at][:, None] == others.keys
        least[own] = most[own] = -np.inf
        if len(others.keys) > count:  # so many rows surely reach the floor
            floor = np.partition(least, -count, axis=1)[:, -count]
            wanted = (most >= floor[:, None]) & ~own
        else:
            wanted = ~own
        some = np.flatnonzero(wanted.any(axis=0))
        scores = products(anchors.v[at], others.v[some])
        for i, a in enumerate(at):
            mine = wanted[i, some]
            keys, s = others.keys[some[mine]], scores[i, mine]
            if len(s) > 4 * count:
                near = s >= np.partition(s, len(s) - count)[len(s) - count]
                keys, s = keys[near], s[near]
            top = np.lexsort((keys, -s))[:count]
            out["anchor"] += [anchors.keys[a]] * len(top)
            out["positive"] += keys[top].tolist()
            out["positive_score"] += s[top].tolist()
    return out


def best_negatives(anchors: Side, windows: list, others: Side, count: int, low: int, high: int) -> dict[str, list]:
    """Each anchor's ``count`` best rows of other labels in the window of each of its positives."""
    out: dict[str, list] = {"anchor": [], "positive": [], "positive_score": [], "negative": [], "negative_score": []}
    ends = [[(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in w] for w in windows]
    for start in range(0, len(anchors.rows), SLICE):
        at = anchors.rows[start : start + SLICE]
        least, most = bounds(anchors, at, others)
        first, last = (np.array([f(e[side] for e in ends[a]) for a in at], float)[:, None] for f, side in ((min, 0), (max, 1)))
        wanted = (most >= first) & (least <= last) & (anchors.labels[at][:, None] != others.labels) & (anchors.keys[at][:, None] != others.keys)
        some = np.flatnonzero(wanted.any(axis=0))
        scores = products(anchors.v[at], others.v[some])
        for i, a in enumerate(at):
            keys, s = others.keys[some], scores[i]
            inside = wanted[i, some] & (s >= min(e[0] for e in ends[a])) & (s <= max(e[1] for e in ends[a]))
            keys, s = keys[inside], s[inside]
            order = np.lexsort((keys, -s))
            keys, s = keys[order], s[order]
            for window, (least_s, most_s) in zip(windows[a], ends[a], strict=True):
                top = np.flatnonzero(s <= most_s)[:count]
                top = top[s[top] >= least_s]
                out["anchor"] += [anchors.keys[a]] * len(top)
                out["positive"] += [window["positive"]] * len(top)
                out["positive_score"] += [window["positive_score"]] * len(top)
                out["negative"] += keys[top].tolist()
                out["negative_score"] += s[top].tolist()
    return out


def arrow(found: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})


def ranked(found: DataFrame, by: tuple[str, ...], score: str, key: str, count: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0, positives: int = 5,
    negatives: int = 10, low: int = 30, high: int = 90, candidate_values: int = CANDIDATE_VALUES, anchor_values: int = ANCHOR_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``key``. An anchor's positives are its ``positives`` best other rows of its (integer) label; the negatives of
    each are the ``negatives`` best rows of other labels with ``low`` <= 100 * negative / positive <= ``high`` in integers (so a positive below 0 has
    none). Scores are integer inner products, ties go to the smaller key; vectors of another width have no product. An empty table gives no row.
    What takes no part is told in ``integer_rows``. Scores beyond 64 bits count as 2^63 - 1 of their sign.

    Candidates lie in groups of ``candidate_values`` components by a hash of the key (for the positives within their label, so a label of any size
    spreads), anchors in blocks of ``anchor_values``; each block meets each group once, and a group gives no more than its best rows for each anchor.
    """
    plain = stage(integer_rows(vectors, is_anchor, key, label, vector, scale), "integer-rows")
    rows = stage(with_angles(plain, directions(plain, plain.count())), "angles")
    chosen = rows.where("is_anchor")

    def sizes(df: DataFrame, by: tuple[str, ...], values: int, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.ceil(F.count("*") * F.col("width") / F.lit(values)).cast("int").alias(name))

    def meeting(kind: tuple[str, ...], others: DataFrame, anchors: DataFrame):
        """Each group of candidates beside each block of anchors of the same kind."""
        shares = stage(sizes(rows, kind, candidate_values, "groups").join(sizes(chosen, kind, anchor_values, "blocks"), list(kind)), "shares")
        shares = sized(shares)
        number = lambda name: F.pmod(F.xxhash64("key", F.lit(name)), F.col(name)).cast("int")
        every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
        dealt = others.join(shares, list(kind)).withColumn("group", number("groups")).withColumn("block", every("blocks")).drop("groups", "blocks")
        asked = anchors.join(shares, list(kind)).withColumn("block", number("blocks")).withColumn("group", every("groups")).drop("groups", "blocks")
        asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # both sides may come from one table
        by = [*kind, "group", "block"]
        return asked.groupBy(*by).cogroup(dealt.groupBy(*by))

    def positive_rows(asked: pa.Table, dealt: pa.Table) -> pa.Table:
        if not asked.num_rows or not dealt.num_rows:
            return arrow({"anchor": [], "positive": [], "positive_score": []})
        return arrow(best_positives(Side(asked, ordered=True), Side(dealt), positives))

    def negative_rows(asked: pa.Table, dealt: pa.Table) -> pa.Table:
        if not asked.num_rows or not dealt.num_rows:
            return arrow({"anchor": [], "positive": [], "positive_score": [], "negative": [], "negative_score": []})
        return arrow(best_negatives(Side(asked, ordered=True), asked["windows"].to_pylist(), Side(dealt), negatives, low, high))

    near = meeting(("label", "width"), rows, chosen).applyInArrow(positive_rows, "anchor long, positive long, positive_score long")
    windows = (
        ranked(near, ("anchor",), "positive_score", "positive", positives).where(F.col("positive_score") >= 0)
        .groupBy(F.col("anchor").alias("key")).agg(F.sort_array(F.collect_list(F.struct("positive", "positive_score"))).alias("windows"))
    )
    asked = stage(chosen.join(windows, "key"), "asked")
    schema = "anchor long, positive long, positive_score long, negative long, negative_score long"
    found = meeting(("width",), rows, asked).applyInArrow(negative_rows, schema)
    return ranked(found, ("anchor", "positive"), "negative_score", "negative", negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", "negative_score"
    )
