"""Near-duplicate join on word shingles with Bayesian candidate pruning.

Equal texts are one class. Classes that agree in some band of MinHash values are candidates. The values of two candidates are
compared in steps; after each step the pair is dropped if the posterior probability that its similarity reaches the threshold,
under a uniform prior, is below a tolerance. What is left is verified exactly on the sets of shingles.

No pair is ever written out. Inside a bucket, tests only look for pairs that connect something new, so groups of near copies take
linear time; the connected candidates form groups, inside of which every pair is tested. Large buckets and groups are cut in blocks and
every two blocks meet in one task, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, per_slice, sized
from starlens.llm.components import components
from starlens.llm.words import mix, shingles, slices, words_of
from starlens.session import stage

SHINGLE, THRESHOLD = 5, 0.8
#: Bands x values per band: at similarity 0.8 a pair agrees in no band with chance 3e-6.
BANDS, BAND = 32, 5
HASHES = BANDS * BAND
#: MinHash values compared between two prunings, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 32, 1e-6
#: Classes to a block of a bucket and of a group.
BUCKET_BLOCK, GROUP_BLOCK = 2048, 1024
#: Shingles of a group's matrix that are multiplied at once, and pairs below which sets are compared one by one.
COLUMNS, FEW = 4096, 2000
_draw = np.random.default_rng(20)
FACTORS = _draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
MASKS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each step, the fewest equal values with which a pair may still reach the threshold.

    With m of n values equal and a uniform prior, the similarity s has a Beta(m + 1, n - m + 1) posterior, so P(s >= t) is the
    chance of at most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of shingles (repeats counted) of each text, and the low halves of its MinHash values."""
    values, first = shingles(words_of(texts), SHINGLE)
    counts = np.diff(first)
    out = np.zeros((len(counts), HASHES), np.uint16)
    some = np.flatnonzero(counts)
    if len(some):
        h = (values >> np.uint64(32)).astype(np.uint32)
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat((h ^ MASKS[k]) * FACTORS[k], first[some]).astype(np.uint16)
    return counts, out


def bands_of(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row."""
    value = np.zeros((len(signature), BANDS), np.uint64)
    for k in range(BAND):
        value = value * np.uint64(0x9E3779B97F4A7C15) + signature[:, k::BAND].astype(np.uint64)
    return mix(value + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)).view(np.int64)


def may_reach(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of two arrays of signatures survive the incremental comparison (rows of either are broadcast)."""
    n = max(len(a), len(b))
    live, equal = np.arange(n), np.zeros(n, np.int64)
    pick = lambda x, rows: x if len(x) == 1 else x[rows]
    for k, need in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        equal += (pick(a[:, part], live) == pick(b[:, part], live)).sum(axis=1)
        stay = equal >= need
        live, equal = live[stay], equal[stay]
        if not len(live):
            break
    out = np.zeros(n, bool)
    out[live] = True
    return out


def connecting(signature: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]) -> list[tuple[int, int]]:
    """A spanning set of the surviving pairs between the rows ``left`` and ``right``; pairs already connected are not tested."""
    label = np.arange(len(signature))
    out = []
    for i in left:
        others = right[label[right] != label[i]]
        if not len(others):
            continue
        hits = others[may_reach(signature[i : i + 1], signature[others], least)]
        if len(hits):
            _, first = np.unique(label[hits], return_index=True)
            out += [(int(i), int(hits[f])) for f in first]
            joined = np.isin(label, np.append(label[hits], label[i]))
            label[joined] = label[i]
    return out


def in_blocks(rows: DataFrame, group: str, size: str, block: int, item: str) -> DataFrame:
    """The rows of each group dealt to blocks of about ``block`` rows, each row once for every pair of blocks that has its own.

    Adds block_a <= block_b, the pair, and ``second``: whether the row belongs to block_b of two different ones. Rows lie
    together and in order of group and pair in a partition.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(item), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("block_a"), F.greatest(own, j).alias("block_b"), (own > j).alias("second")))
    return rows.withColumn("pair", F.explode(pairs)).select("*", "pair.*").drop("pair").repartition(group, "block_a", "block_b").sortWithinPartitions(group, "block_a", "block_b", "second", item)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str], run: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Call ``run`` with whole groups of a sorted stream: a table and the bounds of its groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held)
        edges = bounds(table, keys)
        if len(edges) > 2:  # the last group may go on in the next batch
            yield from run(table.slice(0, int(edges[-2])).combine_chunks(), edges[:-1])
            held = table.slice(int(edges[-2])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from run(table, bounds(table, keys))


def bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    n = table.num_rows
    change = np.zeros(n + 1, bool)
    change[[0, n]] = True
    for key in keys:
        values = table[key].to_numpy()
        change[1:n] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, HASHES)


def classes_of(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows (key, text_key, shingled) and their classes of equal text (class, text_key, first key, copies, signature)."""
    slim = known(docs, text).select(F.col(key).alias("k"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("text_key"), F.col(text).alias("t"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, values = signatures(batch["t"])
        coded = pa.array([x.tobytes() if n else None for x, n in zip(values, counts, strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([batch["k"], batch["text_key"], coded], names=["k", "text_key", "signature"])

    kind = slim.schema["k"].dataType.simpleString()
    rows = stage(slim.mapInArrow(per_slice(slices, run, "t"), f"k {kind}, text_key binary, signature binary"), "jaccard-rows")
    equal = rows.where(F.col("signature").isNotNull()).groupBy("text_key").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"))
    return rows.select("k", "text_key", F.col("signature").isNotNull().alias("shingled")), stage(equal.withColumn("class", F.monotonically_increasing_id()), "jaccard-classes")


def candidate_groups(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(class, group) of all classes that the pruned candidates connect to others."""
    least = least_matches(threshold, tolerance)

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = bands_of(matrix(pa.Table.from_batches([batch])))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch["class"].to_numpy(), BANDS))], names=["bucket", "class"])

    bands = classes.select("class", "signature").mapInArrow(banded, "bucket long, class long")
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = bands.join(shared, "bucket").join(classes.select("class", "signature"), "class")

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            ids, second, signature = table["class"].to_numpy(), table["second"].to_numpy(), matrix(table)
            sizes = np.diff(edges)
            two = edges[:-1][(sizes == 2)]
            two = two[~second[two] & ~second[two + 1] | (second[two] != second[two + 1])]
            hits = two[may_reach(signature[two], signature[two + 1], least)] if len(two) else two
            a, b = [ids[hits]], [ids[hits + 1]]
            for low, high in zip(edges[:-1][sizes > 2], edges[1:][sizes > 2], strict=True):
                rows = np.arange(high - low)
                side = second[low:high]
                apart = table["block_a"][int(low)].as_py() != table["block_b"][int(low)].as_py()
                found = connecting(signature[low:high], rows[~side] if apart else rows, rows[side] if apart else rows, least)
                if found:
                    pairs = np.array(found) + low
                    a.append(ids[pairs[:, 0]])
                    b.append(ids[pairs[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        yield from by_group(batches, ["bucket", "block_a", "block_b"], run)

    blocks = in_blocks(rows, "bucket", "size", BUCKET_BLOCK, "class").select("bucket", "block_a", "block_b", "second", "class", "signature")
    return components(blocks.mapInArrow(tested, "a long, b long"), "candidates").select(F.col("node").alias("class"), F.col("component").alias("group"))


def exact_links(sets: list[np.ndarray], signature: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float, least: list[int]) -> np.ndarray:
    """A matrix left x right of which pairs have the similarity, out of the pairs that the pruning leaves."""
    live = np.zeros((len(left), len(right)), bool)
    for n, i in enumerate(left):
        live[n] = may_reach(signature[i : i + 1], signature[right], least)
    live &= left[:, None] != right[None, :]
    size = np.array([len(x) for x in sets])
    reach = lambda both, a, b: both >= threshold * (size[a] + size[b] - both) - 1e-9
    if live.sum() <= FEW:
        for n, m in zip(*np.nonzero(live), strict=True):
            i, j = left[n], right[m]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            live[n, m] = reach(both, i, j)
        return live
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(code, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    owner = np.repeat(np.arange(len(sets)), size)
    use = often[code]
    owner, code = owner[use], column[code[use]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(code, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], code[a:b] - low] = 1
        both += part[left] @ part[right].T
    return live & reach(both.astype(np.float64), left[:, None], right[None, :])


def verified(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(class, other, links): per block pair each class's links by copies, with ``other`` null, and edges that connect all linked classes."""
    least = least_matches(threshold, tolerance)

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            ids, second, copies, signature = table["class"].to_numpy(), table["second"].to_numpy(), table["copies"].to_numpy(), matrix(table)
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                rows, side = np.arange(high - low), second[low:high]
                apart = table["block_a"][int(low)].as_py() != table["block_b"][int(low)].as_py()
                left, right = (rows[~side], rows[side]) if apart else (rows, rows)
                if not len(left) or not len(right):
                    continue
                texts = table["t"].slice(int(low), int(high - low)).combine_chunks()
                sets = []
                for a, b in slices(texts):
                    values, first = shingles(words_of(texts.slice(a, b - a)), SHINGLE)
                    sets += [np.unique(values[first[i] : first[i + 1]]) for i in range(b - a)]
                hit = exact_links(sets, signature[low:high], left, right, threshold, least)
                n = hit @ copies[low:high][right]
                label, own, other = np.arange(high - low), [], []
                for k in range(len(left)):
                    mine = right[hit[k]]
                    new = mine[label[mine] != label[left[k]]]
                    if len(new):
                        _, at = np.unique(label[new], return_index=True)
                        own += [left[k]] * len(at)
                        other += new[at].tolist()
                        label[np.isin(label, np.append(label[new], label[left[k]]))] = label[left[k]]
                some = left[n > 0]
                counts = n[n > 0]
                if apart:
                    m = copies[low:high][left] @ hit
                    some, counts = np.append(some, right[m > 0]), np.append(counts, m[m > 0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[low:high][np.append(some, np.array(own, np.int64))]), pa.array([None] * len(some) + ids[low:high][np.array(other, np.int64)].tolist(), pa.int64()),
                        pa.array(np.append(counts, np.zeros(len(own))).astype(np.int64)),
                    ],
                    names=["class", "other", "links"],
                )

        yield from by_group(batches, ["group", "block_a", "block_b"], run)

    blocks = in_blocks(members, "group", "size", GROUP_BLOCK, "class").select("group", "block_a", "block_b", "second", "class", "copies", "signature", "t")
    return blocks.mapInArrow(tested, "class long, other long, links long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: key, class_id, n_links, n_copies, text_key.

    ``n_links`` counts the other documents whose sets of five-word shingles have at least the similarity ``threshold``,
    ``n_copies`` those of the same text. ``class_id`` is the smallest key among all documents connected by links. A text of one to four words has one
    shingle of all of them; null texts and texts without words have no links and their own key as class. Repeated rows are copies of each other.
    """
    rows, classes = classes_of(docs, key, text)
    groups = stage(candidate_groups(classes, threshold, tolerance), "jaccard-groups")
    size = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    members = stage(groups.join(size, "group").join(classes.drop("signature"), "class"), "jaccard-members")
    slim = known(docs, text).select(F.col(key).alias("first"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("text_key"), F.col(text).alias("t"))
    near = sized(members.select("text_key", "first", "class"))
    texts = slim.join(near, (slim["text_key"] == near["text_key"]) & slim["first"].eqNullSafe(near["first"])).groupBy("class").agg(F.first("t").alias("t"))
    whole = texts.join(members.select("class", "group", "size", "copies"), "class").join(classes.select("class", "signature"), "class")
    found = stage(verified(whole, threshold, tolerance), "jaccard-links")
    links = found.where(F.col("other").isNull()).groupBy("class").agg(F.sum("links").alias("links"))
    linked = stage(components(found.where(F.col("other").isNotNull()).select(F.col("class").alias("a"), F.col("other").alias("b")), "links"), "jaccard-components")
    least = linked.join(classes.select(F.col("class").alias("node"), "first"), "node").groupBy("component").agg(F.min("first").alias("class_id"))
    of_class = (
        classes.select("text_key", "class", "first", "copies")
        .join(linked.join(least, "component").select(F.col("node").alias("class"), "class_id"), "class", "left").join(links, "class", "left")
        .select("text_key", F.coalesce("class_id", "first").alias("class_id"), (F.col("copies") - 1).alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    out = rows.join(stage(of_class, "jaccard-result"), "text_key", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("k").alias(key), F.when(F.col("shingled"), F.col("class_id")).otherwise(F.col("k")).alias("class_id"), F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_copies", zero).alias("n_copies"), "text_key"
    )
