"""Greedy packing of sentences into chunks, and two-level summaries.

Packing is sequential: where a chunk starts depends on all sentences before.
To keep a large group out of one task, each group is cut into ordered blocks of
a fixed number of sentences; a block is reduced to the map "fill level on entry
-> fill level on exit", the small maps of a group are composed as a tree, and
the blocks are then packed at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.constants import CHUNK_CHARS, PARTIAL_CHARS
from starlens.operators.summaries import (
    GROUP, SENTENCE, best_sentences, distinct_sentences, extractive_summary, join_in_order, sentence_corpus, sentence_scores,
)
from starlens.session import stage

# Characters of joined partials that a model is given at once; groups of more are unified in several levels.
UNIFIED_CHARS = 200_000

# Sentences to a block, and blocks to a branch of the tree, as powers of two.
BLOCK_BITS, BRANCH_BITS = 13, 10


def boundaries(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Running size after each sentence, and for a chunk that starts at a sentence the next start."""
    upto = np.cumsum(lengths + 1)
    after = np.searchsorted(upto, limit - lengths + upto, side="right")
    return upto, np.maximum(after, np.arange(1, len(lengths) + 1))


def block_map(block: pd.DataFrame, limit: int) -> tuple[list, list, list, int]:
    """What a block does to a chunk that is open on entry.

    For the k-th sentence as first new start: size up to it, fill level on exit
    and number of starts. The lists end once any entry level would have started
    a chunk. The last value is the size of the whole block.
    """
    lengths = block.sort_values(list(SENTENCE))["chars"].to_numpy(np.int64)
    upto, after = boundaries(lengths, limit)
    m = len(lengths)
    leave, starts = np.empty(m, np.int64), np.empty(m, np.int64)
    for j in range(m - 1, -1, -1):
        k = after[j]
        leave[j] = leave[k] if k < m else lengths[j] + upto[-1] - upto[j]
        starts[j] = 1 + (starts[k] if k < m else 0)
    shown = min(m, max(1, int(np.searchsorted(upto, limit, side="right"))) + 1)
    return upto[:shown].tolist(), leave[:shown].tolist(), starts[:shown].tolist(), int(upto[-1])


def joined_map(blocks: pd.DataFrame, limit: int) -> tuple[list, list, list, int]:
    """What consecutive blocks do together, in the form of ``block_map``."""
    upto, leave, starts, size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for block in blocks.sort_values("block").itertuples():
        next_upto, next_leave, next_starts = (np.asarray(x, np.int64) for x in (block.upto, block.leave, block.starts))
        first = np.searchsorted(next_upto, limit - leave, side="right")
        inside = first < len(next_upto)
        at = np.where(inside, first, 0)
        whole = len(upto) > 1 and upto[-1] > limit  # every entry level has started a chunk by now
        leave, starts = np.where(inside, next_leave[at], leave + block.chars), starts + np.where(inside, next_starts[at], 0)
        if not whole:
            upto, leave, starts = (np.concatenate(x) for x in ((upto, size + next_upto), (leave, next_leave), (starts, next_starts)))
        size += int(block.chars)
    return upto.tolist(), leave.tolist(), starts.tolist(), size


def compose(blocks: pd.DataFrame, limit: int, level: int = -1, chunk: int = 0) -> pd.DataFrame:
    """Fill level and chunk number on entry to each block of one group; level -1 means nothing open."""
    blocks = blocks.sort_values("block")
    entry = []
    for upto, leave, starts, size in zip(blocks["upto"], blocks["leave"], blocks["starts"], blocks["chars"]):
        entry.append((level, chunk))
        if level < 0:
            # Nothing is open: the first sentence never starts a further chunk.
            level = 0
            first = max(1, int(np.searchsorted(upto, limit, side="right")))
        else:
            first = int(np.searchsorted(upto, limit - level, side="right"))
        if first < len(upto):
            level, chunk = int(leave[first]), chunk + int(starts[first])
        else:
            level += int(size)
    levels, numbers = zip(*entry)
    return blocks[[c for c in blocks.columns if c not in ("upto", "leave", "starts", "chars")]].assign(
        level=np.array(levels, np.int64), chunk=np.array(numbers, np.int64)
    )


def number_block(block: pd.DataFrame, limit: int) -> pd.DataFrame:
    """Chunk number of every sentence of a block whose entry level is known."""
    block = block.sort_values(list(SENTENCE)).reset_index(drop=True)
    lengths = block["chars"].to_numpy(np.int64)
    upto, after = boundaries(lengths, limit)
    level, first_chunk = int(block["level"].iloc[0]), int(block["chunk"].iloc[0])
    j = max(1, int(np.searchsorted(upto, limit, side="right"))) if level < 0 else int(
        np.searchsorted(upto, limit - level, side="right")
    )
    marks = np.zeros(len(block), np.int64)
    while j < len(block):
        marks[j] = 1
        j = int(after[j])
    return block.drop(columns=["level", "chunk", "chars"]).assign(chunk_no=first_chunk + np.cumsum(marks))


def chunk_numbers(corpus: DataFrame, keys: Sequence[str] = GROUP, limit: int = CHUNK_CHARS, block_bits: int = BLOCK_BITS, branch_bits: int = BRANCH_BITS) -> DataFrame:
    """Add ``chunk_no`` (from 0 per group) to the sentences of each group.

    A task holds the lengths of one block, the maps of one branch, or of a group one map for each of its branches.
    """
    keys = list(keys)
    # Range partitions are runs of consecutive sentences, and row numbers within them cut these into blocks; written out, both stay fixed.
    ranged = corpus.repartitionByRange(*keys, *SENTENCE).sortWithinPartitions(*keys, *SENTENCE)
    ranged = stage(ranged.withColumn("block", F.shiftright(F.monotonically_increasing_id(), block_bits)).withColumn("chars", F.length("sentence")), "sentences")
    types = {f.name: f.dataType.simpleString() for f in ranged.schema}
    key_types = ", ".join(f"{k} {types[k]}" for k in keys)
    map_types = f"{key_types}, block bigint, upto array<bigint>, leave array<bigint>, starts array<bigint>, chars bigint"
    columns = [*keys, "block", "upto", "leave", "starts", "chars"]

    def one_row(key, values):
        return pd.DataFrame([[*key, *values]], columns=columns)

    maps = stage(ranged.select(*keys, "block", *SENTENCE, "chars").groupBy(*keys, "block").applyInPandas(
        lambda key, block: one_row(key, block_map(block, limit)), map_types
    ), "block-maps").withColumn("branch", F.shiftright("block", branch_bits))
    branches = maps.groupBy(*keys, "branch").applyInPandas(lambda key, blocks: one_row(key, joined_map(blocks, limit)), map_types)
    begins = branches.groupBy(*keys).applyInPandas(lambda blocks: compose(blocks, limit), f"{key_types}, block bigint, level bigint, chunk bigint")
    begins = begins.withColumnsRenamed({"block": "branch", "level": "first_level", "chunk": "first_chunk"})

    def within(blocks):
        first = blocks.iloc[0]
        return compose(blocks[columns], limit, int(first["first_level"]), int(first["first_chunk"]))

    entries = maps.join(begins, [*keys, "branch"]).groupBy(*keys, "branch").applyInPandas(within, f"{key_types}, block bigint, level bigint, chunk bigint")
    sentence_types = ", ".join(f"{c} {types[c]}" for c in SENTENCE)
    # Sentence texts stay in Spark; Python sees lengths and hands back numbers.
    numbers = (
        ranged.select(*keys, "block", *SENTENCE, "chars").join(entries, [*keys, "block"])
        .groupBy(*keys, "block").applyInPandas(
            lambda block: number_block(block, limit), f"{key_types}, block bigint, {sentence_types}, chunk_no bigint"
        )
    )
    return ranged.drop("chars").join(numbers, [*keys, "block", *SENTENCE]).drop("block")


def chunks(corpus: DataFrame, keys: Sequence[str] = GROUP, limit: int = CHUNK_CHARS) -> DataFrame:
    """``keys, chunk_no, chunk``; a chunk is bounded by the limit or a single sentence."""
    ordered = F.array_sort(F.collect_list(F.struct(*SENTENCE, "sentence")))
    text = F.array_join(F.transform(ordered, lambda e: e["sentence"]), " ")
    return chunk_numbers(corpus, keys, limit).groupBy(*keys, "chunk_no").agg(text.alias("chunk"))


def prefix_model() -> Callable[[str], str]:
    """What stands in for a model that fails: the first characters of the text."""
    return lambda chunk: chunk[:PARTIAL_CHARS]


def partial_summaries(chunked: DataFrame, model_factory, keys: Sequence[str] = GROUP) -> DataFrame:
    """One ``partial`` per chunk; the model is built once per task, a failure falls back to the prefix."""
    keys = list(keys)

    def run(batches):
        model, fallback = model_factory(), prefix_model()

        def summarise(chunk):
            try:
                return str(model(chunk))
            except Exception:
                return fallback(chunk)

        for batch in batches:
            yield batch[[*keys, "chunk_no"]].assign(partial=[summarise(c) for c in batch["chunk"]])

    types = {f.name: f.dataType.simpleString() for f in chunked.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", chunk_no bigint, partial string"
    return chunked.select(*keys, "chunk_no", "chunk").mapInPandas(run, schema)


def unified_by_model(partials: DataFrame, model_factory, keys: Sequence[str], limit: int = UNIFIED_CHARS) -> DataFrame:
    """``keys, unified``: the model on the joined partials of each group; null where it fails.

    Partials of more than ``limit`` characters are joined in runs of at most that size (or of two), the model
    is applied to each run, and its results are the partials of the next level, until one remains.
    """
    keys = list(keys)
    types = {f.name: f.dataType.simpleString() for f in partials.schema}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", chunk_no bigint, partial string"

    def run(batches):
        model = model_factory()

        def unify(text, n):
            try:
                return text if n == 1 or text is None else str(model(text))
            except Exception:
                return None

        for batch in batches:
            yield batch[[*keys, "chunk_no"]].assign(partial=[unify(x, n) for x, n in zip(batch["partial"], batch["n"])])

    level = partials.select(*keys, "chunk_no", "partial").dropna(subset=keys)
    length = F.coalesce(F.length("partial"), F.lit(0)) + 1
    while True:
        sizes = level.groupBy(*keys).agg(F.sum(length).alias("chars"), F.max(length).alias("most"), F.count("*").alias("n")).where("n > 1")
        runs = stage(sizes.select(*keys, F.when(F.col("chars") <= limit, F.col("n")).otherwise(F.greatest(F.lit(2), F.floor(limit / F.col("most")))).cast("bigint").alias("run")), "runs")
        if runs.isEmpty():
            return level.select(*keys, F.col("partial").alias("unified"))
        ordered = F.array_sort(F.collect_list(F.struct("chunk_no", "partial")))
        text = F.when(F.count("partial") == F.count("*"), F.array_join(F.transform(ordered, lambda e: e["partial"]), " "))
        placed = level.join(runs, keys, "left").withColumn("place", F.floor(F.col("chunk_no") / F.coalesce("run", F.lit(1))).cast("bigint"))
        joined = placed.groupBy(*keys, "place").agg(text.alias("partial"), F.count("*").alias("n")).withColumnRenamed("place", "chunk_no")
        level = stage(joined.mapInPandas(run, schema), "unified")


def two_level_summary(
    reviews: DataFrame, keys: Sequence[str] = GROUP, model_factory=None, limit: int = CHUNK_CHARS
) -> DataFrame:
    """Summarise each chunk, then unify: a single partial stays, several are given to the model once more, in levels if they are long.

    Without a model every chunk gets its extractive summary, of all its sentences, and several partials are unified in the same way; so they
    are if the model fails on them. A model that fails on a chunk is replaced by the first characters of that chunk.
    """
    keys = list(keys)
    corpus = sentence_corpus(reviews, keys)
    if model_factory is None:
        numbered = chunk_numbers(corpus, keys, limit)
        by_chunk = [*keys, "chunk_no"]
        best = best_sentences(sentence_scores(distinct_sentences(numbered, by_chunk), by_chunk), by_chunk)
        partials = stage(join_in_order(best, by_chunk).withColumnRenamed("summary", "partial"), "partials")
    else:
        partials = stage(partial_summaries(chunks(corpus, keys, limit), model_factory, keys), "partials")
    counts = partials.groupBy(*keys).agg(F.count("*").alias("n_partials"), F.min("partial").alias("single"))
    extracted = extractive_summary(partials.withColumnsRenamed({"chunk_no": "review_id", "partial": "text"}), keys)
    out = counts.join(extracted, keys, "left")
    if model_factory is not None:
        out = out.join(unified_by_model(partials, model_factory, keys), keys, "left").withColumn("summary", F.coalesce("unified", "summary"))
    return out.select(*keys, F.when(F.col("n_partials") == 1, F.col("single")).otherwise(F.coalesce("summary", F.lit(""))).alias("summary"))
