"""Extractive summaries per group of reviews.

Sentences lie in blocks of bounded size, and a block and the rest of its group
meet by its different terms. One large group spreads over many blocks: no task
and no row ever holds the texts of a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlens.constants import (
    MAX_SENTENCE_SHARE, MIN_CATEGORY_REVIEWS, RATINGS, REVIEWS_PER_RATING, SENTENCE_CHARS, SUMMARY_SENTENCES,
    TOP_CATEGORIES,
)
from starlens.functions.text import sentence_terms, sentences
from starlens.operators.categories import rating_columns, rating_rows
from starlens.operators.features import BROADCAST_ROWS
from starlens.operators.sampling import first_per_group, group_sample
from starlens.session import drop_shuffles, stage, unstage

GROUP = ("category", "rating")
SENTENCE = ("review_id", "pos")
# Words to a block of sentences, about.
BLOCK_WORDS = 1 << 20


def sentence_corpus(reviews: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """All sentences of each group; ``review_id, pos`` is their order."""
    return reviews.select(*keys, "review_id", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))


def distinct_sentences(corpus: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Sentences of 30 to 400 characters, the first of each spelling in any case."""
    low, high = SENTENCE_CHARS
    fitting = corpus.where(F.length("sentence").between(low, high))
    first = F.min(F.struct("review_id", "pos", "sentence")).alias("first")
    # Sorted and shuffled by digest: a spelling is as long as the sentence that goes with it.
    return fitting.groupBy(*keys, F.unhex(F.sha2(F.lower("sentence"), 256)).alias("norm")).agg(first).select(*keys, "first.*")


def staged_sentences(sents: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    staged = stage(sents.select(*keys, *SENTENCE, "sentence"), "sentences")
    drop_shuffles(sents.sparkSession)
    return staged


def staged_blocks(sents: DataFrame, keys: Sequence[str] = GROUP, words: int = BLOCK_WORDS) -> DataFrame:
    """The sentences of a staged table, without their texts, in blocks of consecutive ones, and the terms of each block, in one staged table.

    A sentence has its ``unit`` (sentences of one group, id and place are one) and the ``slots`` of its terms with their
    counts ``tfs``; rows with a ``term`` say which term of which group a slot of the block stands for and in how many
    sentences of the block it is (``df``). A block is closed once it has ``words`` words.
    """
    keys = list(keys)
    names = [*keys, *SENTENCE]
    # Runs of a group in its order: a block has few groups, so most of their terms serve many of its sentences.
    ranged = sents.select(*names, "sentence").repartitionByRange(*names).sortWithinPartitions(*names)
    given = ranged.select(*names, sentence_terms(F.col("sentence")).alias("words"))
    types = {f.name: f.dataType.simpleString() for f in given.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            # A block ends where a sentence begins, never between two of one id and place.
            if size >= words:
                table = pa.Table.from_batches(held)
                last = int(np.flatnonzero(np.append(True, changes(table, names)))[-1])
                yield from block_rows(table.slice(0, last), keys, block)
                block, held = block + 1, table.slice(last).to_batches()
                size = sum(len(x["words"].flatten()) for x in held)
            held.append(batch)
            size += len(batch["words"].flatten())
        if held:
            yield from block_rows(pa.Table.from_batches(held), keys, block)

    blocks = stage(given.mapInArrow(run, f"{schema}, block bigint, unit int, slots array<int>, tfs array<int>, term string, slot int, df bigint"), "sentence-blocks")
    drop_shuffles(sents.sparkSession)
    return blocks


def codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values, and nulls, have equal numbers."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def changes(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Where a row differs from the one before it, from the second row on."""
    out = np.zeros(max(0, table.num_rows - 1), bool)
    for name in names:
        coded = codes(table[name])
        out |= coded[1:] != coded[:-1]
    return out


def block_rows(table: pa.Table, keys: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """The rows of one block: its sentences, then its terms."""
    n = table.num_rows
    if not n:
        return
    names = [*keys, *SENTENCE]
    unit = np.concatenate([[0], np.cumsum(changes(table, names))]).astype(np.int32)
    group = np.concatenate([[0], np.cumsum(changes(table, keys))])
    words = table["words"].combine_chunks()
    coded = words.flatten().dictionary_encode()
    spread = max(1, len(coded.dictionary))
    rows = np.repeat(np.arange(n), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    entry, tfs = np.unique(rows * spread + coded.indices.to_numpy(), return_counts=True)
    row, term = entry // spread, entry % spread
    pairs, slots, df = np.unique(group[row] * spread + term, return_inverse=True, return_counts=True)
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
    listed = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (slots, tfs)]
    sentence = [table[c].combine_chunks() for c in names]
    columns = [*names, "block", "unit", "slots", "tfs", "term", "slot", "df"]
    none = [pa.nulls(n, x) for x in (pa.string(), pa.int32(), pa.int64())]
    yield pa.RecordBatch.from_arrays([*sentence, pa.array(np.full(n, block)), pa.array(unit), *listed, *none], names=columns)
    m = len(pairs)
    first = pa.array(np.searchsorted(group, pairs // spread))
    none = [pa.nulls(m, x.type) for x in sentence[len(keys):]] + [pa.nulls(m, pa.int32())] + [pa.nulls(m, x.type) for x in listed]
    yield pa.RecordBatch.from_arrays(
        [*[x.take(first) for x in sentence[: len(keys)]], *none[:2], pa.array(np.full(m, block)), *none[2:], coded.dictionary.take(pa.array(pairs % spread)),
         pa.array(np.arange(m), pa.int32()), pa.array(df, pa.int64())], names=columns,
    )


def block_weights(sentences_: pa.Table, terms: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in ``terms``, unit and weight of each entry of a block: tf*idf scaled to length 1 in each unit. Terms that are left out have none."""
    lists = sentences_["slots"].combine_chunks()
    slots = lists.flatten().to_numpy()
    row = np.repeat(np.arange(sentences_.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    known = terms["slot"].to_numpy()
    place = np.full(max(slots.max(initial=-1), known.max(initial=-1)) + 1, -1)
    place[known] = np.arange(len(known))
    at = place[slots]
    kept = at >= 0
    row, at = row[kept], at[kept]
    weight = sentences_["tfs"].combine_chunks().flatten().to_numpy()[kept] * terms["idf"].to_numpy()[at]
    unit = sentences_["unit"].to_numpy()[row]
    return row, at, unit, weight / np.sqrt(np.bincount(unit, weight * weight))[unit]


def term_idf(blocks: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """``block, slot, term, home, n, idf`` of the terms of each block; ``home`` is the same for one term of a group in all blocks.

    Terms in more than 90 % of the sentences of a group are left out. ``n`` is the number of sentences in the group.
    """
    terms = blocks.where(F.col("term").isNotNull()).select(*keys, "term", "block", "slot", "df")
    sizes = blocks.where(F.col("slots").isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))
    # A window has one row a block, whatever the number of sentences.
    everywhere = Window.partitionBy(*keys, "term")
    summed = terms.select(
        *keys, "term", "block", "slot", F.sum("df").over(everywhere).alias("df"), F.min(F.struct("block", "slot")).over(everywhere).alias("home")
    )
    return summed.join(sizes, list(keys)).where(F.col("df") <= F.lit(MAX_SENTENCE_SHARE) * F.col("n")).select(
        "block", "slot", "term", "home", "n", (F.ln((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")
    )


def by_block(blocks: DataFrame, columns: Sequence[str], terms: DataFrame, run, schema: str) -> DataFrame:
    """``run(sentences, terms)`` for each block, both as Arrow tables."""
    rows = blocks.where(F.col("slots").isNotNull()).select(F.col("block").alias("own_block"), *columns)
    return rows.groupBy("own_block").cogroup(terms.groupBy("block")).applyInArrow(run, schema)


def columns_of(blocks: DataFrame, names: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in blocks.schema}
    return ", ".join(f"`{c}` {types[c]}" for c in names)


def sentence_tfidf(sents: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """``keys, review_id, pos, term, weight`` with weights tf*idf scaled to length 1; a row per sentence and term."""
    names = [*keys, *SENTENCE]
    blocks = staged_blocks(staged_sentences(sents, keys), keys)

    def run(sentences_: pa.Table, terms: pa.Table) -> pa.Table:
        row, at, _, weight = block_weights(sentences_, terms)
        row = pa.array(row)
        return pa.table({**{c: sentences_[c].combine_chunks().take(row) for c in names}, "term": terms["term"].combine_chunks().take(pa.array(at)), "weight": weight})

    return by_block(
        blocks, [*names, "unit", "slots", "tfs"], term_idf(blocks, keys).select("block", "slot", "term", "idf"), run,
        f"{columns_of(blocks, names)}, term string, weight double",
    )


def sentence_scores(sents: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Cosine of each sentence with the mean vector of its group, 0 without terms.

    Sentences stay in their blocks; what is shuffled for the frequencies and the means is one row for each block and
    term, not for each sentence and term. The squared length of a mean is the mean of the products with it. The texts stay in
    their own staged table and meet their scores last; what no later step reads is dropped on the way.
    """
    names = [*keys, *SENTENCE]
    staged = staged_sentences(sents, keys)
    blocks = staged_blocks(staged, keys)
    idf = term_idf(blocks, keys).select("block", "slot", "home", "n", "idf")

    def sums(sentences_: pa.Table, terms: pa.Table) -> pa.Table:
        _, at, _, weight = block_weights(sentences_, terms)
        return terms.append_column("part", pa.array(np.bincount(at, weight, minlength=terms.num_rows).astype(float)))

    parts = by_block(blocks, ["unit", "slots", "tfs"], idf, sums, "block bigint, slot int, home struct<block: bigint, slot: int>, n bigint, idf double, part double")
    mean = F.sum("part").over(Window.partitionBy("home")) / F.col("n")
    means = parts.select("block", "slot", "n", "idf", mean.alias("mean"))

    def products(sentences_: pa.Table, terms: pa.Table) -> pa.Table:
        row, at, unit, weight = block_weights(sentences_, terms)
        units = sentences_["unit"].to_numpy()
        size = np.zeros(units.max(initial=-1) + 1, np.int64)
        with_terms = np.zeros(len(size), bool)
        with_terms[unit] = True
        size[unit] = terms["n"].to_numpy()[at]
        dot = np.bincount(unit, weight * terms["mean"].to_numpy()[at], minlength=len(size)).astype(float)
        first = np.flatnonzero(np.append(True, units[1:] != units[:-1])) if len(units) else np.zeros(0, np.int64)
        own = {c: sentences_[c].combine_chunks().take(pa.array(first)) for c in names}
        return pa.table({**own, "n": size[units[first]], "dot": pa.array(dot[units[first]], mask=~with_terms[units[first]])})

    # One row for each id and place of a group, without its texts.
    dots = stage(by_block(
        blocks, [*names, "unit", "slots", "tfs"], means, products, f"{columns_of(blocks, names)}, n bigint, dot double",
    ), "sentence-products")
    unstage(blocks)
    norms = dots.groupBy(*keys).agg(F.sqrt(F.sum("dot") / F.max("n")).alias("norm"))
    # Without an id or a group a sentence has no product of its own.
    cosine = F.round(F.coalesce(F.col("dot") / F.nullif(F.col("norm"), F.lit(0.0)), F.lit(0.0)), 6)
    return staged.join(dots.drop("n").join(norms, list(keys)), names, "left").select(*names, "sentence", cosine.alias("score"))


def best_sentences(scores: DataFrame, keys: Sequence[str] = GROUP, n: int = SUMMARY_SENTENCES) -> DataFrame:
    """The highest scores of each group, ties by position."""
    order = [F.desc("score"), *SENTENCE]
    return first_per_group(scores, keys, order, n, F.struct(*SENTENCE))


def join_in_order(chosen: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """The chosen sentences of each group in text order, as one string."""
    ordered = F.array_sort(F.collect_list(F.struct(*SENTENCE, "sentence")))
    joined = F.array_join(F.transform(ordered, lambda e: e["sentence"]), " ")
    return chosen.groupBy(*keys).agg(joined.alias("summary"))


def extractive_summary(
    reviews: DataFrame, keys: Sequence[str] = GROUP, n: int = SUMMARY_SENTENCES
) -> DataFrame:
    """``keys, summary`` for every group that has a sentence of fitting length."""
    sents = distinct_sentences(sentence_corpus(reviews, keys), keys)
    return join_in_order(best_sentences(sentence_scores(sents, keys), keys, n), keys)


def chosen_categories(exploded: DataFrame, top_n: int | None, min_reviews: int) -> DataFrame:
    """Selected categories with their review counts per rating, from one aggregation."""
    wide = exploded.groupBy("category").agg(F.count("*").alias("total_reviews"), *rating_columns())
    ranked = wide.where(F.col("total_reviews") >= min_reviews).orderBy(F.desc("total_reviews"), "category")
    return ranked if top_n is None else ranked.limit(top_n)


def selected_reviews(
    exploded: DataFrame, categories: DataFrame, top_n: int | None, cap: int | None
) -> DataFrame:
    """Sampled reviews of the selected categories.

    Sampling sees ids only; texts are fetched for the chosen reviews. The lists
    are broadcast where ``top_n`` and ``cap`` prove them small, else joined.
    """
    def known(df, rows):
        return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df

    kept = exploded.join(known(categories.select("category"), top_n), "category", "left_semi")
    if not cap:
        return kept
    # A category that a review names twice counts twice but is read once per naming.
    sampled = group_sample(kept.select(*GROUP, "review_id", "naming"), GROUP, cap, ties=["naming"])
    rows = top_n * len(RATINGS) * cap if top_n is not None else None
    return kept.join(known(sampled, rows), [*GROUP, "review_id", "naming"], "left_semi")


def rating_summaries(
    exploded: DataFrame, top_n: int | None = TOP_CATEGORIES, min_reviews: int = MIN_CATEGORY_REVIEWS,
    cap: int | None = REVIEWS_PER_RATING, n: int = SUMMARY_SENTENCES, categories=None,
    summarise=None,
) -> DataFrame:
    """Flat summaries: one row per selected category and rating 1..5.

    ``categories`` (at most ``top_n`` of them, None: any number) replace the selection.
    ``summarise(reviews, keys)`` replaces the extractive summary if given.
    """
    chosen = chosen_categories(exploded, top_n, min_reviews) if categories is None else categories
    reviews = selected_reviews(exploded, chosen, top_n, cap)
    texts = summarise(reviews, GROUP) if summarise else extractive_summary(reviews, GROUP, n)
    flat = chosen.select("category", "total_reviews", F.inline(rating_rows(cap)))
    return flat.join(texts, list(GROUP), "left").select(
        "category", "total_reviews", "rating", "review_count", "sampled", F.coalesce("summary", F.lit("")).alias("summary")
    )
