"""Noun lemmas by suffix detachment with look-up.

A plural loses its ending only if what is left is a known word; a word for which no rule leads to a known one stays whole. Known words are a
table, by default the words that the texts themselves use often enough. All work is on distinct words: the result is a table of the forms that
change, which is applied to the texts as a literal of hashed maps, or by a join where it is larger than the plan should carry.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.constants import IRREGULAR_NOUNS
from starlens.session import stage

# Endings of plural nouns and what they become, and an ending that is no plural although it has an s.
DETACHMENTS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))
SINGULAR_ENDING = "ss"
#: Letters of the shortest word that loses a plain s, and of the shortest lemma.
LEAST_FORM, LEAST_LEMMA = 4, 2
#: Texts that a word must occur in to be known without a lexicon.
LEAST_TEXTS = 2
#: Changed forms that travel within the plan; more are joined.
LITERAL_FORMS = 100_000
BUCKETS = 4_096


def detached(word: Column) -> Column:
    """What each rule that fits leaves of a word."""
    def cut(ending: str, new: str) -> Column:
        fits = F.endswith(word, F.lit(ending))
        if ending == "s":
            fits = fits & (F.length(word) >= LEAST_FORM) & ~F.endswith(word, F.lit(SINGULAR_ENDING))
        stem = F.concat(F.substr(word, F.lit(1), F.length(word) - len(ending)), F.lit(new))
        return F.when(fits & (F.length(stem) >= LEAST_LEMMA), stem)

    return F.filter(F.array(*(cut(*rule) for rule in DETACHMENTS)), lambda x: x.isNotNull())


def distinct_words(texts: DataFrame, words: Column) -> DataFrame:
    """``word, n_texts`` of the words of all texts, counted within the text first."""
    return texts.select(F.explode(F.array_distinct(words)).alias("word")).where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n_texts"))


def lemma_table(words: DataFrame, known: DataFrame, irregular: dict[str, str] | None = None) -> DataFrame:
    """``form, lemma`` of the words (``word``) that have another lemma.

    Irregular forms first; else the shortest known word (``known.word``) among the word itself and what the rules leave of it, the first in the alphabet
    of several; null words have none. Repeated rows count once.
    """
    irregular = IRREGULAR_NOUNS if irregular is None else irregular
    forms = words.select(F.col("word").alias("form")).where(F.col("form").isNotNull()).distinct()
    found = (
        forms.where(~F.col("form").isin(*irregular)).select("form", F.explode(F.array_append(detached(F.col("form")), F.col("form"))).alias("word"))
        .join(known.select("word").distinct(), "word", "left_semi")
        .groupBy("form").agg(F.min(F.struct(F.length("word").alias("size"), "word")).alias("best"))
        .select("form", F.col("best.word").alias("lemma")).where(F.col("form") != F.col("lemma"))
    )
    pairs = [(form, lemma) for form, lemma in irregular.items() if form != lemma]
    fixed = words.sparkSession.createDataFrame(pairs, "form string, lemma string")
    return found.unionByName(fixed.join(forms, "form", "left_semi"))


def learned_lemmas(texts: DataFrame, words: Column, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """The table of lemmas whose known words are those of at least ``least_texts`` of the texts."""
    counted = stage(distinct_words(texts, words), "words")
    return stage(lemma_table(counted, counted.where(F.col("n_texts") >= least_texts)), "lemmas")


def hashed_maps(pairs: list[tuple[str, str]], buckets: int = BUCKETS) -> Column:
    """A literal array of maps, one for each hash bucket, so that a look-up reads a few entries."""
    maps: list[dict[str, str]] = [{} for _ in range(buckets)]
    if pairs:
        keyed = SparkSession.active().createDataFrame(pairs, "form string, lemma string").select("form", "lemma", F.pmod(F.xxhash64("form"), F.lit(buckets)).cast("int").alias("bucket"))
        for row in keyed.collect():
            maps[row.bucket][row.form] = row.lemma
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")


def with_lemmas(texts: DataFrame, lemmas: DataFrame, words: str = "tokens", literal_forms: int = LITERAL_FORMS) -> DataFrame:
    """Replace the words of an array column by their lemmas, in order; words without an entry stay, null arrays stay null.

    Up to ``literal_forms`` forms travel within the plan and no row moves; beyond that the words are joined with the table and put together again by row.
    """
    pairs = [(row.form, row.lemma) for row in lemmas.select("form", "lemma").limit(literal_forms + 1).collect()]
    if len(pairs) <= literal_forms:
        maps = hashed_maps(pairs)
        look_up = lambda w: F.coalesce(F.element_at(F.element_at(maps, (F.pmod(F.xxhash64(w), F.lit(BUCKETS)) + 1).cast("int")), w), w)
        return texts.withColumn(words, F.transform(words, look_up))
    numbered = stage(texts.withColumn("lemma_row", F.monotonically_increasing_id()), "numbered")
    placed = numbered.select("lemma_row", F.posexplode(words).alias("lemma_pos", "form")).join(lemmas.select("form", "lemma"), "form", "left")
    entries = placed.groupBy("lemma_row").agg(F.array_sort(F.collect_list(F.struct("lemma_pos", F.coalesce("lemma", "form").alias("w")))).alias("lemma_words"))
    again = F.when(F.size(words) > 0, F.transform("lemma_words", lambda e: e["w"])).otherwise(F.col(words))
    return numbered.join(entries, "lemma_row", "left").withColumn(words, again).select(*texts.columns)
