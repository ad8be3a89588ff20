"""Text features as long tables ``(review_id, term, value)``.

Terms are counted inside the row of their document (``term_counts``), so only
aggregates and vocabulary hits are ever shuffled. The vocabulary is bounded by
its size parameter, which is what allows it to be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starlens.constants import (
    CLS_ID, FIRST_WORD_ID, MAX_DOCUMENT_SHARE, MAX_SEQUENCE, MIN_DOCUMENTS, PAD_ID, SEP_ID, UNK_ID, VOCABULARY_SIZE,
)
from starlens.functions.text import clean_text, ngrams, term_counts, tokens
from starlens.session import stage

BROADCAST_ROWS = 100_000


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table known to have at most ``rows`` rows if that is little enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def with_terms(processed: DataFrame) -> DataFrame:
    """Replace ``tokens`` by ``terms``: its words and word pairs with their counts."""
    others = [c for c in processed.columns if c != "tokens"]
    # Exploding an array of one fixes the value, so that later steps do not compute it again.
    return processed.select(*others, F.explode(F.array(term_counts(ngrams(F.col("tokens"))))).alias("terms"))


def term_rows(documents: DataFrame) -> DataFrame:
    """One row per document and distinct term; other columns are carried along."""
    others = [c for c in documents.columns if c != "terms"]
    return documents.select(*others, F.inline("terms"))


def term_statistics(documents: DataFrame) -> DataFrame:
    """Documents (df) and occurrences (cf) per term."""
    return term_rows(documents.select("terms")).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


def numbered(terms: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Number a bounded table; only used behind a row limit."""
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)) - 1
    return terms.withColumn(name, place.cast("bigint"))


def vocabulary(
    train: DataFrame, size: int = VOCABULARY_SIZE, min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_DOCUMENT_SHARE,
) -> DataFrame:
    """``term, idx, df, cf, idf`` of the most frequent terms of the training documents.

    First the limits on document frequency, then the cut by total frequency
    (ties by term). ``idx`` follows the alphabet.
    """
    n = train.agg(F.count("*").alias("n_documents"))
    kept = term_statistics(train).where(
        (F.col("df") >= min_documents) & (F.col("df") <= F.lit(max_share) * n.scalar())
    ).orderBy(F.desc("cf"), "term").limit(size)
    idf = F.ln((1 + n.scalar()) / (1 + F.col("df"))) + 1
    return numbered(kept, ["term"], "idx").select("term", "idx", "df", "cf", idf.alias("idf"))


def first_features(vocab: DataFrame, n: int = 20) -> DataFrame:
    """The alphabetically first terms of the vocabulary."""
    return vocab.orderBy("term").limit(n)


def count_vectors(documents: DataFrame, vocab: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Counts of vocabulary terms per document; a map-side join without shuffle."""
    found = term_rows(documents).join(bounded(vocab.select("term", "idx", "idf"), size), "term")
    return found.withColumn("value", F.col("tf").cast("double"))


def tfidf_vectors(documents: DataFrame, vocab: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Weights (1+ln tf)*idf, scaled to length 1 per document.

    The only shuffle moves one compact vector per document.
    """
    others = [c for c in documents.columns if c != "terms"]
    weight = (1 + F.ln("value")) * F.col("idf")
    vectors = count_vectors(documents, vocab, size).groupBy(*others).agg(
        F.collect_list(F.struct("term", "idx", "tf", weight.alias("weight"))).alias("entries")
    )
    length = F.sqrt(F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"]))
    return (
        vectors.withColumn("length", length).select(*others, "length", F.inline("entries"))
        .withColumn("value", F.col("weight") / F.col("length")).drop("weight", "length")
    )


def feature_rows(documents: DataFrame, vocab: DataFrame, kind: str, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Long features by vectorizer name."""
    return {"Count": count_vectors, "TF-IDF": tfidf_vectors}[kind](documents, vocab, size)


def ml_vectors(documents: DataFrame, rows: DataFrame, size: int = VOCABULARY_SIZE, name: str = "vectors") -> DataFrame:
    """Documents with a sparse vector column ``features`` for MLlib, staged once.

    Vectors are written as the struct that backs the vector type and read back
    under that type, so no Python touches them. A document without any
    vocabulary term gets an empty vector.
    """
    others = [c for c in documents.columns if c != "terms"]
    entry = F.struct("idx", "value")
    empty = documents.select(*others, F.lit(None).cast("bigint").alias("idx"), F.lit(None).cast("double").alias("value"))
    entries = F.array_sort(F.collect_list(F.when(F.col("idx").isNotNull(), entry)))
    grouped = rows.select(*others, "idx", "value").unionByName(empty).groupBy(*others).agg(entries.alias("entries"))
    vectors = grouped.select(*others, F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.transform("entries", lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform("entries", lambda e: e["value"]).alias("values"),
    ).alias("features"))
    schema = StructType([f for f in vectors.schema if f.name != "features"]).add("features", VectorUDT())
    return stage(vectors, name, schema)


# --- id sequences -----------------------------------------------------------------------


def words(text: Column) -> Column:
    return F.filter(tokens(clean_text(text)), lambda w: F.length(w) > 0)


def word_vocabulary(train: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """``term, id`` of the most frequent words; ids follow the special tokens."""
    counted = train.select(F.explode(words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("cf"))
    kept = counted.orderBy(F.desc("cf"), "term").limit(size)
    return numbered(kept, [F.desc("cf"), "term"], "place").select("term", (F.col("place") + FIRST_WORD_ID).alias("id"))


def encode(
    documents: DataFrame, vocab: DataFrame, part: str = "split", limit: int = MAX_SEQUENCE, size: int = VOCABULARY_SIZE
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` per review.

    Start and end marks around at most ``limit - 2`` words, padded to the
    longest sequence of the same part (train or test).
    """
    shown = documents.select("review_id", part, F.slice(words(F.col("text")), 1, limit - 2).alias("words"))
    placed = shown.select("review_id", part, F.posexplode_outer("words").alias("pos", "term"))
    known = placed.join(bounded(vocab, size), "term", "left")
    entry = F.when(F.col("term").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(UNK_ID)).cast("int").alias("id")))
    rows = known.groupBy("review_id", part).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    ids = F.concat(F.array(F.lit(CLS_ID)), F.transform("entries", lambda e: e["id"]), F.array(F.lit(SEP_ID)))
    rows = rows.select("review_id", part, ids.alias("ids"))
    # One line per part; word counts need no vocabulary, so this pass reads the text only.
    longest = shown.groupBy(part).agg((F.max(F.size("words")) + 2).alias("longest"))
    padding = F.col("longest") - F.size("ids")
    return rows.join(F.broadcast(longest), part).select(
        "review_id", part,
        F.concat("ids", F.array_repeat(F.lit(PAD_ID), padding)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), padding)).alias("attention_mask"),
    )
