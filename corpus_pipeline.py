"""The corpus pipeline: language, near copies, benchmark passages, personal data, token ids.

Each stage takes what the one before kept, written and read again, and all but the last return the columns of documents.
Rows of one id and text share every decision, except that only one of them stays among near copies. Null texts count as empty; texts without
letters go in the first stage unless a page declares their language. Every stage gives an empty table for an empty one.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm.bpe import bpe_encode
from starlens.llm.common import sized, small_batches, without
from starlens.llm.contamination import contaminated
from starlens.llm.jaccard import near_duplicates
from starlens.llm.language import identify, page_evidence
from starlens.llm.pii import personal_data, redacted
from starlens.session import stage

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language; the others stay as they are."""
    found = identify(docs, page_evidence(table(spark, sf_dir, "pages")))
    return without(docs, found.where(~F.col("kept")), name="no-language")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document, in the order of the files, of each class of near copies."""
    small_batches(spark)
    numbered = stage(docs.withColumn("near_row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, key="near_row")
    dropped = stage(found.where(F.col("class_id") != F.col("near_row")).select("near_row"), "near-copies")
    return numbered.join(sized(dropped), "near_row", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found, name="contaminated")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; ``n_chars`` follows the text."""
    small_batches(spark)
    clean = redacted(personal_data(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, token_ids, ids_sha256, decoded_sha256): ids as little-endian unsigned 32-bit integers, and a round trip."""
    small_batches(spark)
    vocabulary = public_tokenizers.path(VOCABULARY)
    decoded = bpe_encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, decoded="decoded")
    return decoded.select("doc_id", "lang", "source", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [
    ("language", language),
    ("near_copies", one_of_near_copies),
    ("contamination", decontaminated),
    ("personal_data", without_personal_data),
    ("tokens", tokenised),
]

#: SQL has no near copies, latent search or BPE; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
