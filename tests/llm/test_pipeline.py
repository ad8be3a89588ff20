"""The stages of the pipeline against brute force on the smallest tables, and the contracts of the queries."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_jaccard import brute
from test_pii import reference
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from starlens.llm.pii import KINDS
from starlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [x.asDict() for x in docs.collect()]


@pytest.fixture(scope="module")
def results(spark):
    return {name: query(spark, FOLDER).cache() for name, query in QUERIES.items()}


def masked(text):
    out, at = [], 0
    for a, k, b in sorted(reference(text), key=lambda x: (x[0], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def test_stages_against_brute_force(spark, docs, rows):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "contamination", "personal_data", "tokens"]
    items = [x["text"] for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = stages["language"](spark, docs, FOLDER)
    assert kept.columns == docs.columns and sorted(x["doc_id"] for x in kept.collect()) == sorted(x["doc_id"] for x in rows if re.search(r"[^\W\d_]", x["text"]))
    left = [x["doc_id"] for x in stages["near_copies"](spark, docs, FOLDER).collect()]
    classes = dict(zip((x["doc_id"] for x in rows), (x[0] for x in brute([(x["doc_id"], x["text"]) for x in rows]))))
    assert len(left) == len(set(classes.values())) and {classes[i] for i in left} == set(classes.values())
    clean = {x["doc_id"] for x in stages["contamination"](spark, docs, FOLDER).collect()}
    assert clean == {x["doc_id"] for x in rows if not any(t in x["text"] for t in items)}
    masks = {x["doc_id"]: x for x in stages["personal_data"](spark, docs, FOLDER).collect()}
    assert all(masks[x["doc_id"]]["text"] == masked(x["text"]) and masks[x["doc_id"]]["n_chars"] == len(masked(x["text"])) for x in rows)


def test_whole_pipeline(spark, docs, rows):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    out = __spark_entry__.queries()["pipeline"](spark, FOLDER).collect()
    texts = {x["doc_id"]: masked(x["text"]) for x in rows}
    assert 0 < len(out) < len(rows) and len({x["doc_id"] for x in out}) == len(out)
    for x in out:
        ids = np.array(library.encode(texts[x["doc_id"]], add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(x["token_ids"]) == ids and x["ids_sha256"] == hashlib.sha256(ids).hexdigest() and x["decoded_sha256"] == hashlib.sha256(texts[x["doc_id"]].encode()).hexdigest()


def test_stages_of_odd_tables(spark, docs):
    text = "some words that are here once and then again in the same order"
    odd = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text, None, None, None), (2, None, "en", "s", None), (3, "", None, None, 0), (4, "ünïcode " * 4000, "de", None, 5)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < 0"), FOLDER).count() == 0, name
        n = stage(spark, odd, FOLDER).count()
        assert n == {"language": 4, "near_copies": 4}.get(name, 6), name


def test_every_row_of_the_tables_is_in_the_results(results, rows, spark):
    ids = sorted(x["doc_id"] for x in rows)
    for name in ("op1_toxicity", "op2_quality", "op3_jaccard", "op4_bpe", "op5_pii", "op6_token_files", "op7_language"):
        assert sorted(x["doc_id"] for x in results[name].select("doc_id").collect()) == ids, name
    for name, by, held in (("op1_toxicity", 5, 0), ("op2_quality", 4, 2)):
        for x in results[name].collect():
            assert x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % by == held) and 0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= (0.5 if by == 5 else 0.7))
    assert results["op8_warc"].count() == 2 * spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_personal_data_digests(results, rows):
    by = {x["doc_id"]: x["text"] for x in rows}
    for x in results["op5_pii"].collect():
        spans = reference(by[x["doc_id"]])
        told = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert x["base_sha256"] == hashlib.sha256(told.encode()).hexdigest() and set(told.split(",")) <= set(x["spans"].split(","))
        assert [x[f"n_{k}"] for k in KINDS] == [sum(1 for _, k, _ in spans if k == n) for n in range(4)]


def test_benchmark_passages_are_found(results, rows, spark):
    items = {x["item_id"]: x["text"] for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    want = {(x["doc_id"], i) for x in rows for i, t in items.items() if t in x["text"]}
    assert {(x["doc_id"], x["item_id"]) for x in results["op9_contamination"].collect()} == want


def test_scores_tell_held_out_labels(spark):
    """Held-out accuracy on a table with enough labels."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, label, least in (("op1_toxicity", "toxic", 0.97), ("op2_quality", "quality", 0.97)):
        held = QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id")
        assert held.select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least, name
