import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starlens.operators import categories, chunks, metrics, sampling, scoring, summaries
from starlens.plans import summarise
from starlens.sources import csv_files, reviews, summary_files
from starlens.session import staging_path


def key(i):
    return hashlib.md5(f"{i}:42".encode()).hexdigest(), i


def test_schema_errors_and_fallbacks(spark):
    with pytest.raises(KeyError):
        reviews.normalize_schema(spark.createDataFrame([(1,)], "other int"))
    df = spark.createDataFrame([("a", "4", "x")], "`reviews.text` string, stars string, summary string")
    assert reviews.normalize_schema(df).first() == ("a", 4, "Unknown", "x")
    assert reviews.detect_text_column(spark.createDataFrame([(1, "a")], "id int, MyReview string")) == "MyReview"
    assert reviews.detect_rating_column(spark.createDataFrame([(1,)], "overall int")) == "overall"


@pytest.mark.parametrize("given, expected", [
    (None, ["Unknown"]), ("", ["Unknown"]), (" , ", ["Unknown"]), ("a,,b", ["a", "b"]), ("a,a", ["a", "a"]),
])
def test_category_lists(spark, given, expected):
    df = spark.createDataFrame([(1, given)], "review_id int, categories string")
    assert [r.category for r in categories.explode_categories(df).orderBy("naming").collect()] == expected


@pytest.fixture(scope="module")
def classes(spark):
    # One class holds most rows.
    rows = [(i, "Positive" if i % 10 > 3 else "Negative" if i % 10 > 0 else "Neutral") for i in range(997)]
    return rows, spark.createDataFrame(rows, "review_id bigint, sentiment string").repartition(5)


def test_split_matches_ranking(classes):
    rows, df = classes
    expected = set()
    for label in {s for _, s in rows}:
        ids = sorted((i for i, s in rows if s == label), key=key)
        expected |= set(ids[: int(0.2 * len(ids) + 0.5)])
    got = sampling.stratified_split(df).collect()
    assert len(got) == len(rows)
    assert {r.review_id for r in got if r.split == "test"} == expected


def test_capped_sample(classes):
    rows, df = classes
    assert {r.review_id for r in sampling.capped_sample(df, 100).collect()} == set(sorted((i for i, _ in rows), key=key)[:100])
    assert sampling.capped_sample(df, 5000).count() == len(rows)


def test_over_sampling(classes, spark):
    rows, df = classes
    n = Counter(s for _, s in rows)
    got = sampling.over_sample(df).collect()
    after = Counter(r.sentiment for r in got)
    assert after == {"Negative": n["Negative"], "Neutral": n["Negative"], "Positive": n["Positive"]}
    neutral = sorted((i for i, s in rows if s == "Neutral"), key=key)
    extra = n["Negative"] - len(neutral)
    expected = Counter(neutral) + Counter(neutral[k % len(neutral)] for k in range(extra))
    assert Counter(r.review_id for r in got if r.sentiment == "Neutral") == expected
    with pytest.raises(ValueError):
        sampling.with_copies(spark.createDataFrame([(1, "Neutral"), (2, "Neutral"), (3, "Negative")], "review_id bigint, sentiment string"))
    same = spark.createDataFrame([(1, "Neutral"), (3, "Negative")], "review_id bigint, sentiment string")
    assert sampling.over_sample(same).count() == 2


def test_folds_are_equal(classes):
    _, df = classes
    sizes = sampling.cross_folds(df).groupBy("sentiment", "fold").count().collect()
    for label in {r.sentiment for r in sizes}:
        counts = [r["count"] for r in sizes if r.sentiment == label]
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


def test_group_sample_with_a_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 20}", 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "review_id bigint, category string, rating int")
    got = {(r.category, r.review_id) for r in sampling.group_sample(df, cap=7).collect()}
    expected = set()
    for c in {r[1] for r in rows}:
        expected |= {(c, i) for i in sorted((r[0] for r in rows if r[1] == c), key=key)[:7]}
    assert got == expected


def test_metrics(spark):
    pairs = [("Negative", "Negative")] * 3 + [("Negative", "Positive")] * 2 + [("Positive", "Positive")] * 5
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    row = metrics.summary_metrics(df).first()
    assert row.accuracy == row.recall == 0.8
    f_neg, f_pos = 2 * 3 / 8, 2 * 5 / 12
    assert row.f1_macro == round((f_neg + f_pos) / 2, 6)  # the class that never occurs is left out
    assert row.f1 == round((f_neg * 5 + f_pos * 5) / 10, 6)
    table = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df).collect()}
    assert len(table) == 9 and sum(table.values()) == 10 and table["Neutral", "Neutral"] == 0
    neutral = metrics.class_metrics(df).where("sentiment = 'Neutral'").first()
    assert (neutral.precision, neutral.recall, neutral.f1, neutral.support) == (0, 0, 0, 0)


def greedy(lengths, limit):
    number, total, open_, result = 0, 0, False, []
    for n in lengths:
        if total + n + 1 > limit and open_:
            number, total = number + 1, n
        else:
            total, open_ = total + n + 1, True
        result.append(number)
    return result


@pytest.mark.parametrize("seed", range(6))
def test_chunk_blocks_compose_to_greedy_packing(seed):
    rng = random.Random(seed)
    limit = rng.choice([5, 20, 60])
    lengths = [rng.randint(1, limit + (10 if seed % 2 else 0)) for _ in range(200)]
    cuts = sorted(rng.sample(range(1, 200), 12))
    blocks, start = [], 0
    for b, end in enumerate([*cuts, 200]):
        part = pd.DataFrame({"review_id": range(start, end), "pos": 0, "chars": lengths[start:end]})
        blocks.append((b, part))
        start = end
    maps = pd.DataFrame(
        [(b, *chunks.block_map(p, limit)) for b, p in blocks], columns=["block", "upto", "leave", "starts", "chars"])
    entries = chunks.compose(maps, limit).set_index("block")
    got = []
    for b, part in blocks:
        entry = entries.loc[b]
        got += chunks.number_block(part.assign(level=entry.level, chunk=entry.chunk), limit)["chunk_no"].tolist()
    assert got == greedy(lengths, limit)


@pytest.mark.parametrize("seed", range(8))
def test_branches_of_blocks_compose_as_the_blocks(seed):
    """Maps joined branch by branch, and once more, lead to the same entries; blocks of one long sentence included."""
    rng = random.Random(seed)
    limit = rng.choice([5, 20, 60])
    lengths = [rng.randint(1, 2 * limit if seed % 2 else limit) for _ in range(150)]
    cuts = sorted({0, 150, *rng.sample(range(1, 150), 60)})
    parts = [pd.DataFrame({"review_id": range(a, b), "pos": 0, "chars": lengths[a:b]}) for a, b in zip(cuts, cuts[1:])]
    columns = ["block", "upto", "leave", "starts", "chars"]
    maps = pd.DataFrame([(i, *chunks.block_map(p, limit)) for i, p in enumerate(parts)], columns=columns)
    whole = chunks.compose(maps, limit).set_index("block")
    width = rng.choice([2, 7])
    branches = pd.DataFrame([(i, *chunks.joined_map(g, limit)) for i, g in maps.groupby(maps["block"] // width)], columns=columns)
    begins = chunks.compose(branches, limit).set_index("block")
    for i, group in maps.groupby(maps["block"] // width):
        entries = chunks.compose(group, limit, int(begins.loc[i].level), int(begins.loc[i].chunk)).set_index("block")
        assert entries.equals(whole.loc[entries.index])


def test_small_blocks_and_branches_in_spark(spark):
    rng = random.Random(2)
    rows = [(c, 1, i // 5, i % 5, "x" * rng.randint(1, 900)) for c in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "category string, rating int, review_id bigint, pos int, sentence string").repartition(3)
    got = {(r.category, r.review_id, r.pos): r.chunk_no for r in chunks.chunk_numbers(df, block_bits=3, branch_bits=2).collect()}
    for c in "ab":
        assert [got[c, i // 5, i % 5] for i in range(300)] == greedy([len(r[4]) for r in rows if r[0] == c], 3500)
    assert chunks.chunk_numbers(df.where("rating > 1")).count() == 0


def test_chunks_in_spark(spark):
    rng = random.Random(1)
    rows = [("c", 1, i // 5, i % 5, "x" * rng.randint(1, 900)) for i in range(400)]
    df = spark.createDataFrame(rows, "category string, rating int, review_id bigint, pos int, sentence string")
    got = chunks.chunk_numbers(df).orderBy("review_id", "pos").collect()
    assert [r.chunk_no for r in got] == greedy([len(r[4]) for r in rows], 3500)


def summary_of(spark, *texts):
    df = spark.createDataFrame([("c", 1, i, t) for i, t in enumerate(texts)], "category string, rating int, review_id bigint, text string")
    found = summaries.extractive_summary(df).first()
    return found and found.summary


def test_summary_edges(spark):
    long = "This sentence about batteries is long enough to be eligible."
    assert summary_of(spark, "Too short. Also short.") is None
    assert summary_of(spark, long) == long
    assert summary_of(spark, long, long.upper()) == long
    stop_only = "It was not only him and her but also they who were there too."
    assert summary_of(spark, stop_only) == stop_only


def test_documents_and_catalogue(spark):
    rows = [(i, f"The tablet number {i} works very well for reading books. It is fine.", 1 + i % 5, "Fire!, Fire?, tools") for i in range(60)]
    df = spark.createDataFrame(rows, "review_id bigint, text string, rating int, categories string")
    docs = summarise.documents(summarise.flat_summaries(df, cap=5))
    folder = staging_path(spark, "test-docs")
    summary_files.write_summaries(docs, folder)
    index = {r.category: r for r in summary_files.read_catalogue(spark, folder).collect()}
    assert set(index) == {"Fire!", "Fire?", "tools"} and index["Fire!"].category_slug == index["Fire?"].category_slug == "fire"
    detail = summary_files.read_summaries(spark, folder, "fire").collect()
    assert len(detail) == 2
    ratings = detail[0].ratings
    assert sorted(ratings) == ["1", "2", "3", "4", "5"] and ratings["3"]["count"] == 12 and ratings["3"]["sampled"] == 5
    assert ratings["3"]["summary"].startswith("The tablet number")


def test_csv_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text('reviews.text,reviews.rating\n"two\nlines, ""quoted""",5\n', encoding="utf-8")
    (tmp_path / "deep" / "b.csv").write_text("reviews.text,reviews.rating,categories\ntrès bon,4,x\nnon,1,\n", encoding="latin-1")
    got = csv_files.read_reviews(spark, str(tmp_path))
    assert {r["reviews.text"]: r.categories for r in got.collect()} == {'two\nlines, "quoted"': None, "très bon": "x", "non": None}
    assert got.where(F.col("__source_file").endswith("b.csv")).count() == 2
    assert csv_files.read_reviews(spark, str(tmp_path), sample_rows=1).count() == 2
    with pytest.raises(Exception):
        csv_files.read_reviews(spark, str(tmp_path / "none"))


def test_external_model_failures(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(14)], "review_id bigint, text string")
    got = {r.review_id: r for r in scoring.external_scores(df, scoring.length_stub).collect()}
    assert (got[6].label, got[6].score, got[6].sentiment) == ("NEUTRAL", 0.5, "Neutral")
    assert (got[7].label, got[8].label) == ("POSITIVE", "LABEL_0") and len(got) == 14


def test_csv_headers_follow_the_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_text("catégorie,note,,note\nété,1,x,2\n", encoding="latin-1")
    (tmp_path / "b.csv").write_text("catégorie,note\nhiver,3\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    got = csv_files.read_reviews(spark, str(tmp_path), multi_line=False)
    assert {"catégorie", "note", "note1", "_c2", "note3"} <= set(got.columns)
    assert sorted(x["catégorie"] for x in got.collect()) == ["hiver", "été"]
    assert csv_files.column_names('"a,b",A,a,') == ["a,b", "A1", "a2", "_c3"]


def test_two_level_summaries_with_failing_models(spark):
    sentence = "The {0} {1} sentence number {1} is long enough to be kept in here."
    reviews = spark.createDataFrame(
        [(c, 5, i, sentence.format(c, i)) for c in ("calm", "loud", "short") for i in range(1 if c == "short" else 9)],
        "category string, rating int, review_id long, text string")

    def model_factory():
        def model(text):
            if "loud" in text and len(text) > 250 or "short" in text:
                raise ValueError("not accepted")
            return f"<{text[:90]}>"
        return model

    def summaries(**options):
        return {x["category"]: x["summary"] for x in chunks.two_level_summary(reviews, limit=200, **options).collect()}

    given = summaries(model_factory=model_factory)
    assert given["short"] == sentence.format("short", 0)  # the model fails on the chunk, so its first characters stay
    assert given["calm"].startswith("<<The calm 0")  # unified by the model
    assert given["loud"].startswith("<The loud") or given["loud"].startswith("The loud")  # the model refuses the joined ones, so it is extractive
    assert not given["loud"].startswith("<<")
    own = summaries()
    assert own["short"] == sentence.format("short", 0)
    assert own["calm"].count("sentence number") == 6 and own["loud"].count("sentence number") == 6  # the best six of all


def test_scores_keep_rows_and_keys(spark):
    class Model:
        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            return df.withColumn("probability", array_to_vector(F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)))).withColumn("prediction", F.lit(2.0))

    batch = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "a", "z")], "id long, body string, text string")
    got = scoring.score_batch(batch, "body", Model(), ["id"]).orderBy("id").collect()
    assert [(x["id"], x["Original_Text"], x["Sentiment"]) for x in got] == [(1, "a", "Positive"), (2, None, "Positive"), (3, "a", "Positive")]
