import pytest
from pyspark.sql import functions as F

from starlens.constants import STOP_WORDS, WHITESPACE
from starlens.functions import labels, text


@pytest.fixture(scope="module")
def one(spark):
    def run(value, *functions, kind="string"):
        column = F.lit(value).cast(kind)
        for function in functions:
            column = function(column)
        return spark.range(1).select(column.alias("x")).first().x
    return run


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_whitespace_is_what_unicode_says():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize("given, expected", [
    ("Très c-d", "trs cd"), ("two words", "two words"), ("123 456", ""), ("  A\tb\n\nC ", "a b c"), (None, None),
])
def test_clean(one, given, expected):
    assert one(given, text.clean_text) == expected


def test_tokens_split_fused_words(one):
    assert one("i cannot say gonna scanner", text.tokens) == ["i", "can", "not", "say", "gon", "na", "scanner"]


def test_content_words_keep_repeats(one):
    assert one("the good good it is at of", text.tokens, text.content_words) == ["good", "good"]


def test_processed(one):
    assert one("We surely like these shiny boxes, and the movies!", text.processed_text) == "surely like shiny box movie"


@pytest.mark.parametrize("word, lemma", [
    ("running", "running"), ("cats", "cat"), ("batteries", "battery"), ("boxes", "box"), ("glass", "glass"),
    ("glasses", "glass"), ("bus", "bus"), ("women", "woman"), ("leaves", "leaf"), ("watches", "watch"), ("specimen", "specimen"),
    ("movies", "movie"), ("series", "series"), ("always", "always"), ("knives", "knife"), ("heroes", "hero"), ("news", "news"),
])
def test_lemma(one, word, lemma):
    assert one(word, text.noun_lemma) == lemma


@pytest.mark.parametrize("name, slug", [("  Fire & Tablets!! ", "fire-tablets"), ("!!!", "misc"), ("", "misc"), ("a--b", "a-b")])
def test_slug(one, name, slug):
    assert one(name, text.slug) == slug


@pytest.mark.parametrize("given, parts", [
    ("One. Two! Three? x", ["One.", "Two!", "Three?", "x"]), ("no stop", ["no stop"]), ("e.g. this", ["e.g.", "this"]), (" ", []),
])
def test_sentences(one, given, parts):
    assert one(given, text.sentences) == parts


def test_ngrams_and_counts(one):
    split = lambda c: F.split(c, " ")
    assert one("a b a", split, text.ngrams) == ["a", "b", "a", "a b", "b a"]
    assert one("a", split, text.ngrams) == ["a"]
    assert [tuple(x) for x in one("b a b", split, text.term_counts)] == [("a", 1), ("b", 2)]


def test_no_terms_give_no_counts(spark):
    empty = F.array().cast("array<string>")
    assert spark.range(1).select(text.term_counts(empty).alias("x"), text.ngrams(empty).alias("y")).first() == ([], [])


@pytest.mark.parametrize("given, whole", [
    ("2.5", 2), ("3.5", 4), ("0.4", 0), ("5.4", 5), (" 4 ", 4), ("n/a", None), ("4d", None), (None, None),
])
def test_whole_rating(one, given, whole):
    assert one(given, labels.whole_rating) == whole


@pytest.mark.parametrize("rating, name", [
    (1, "Negative"), (2, "Negative"), (3, "Negative"), (4, "Neutral"), (5, "Positive"), (0, "Unknown"), (6, "Unknown"),
    (4.5, "Unknown"), (None, "Unknown"),
])
def test_sentiment(one, rating, name):
    assert one(rating, labels.sentiment_of, kind="double") == name


@pytest.mark.parametrize("label, name", [
    ("LABEL_0", "Negative"), ("LABEL_1", "Negative"), ("LABEL_2", "Negative"), ("1 star", "Negative"), ("3 stars", "Neutral"),
    ("4 stars", "Positive"), ("NEUTRAL", "Neutral"), ("positive", "Positive"),
])
def test_foreign_label(one, label, name):
    assert one(label, labels.normalised_label) == name


def test_label_codes(one):
    assert [one(s, labels.label_code) for s in ("Negative", "Neutral", "Positive", "x")] == [0, 1, 2, None]
    assert [one(c, labels.label_name, kind="int") for c in (0, 1, 2, 7)] == ["Negative", "Neutral", "Positive", "Unknown"]
