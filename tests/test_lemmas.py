"""Lemmas by detachment and look-up, with expectations written by hand."""

from pyspark.sql import functions as F

from starlens.operators import lemmas

KNOWN = """size prize headache cache menu bus virus selfie hoodie box church dish battery leaf shelf woman glass gas class lens canvas christmas tablet
charge purse wish fox quiz house horse case movie shoe photo bonus iris dress less man len clas siz""".split()
EXPECTED = {
    "prizes": "prize", "headaches": "headache", "caches": "cache", "menus": "menu", "buses": "bus", "viruses": "virus",
    "selfies": "selfie", "hoodies": "hoodie", "boxes": "box", "churches": "church", "dishes": "dish", "batteries": "battery", "leafs": "leaf", "women": "woman",
    "glasses": "glass", "classes": "class", "tablets": "tablet", "charges": "charge", "purses": "purse", "wishes": "wish", "foxes": "fox", "houses": "house",
    "horses": "horse", "cases": "case", "movies": "movie", "shoes": "shoe", "photos": "photo", "bonuses": "bonus", "irises": "iris", "dresses": "dress", "men": "man",
    # stay whole: no rule leads to a known word, or they are no plurals
    "christmas": "christmas", "canvas": "canvas", "bus": "bus", "class": "class", "iris": "iris", "unheardofs": "unheardofs", "running": "running", "always": "always",
    "news": "news", "series": "series", "this": "this", "gas": "gas", "abs": "abs", "specimen": "specimen",
    # irregular
    "knives": "knife", "children": "child", "feet": "foot", "heroes": "hero",
}


def tables(spark, known=KNOWN):
    words = spark.createDataFrame([(w,) for w in [*EXPECTED, *EXPECTED, None, ""]], "word string")
    return words, spark.createDataFrame([(w,) for w in known], "word string")


def test_words_by_hand(spark):
    words, known = tables(spark)
    found = {r.form: r.lemma for r in lemmas.lemma_table(words, known.where(~F.col("word").isin("siz", "clas", "len"))).collect()}
    assert found == {form: lemma for form, lemma in EXPECTED.items() if form != lemma}
    # the shortest known word counts
    sizes = spark.createDataFrame([("sizes",)], "word string")
    assert lemmas.lemma_table(sizes, known.where("word <> 'siz'")).first().lemma == "size"
    assert lemmas.lemma_table(sizes, known).first().lemma == "siz"


def test_both_ways_to_apply_a_table(spark):
    words, known = tables(spark)
    table = lemmas.lemma_table(words, known.where(~F.col("word").isin("siz", "clas", "len"))).cache()
    rows = [(1, ["prizes", "of", "prizes", "unheardofs"]), (1, ["prizes", "of", "prizes", "unheardofs"]), (2, []), (3, None), (None, ["men"]), (4, ["bus", None, "buses"])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "id long, tokens array<string>, lemma string")
    want = sorted(map(str, [(1, ["prize", "of", "prize", "unheardofs"])] * 2 + [(2, []), (3, None), (None, ["man"]), (4, ["bus", None, "bus"])]))
    for limit in (1000, 3):
        out = lemmas.with_lemmas(docs, table, literal_forms=limit)
        assert out.columns == docs.columns
        assert sorted(str((r.id, r.tokens)) for r in out.collect()) == want
    assert lemmas.with_lemmas(docs.where("id > 9"), table).count() == 0
    assert lemmas.with_lemmas(docs, table.where("form = 'nothing'")).where("id = 1").first().tokens[0] == "prizes"


def test_known_words_are_learned_from_the_texts(spark):
    texts = spark.createDataFrame([(["caches", "cache", "typo"],), (["cache", "typos"],), (["caches"],), (None,)], "tokens array<string>")
    found = {(r.form, r.lemma) for r in lemmas.learned_lemmas(texts, F.col("tokens")).collect()}
    assert found == {("caches", "cache")}  # "typo" is in one text only
