"""Text cleaning, tokenising and sentence splitting as Column expressions.

Everything here stays in the JVM: no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.constants import (
    IRREGULAR_NOUNS, MAX_SCORED_CHARS, MIN_TOKEN_CHARS, SPACE_CLASS, SPLIT_WORDS, STOP_WORDS, WHITESPACE,
)

SPACES = f"[{SPACE_CLASS}]+"
SPLIT_PATTERN = r"\b(?:" + "|".join(f"({a})({b})" for a, b in SPLIT_WORDS) + r")\b"
SPLIT_RESULT = (
    "".join(f"${2 * i + 1}" for i in range(len(SPLIT_WORDS)))
    + " "
    + "".join(f"${2 * i + 2}" for i in range(len(SPLIT_WORDS)))
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Cut white space (in the Unicode sense) off both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Lower-case, delete all but the letters a-z and white space, collapse white space."""
    letters = F.regexp_replace(F.lower(text), f"[^a-z{SPACE_CLASS}]+", "")
    return F.trim(F.regexp_replace(letters, SPACES, " "))


def tokens(cleaned: Column) -> Column:
    """Words of a cleaned text; a few fused forms (``cannot``, ``gonna``) become two words."""
    return F.split(F.regexp_replace(cleaned, SPLIT_PATTERN, SPLIT_RESULT), " ")


def content_words(words: Column, stop_words=STOP_WORDS) -> Column:
    """Drop stop words and words of one or two letters; repeated words stay."""
    return F.filter(words, lambda w: (F.length(w) >= MIN_TOKEN_CHARS) & ~w.isin(*stop_words))


def noun_lemma(word: Column, lexicon: dict[str, str] | None = None) -> Column:
    """Singular of a plural noun by a lexicon of forms, else by suffix; verbs and adjectives stay as they are."""
    def ends(*suffixes):
        found = F.endswith(word, F.lit(suffixes[0]))
        for suffix in suffixes[1:]:
            found = found | F.endswith(word, F.lit(suffix))
        return found

    def swap(cut: int, ending: str = "") -> Column:
        stem = F.substring(word, F.lit(1), F.length(word) - cut)
        return F.concat(stem, F.lit(ending)) if ending else stem

    known = F.create_map(*(F.lit(x) for pair in (IRREGULAR_NOUNS if lexicon is None else lexicon).items() for x in pair))
    rules = (
        F.when(ends("men") & (word.isin("men", "women") | ends("smen", "kmen", "dmen", "remen", "cemen")), swap(2, "an"))
        .when((F.length(word) <= 3) | ~ends("s") | ends("ss", "us", "is"), word)
        .when(ends("ies") & (F.length(word) > 4), swap(3, "y"))
        .when(ends("ches", "shes", "xes", "zes", "sses"), swap(2))
        .when(ends("lves", "eaves", "oaves", "ieves"), swap(3, "f"))
        .otherwise(swap(1))
    )
    return F.coalesce(F.element_at(known, word), rules)


def processed_tokens(text: Column) -> Column:
    """Raw text to lemmas of its content words, in order."""
    return F.transform(content_words(tokens(clean_text(text))), lambda word: noun_lemma(word))


def processed_text(text: Column) -> Column:
    return F.array_join(processed_tokens(text), " ")


def ngrams(words: Column) -> Column:
    """All words followed by all pairs of neighbouring words."""
    def both(w):
        pairs = F.zip_with(
            F.slice(w, F.lit(1), F.size(w) - 1),
            F.slice(w, F.lit(2), F.size(w) - 1),
            lambda a, b: F.concat(a, F.lit(" "), b),
        )
        return F.when(F.size(w) > 1, F.concat(w, pairs)).otherwise(w)

    return let(words, both)


def term_counts(terms: Column) -> Column:
    """Distinct terms with their counts, as ``array<struct<term, tf>>``.

    Sorts within the row and measures the runs, so counting needs no shuffle:
    a document never leaves its task until its terms are already aggregated.
    """
    def runs(ordered):
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(starts, lambda s: F.transform(s, lambda i, k: F.struct(
            F.get(ordered, i).alias("term"),
            (F.coalesce(F.get(s, k + 1), size) - i).cast("long").alias("tf"),
        )))

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return let(F.sort_array(terms), lambda o: F.when(F.size(o) > 0, runs(o)).otherwise(empty))


def word_pattern_tokens(text: Column) -> Column:
    """Runs of two or more letters, digits or underscores of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def sentence_terms(sentence: Column, stop_words=STOP_WORDS) -> Column:
    return F.filter(word_pattern_tokens(sentence), lambda w: ~w.isin(*stop_words))


def sentences(text: Column) -> Column:
    """Cut after ``.``, ``!`` or ``?`` where white space follows; no empty parts."""
    parts = F.split(text, f"(?<=[.!?]){SPACES}")
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) > 0)


def slug(value: Column) -> Column:
    """Lower-case name with ``-`` for everything but letters and digits."""
    dashed = F.regexp_replace(F.lower(strip(value)), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.btrim(dashed, F.lit("-")), F.lit("")), F.lit("misc"))


def scored_part(text: Column) -> Column:
    """The part of a text that outside models get to see."""
    return F.substring(text, 1, MAX_SCORED_CHARS)
