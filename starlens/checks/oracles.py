"""The same results in DuckDB SQL, for checking the queries.

Written from the definitions, with joins, windows and lists as SQL has them,
and not from the Spark plans.
"""

from __future__ import annotations

from starlens.constants import (
    BASELINE_ROWS, CHUNK_CHARS, CLS_ID, FIRST_WORD_ID, IRREGULAR_NOUNS, MAX_SEQUENCE, MIN_CATEGORY_REVIEWS, NEUTRAL_BOOST,
    NEUTRAL_REBOOST, PAD_ID, PARTIAL_CHARS, REVIEWS_PER_RATING, SAMPLE_ROWS, SENTIMENTS, SEP_ID, SPACE_CLASS,
    SPLIT_WORDS, STOP_WORDS, TOP_CATEGORIES, UNK_ID, VOCABULARY_SIZE, WHITESPACE,
)
from starlens.operators.lemmas import DETACHMENTS, LEAST_FORM, LEAST_LEMMA, LEAST_TEXTS

STOP = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"
CLASSES = "(VALUES ('Negative', 0), ('Neutral', 1), ('Positive', 2))"


# --- scalar expressions -----------------------------------------------------------------


def strip(x):
    return f"trim({x}, '{WHITESPACE}')"


def clean(x):
    return (f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z{SPACE_CLASS}]', '', 'g'), "
            f"'[{SPACE_CLASS}]+', ' ', 'g'))")


def words(x):
    text = clean(x)
    for a, b in SPLIT_WORDS:
        text = f"regexp_replace({text}, '\\b{a}{b}\\b', '{a} {b}', 'g')"
    return f"string_split({text}, ' ')"


def content(x):
    return f"list_filter({words(x)}, lambda w: length(w) > 2 AND w NOT IN {STOP})"


def lemma(w):
    known = " ".join(f"WHEN {w} = '{form}' THEN '{base}'" for form, base in IRREGULAR_NOUNS.items())
    return f"""CASE {known} WHEN {w} IN ('men', 'women') OR regexp_matches({w}, '(s|k|d|re|ce)men$') THEN regexp_replace({w}, 'men$', 'man')
      WHEN length({w}) <= 3 OR NOT regexp_matches({w}, 's$') OR regexp_matches({w}, '(ss|us|is)$') THEN {w}
      WHEN length({w}) > 4 AND regexp_matches({w}, 'ies$') THEN regexp_replace({w}, 'ies$', 'y')
      WHEN regexp_matches({w}, '(ch|sh|x|z|ss)es$') THEN regexp_replace({w}, 'es$', '')
      WHEN regexp_matches({w}, '(l|ea|oa|ie)ves$') THEN regexp_replace({w}, 'ves$', 'f')
      ELSE regexp_replace({w}, 's$', '') END"""


def lexicon_sql():
    """CTEs: words with the number of their texts, and the forms that change with their lemmas."""
    rules = " UNION ALL ".join(
        f"SELECT word, regexp_replace(word, '{ending}$', '{new}') AS c FROM known WHERE ends_with(word, '{ending}')"
        + (f" AND length(word) >= {LEAST_FORM} AND NOT ends_with(word, 'ss')" if ending == "s" else "") for ending, new in DETACHMENTS
    )
    fixed = ", ".join(f"('{form}', '{base}')" for form, base in IRREGULAR_NOUNS.items())
    return f"""known AS (SELECT word, count(DISTINCT doc_id) AS n_texts FROM (SELECT doc_id, unnest({content('text')}) AS word FROM documents) WHERE word <> '' GROUP BY word),
      tried AS ({rules} UNION ALL SELECT word, word FROM known),
      irregular AS (SELECT * FROM (VALUES {fixed}) AS v(word, lemma)),
      regular AS (SELECT t.word, first(t.c ORDER BY length(t.c), t.c) AS lemma FROM tried t JOIN known k ON k.word = t.c AND k.n_texts >= {LEAST_TEXTS}
        WHERE length(t.c) >= {LEAST_LEMMA} AND t.word NOT IN (SELECT word FROM irregular) GROUP BY t.word),
      changed AS (SELECT k.word, coalesce(i.lemma, r.lemma, k.word) AS lemma, k.n_texts FROM known k LEFT JOIN irregular i USING (word) LEFT JOIN regular r USING (word))"""


def processed(x):
    return f"list_transform({content(x)}, lambda w: {lemma('w')})"


def slug(x):
    return (f"coalesce(nullif(regexp_replace(regexp_replace(lower({strip(x)}), '[^a-z0-9]+', '-', 'g'), "
            f"'^-+|-+$', '', 'g'), ''), 'misc')")


def sentence_list(x):
    marked = f"regexp_replace({x}, '([.!?])[{SPACE_CLASS}]+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: length(s) > 0)"


def word_terms(x):
    return (f"list_filter(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w NOT IN {STOP})")


def key(x="review_id"):
    return f"md5(CAST({x} AS VARCHAR) || ':42')"


def div(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def sentiment(x):
    return (f"CASE WHEN {x} IN (1, 2, 3) THEN 'Negative' WHEN {x} = 4 THEN 'Neutral' "
            f"WHEN {x} = 5 THEN 'Positive' ELSE 'Unknown' END")


# --- shared tables ----------------------------------------------------------------------

RAW = """raw AS (
  SELECT doc_id AS review_id, text,
    CASE WHEN doc_id % 17 = 0 THEN 'n/a' WHEN doc_id % 19 = 0 THEN '4.5' ELSE CAST(doc_id % 5 + 1 AS VARCHAR) END AS rating,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN ' , ' ELSE source || ', ' || lang END AS categories
  FROM documents)"""

RATED = f"""{RAW}, rated AS (
  SELECT *, {sentiment('TRY_CAST(rating AS DOUBLE)')} AS sentiment FROM raw)"""

NORMAL = f"""{RAW}, normal AS (
  SELECT review_id, {strip('text')} AS text, CAST(round_even(TRY_CAST(rating AS DOUBLE), 0) AS INTEGER) AS rating,
    coalesce(categories, '') AS categories
  FROM raw WHERE length({strip('text')}) > 0 AND round_even(TRY_CAST(rating AS DOUBLE), 0) BETWEEN 1 AND 5)"""

EXPLODED = f"""{NORMAL}, listed AS (
  SELECT *, list_filter(list_transform(string_split(categories, ','), lambda c: {strip('c')}), lambda c: length(c) > 0) AS l
  FROM normal), exploded AS (
  SELECT review_id, text, rating, unnest(CASE WHEN len(l) = 0 THEN ['Unknown'] ELSE l END) AS category FROM listed)"""

LABELLED = f"""labelled AS (
  SELECT review_id, text, sentiment FROM (
    SELECT d.doc_id AS review_id, d.text,
      {sentiment('CASE WHEN l.quality = 0 THEN 1 WHEN l.toxic = 1 THEN 4 ELSE 5 END')} AS sentiment
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
  WHERE text IS NOT NULL AND length(text) >= 10 AND sentiment <> 'Unknown')"""


def split_of(table, carried=""):
    return f"""split AS MATERIALIZED (
  SELECT review_id, sentiment{carried}, CASE WHEN place <= round(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {key()}, review_id) AS place,
      count(*) OVER (PARTITION BY sentiment) AS n FROM {table}))"""


COPIES = f"""train AS MATERIALIZED (
  SELECT *, 1 + CASE WHEN sentiment <> 'Neutral' THEN 0
      ELSE (neg - neu) // neu + CASE WHEN place <= (neg - neu) % neu THEN 1 ELSE 0 END END AS copies FROM (
    SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {key()}, review_id) AS place,
      count(*) FILTER (WHERE sentiment = 'Negative') OVER () AS neg,
      count(*) FILTER (WHERE sentiment = 'Neutral') OVER () AS neu
    FROM split WHERE split = 'train'))"""

# Training ids without looking at the texts, and with them.
TRAIN_IDS = f"{LABELLED}, {split_of('labelled')}, {COPIES}"

READY = f"""{LABELLED}, ready AS MATERIALIZED (
  SELECT review_id, sentiment, tokens FROM (SELECT *, {processed('text')} AS tokens FROM labelled) WHERE len(tokens) > 0)"""

CORPUS = f"""{READY}, {split_of('ready', ', tokens')}, {COPIES}, tf AS MATERIALIZED (
  SELECT review_id, term, count(*) AS tf FROM (
    SELECT review_id, unnest(tokens) AS term FROM split
    UNION ALL
    SELECT review_id, unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) FROM split)
  GROUP BY review_id, term), stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf JOIN train USING (review_id) GROUP BY term), vocab AS MATERIALIZED (
  SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df, cf,
    ln((1 + n) / CAST(1 + df AS DOUBLE)) + 1 AS idf
  FROM (SELECT s.*, n FROM stats s, (SELECT CAST(count(*) AS DOUBLE) AS n FROM train) WHERE df >= 2 AND df <= CAST(0.8 AS DOUBLE) * n
    ORDER BY cf DESC, term LIMIT {VOCABULARY_SIZE}))"""

TFIDF = """weights AS (
  SELECT review_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS value FROM (
    SELECT review_id, term, idx, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)))"""


def bayes(kind="Count", boost=1.0, tag="", smoothed=0):
    """Model and scored test rows; the tag keeps several models apart in one statement. ``smoothed`` is added to the class counts of the priors."""
    value = "CAST(tf AS DOUBLE)" if kind == "Count" else "value"
    rows = "tf JOIN vocab USING (term)" if kind == "Count" else "weights"
    share = f"copies * CASE WHEN sentiment = 'Neutral' THEN CAST({boost} AS DOUBLE) ELSE 1 END"
    return f"""x{tag} AS (SELECT review_id, term, {value} AS v FROM {rows}), sums{tag} AS (
  SELECT term, c.s, coalesce(sum(v * {share}) FILTER (WHERE sentiment = c.s), 0) AS total
  FROM x{tag} JOIN train USING (review_id) CROSS JOIN {CLASSES} AS c(s, code) GROUP BY term, c.s), liken{tag} AS (
  SELECT term, s, ln((total + 1) / (sum(total) OVER (PARTITION BY s) + count(*) OVER (PARTITION BY s))) AS lp FROM sums{tag}), prior{tag} AS (
  SELECT sentiment AS s, ln((sum({share}) + {smoothed}) / (sum(sum({share})) OVER () + 3 * {smoothed})) AS lp FROM train GROUP BY sentiment), joint{tag} AS (
  SELECT t.review_id, t.sentiment AS actual, p.s, p.lp + coalesce(sum(x.v * l.lp), 0) AS ll
  FROM (SELECT * FROM split WHERE split = 'test') t CROSS JOIN prior{tag} p
  LEFT JOIN x{tag} x ON x.review_id = t.review_id AND EXISTS (SELECT 1 FROM liken{tag} q WHERE q.term = x.term)
  LEFT JOIN liken{tag} l ON l.term = x.term AND l.s = p.s
  GROUP BY t.review_id, t.sentiment, p.s, p.lp), wide{tag} AS (
  SELECT review_id, actual, max(ll) AS top, max(ll) FILTER (WHERE s = 'Negative') AS a, max(ll) FILTER (WHERE s = 'Neutral') AS b,
    max(ll) FILTER (WHERE s = 'Positive') AS c FROM joint{tag} GROUP BY review_id, actual), scored{tag} AS (
  SELECT review_id, actual,
    CASE WHEN round(a, 6) = round(top, 6) THEN 'Negative' WHEN round(b, 6) = round(top, 6) THEN 'Neutral' ELSE 'Positive' END AS sentiment,
    round(1 / z, 6) AS confidence, round(exp(a - top) / z, 6) AS prob_negative, round(exp(b - top) / z, 6) AS prob_neutral,
    round(exp(c - top) / z, 6) AS prob_positive
  FROM (SELECT *, exp(a - top) + exp(b - top) + exp(c - top) AS z FROM wide{tag}))"""


SCORED = f"{CORPUS}, {bayes()}"


def measures(source, keys=""):
    """Per-class counts, then per-class and overall measures of ``source(actual, predicted)``."""
    lead = f"{keys}, " if keys else ""
    same = f"USING ({keys})" if keys else "ON true"
    return f"""each_class AS (
  SELECT {lead}c.s AS sentiment, c.code, count(*) FILTER (WHERE actual = c.s AND predicted = c.s) AS tp,
    count(*) FILTER (WHERE predicted = c.s) AS pred, count(*) FILTER (WHERE actual = c.s) AS support
  FROM {source} CROSS JOIN {CLASSES} AS c(s, code) GROUP BY {lead}c.s, c.code), rates AS (
  SELECT *, {div('tp', 'pred')} AS p, {div('tp', 'support')} AS r, {div('2 * tp', 'pred + support')} AS f FROM each_class), overall AS (
  SELECT {lead}CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy, sum(p * support) / sum(support) AS wp, sum(r * support) / sum(support) AS wr,
    sum(f * support) / sum(support) AS wf, avg(p) FILTER (WHERE pred + support > 0) AS mp, avg(r) FILTER (WHERE pred + support > 0) AS mr,
    avg(f) FILTER (WHERE pred + support > 0) AS mf, CAST(sum(support) AS BIGINT) AS n
  FROM rates {('GROUP BY ' + keys) if keys else ''})"""


PREDICTED = f"{SCORED}, predictions AS (SELECT review_id, actual, sentiment AS predicted FROM scored)"

MODELS = [("Naive Bayes", 1.0), ("Naive Bayes boosted", NEUTRAL_BOOST), ("Naive Bayes reboosted", NEUTRAL_BOOST * NEUTRAL_REBOOST)]


def model_metrics(models):
    parts, unions, ordinal = [CORPUS, TFIDF], [], 0
    for vectorizer in ("Count", "TF-IDF"):
        for name, boost in models:
            parts.append(bayes(vectorizer, boost, f"_{ordinal}"))
            unions.append(f"SELECT '{vectorizer}' AS vectorizer, '{name}' AS model, {ordinal} AS ordinal, actual, sentiment AS predicted FROM scored_{ordinal}")
            ordinal += 1
    parts.append("all_predictions AS (" + " UNION ALL ".join(unions) + ")")
    parts.append(measures("all_predictions", "vectorizer, model, ordinal"))
    parts.append("metrics AS (SELECT vectorizer, model, ordinal, round(accuracy, 6) AS accuracy, round(wp, 6) AS precision, "
                 "round(wr, 6) AS recall, round(wf, 6) AS f1, round(mf, 6) AS f1_macro FROM overall)")
    return ", ".join(parts)


# --- summaries --------------------------------------------------------------------------


def chosen(where="true", top_n=TOP_CATEGORIES, least=MIN_CATEGORY_REVIEWS):
    limit = f"LIMIT {top_n}" if top_n else ""
    return f"""chosen AS (
  SELECT category, count(*) AS total_reviews FROM exploded WHERE {where} GROUP BY category HAVING count(*) >= {least}
  ORDER BY count(*) DESC, category {limit})"""


def sampled(cap=REVIEWS_PER_RATING):
    keep = f"WHERE place <= {cap}" if cap else ""
    return f"""sampled AS (
  SELECT category, rating, review_id, text FROM (
    SELECT *, row_number() OVER (PARTITION BY category, rating ORDER BY {key()}, review_id) AS place
    FROM exploded WHERE category IN (SELECT category FROM chosen)) {keep})"""


def corpus_of(source):
    return f"""corpus AS (
  SELECT category, rating, review_id, unnest(l) AS sentence, unnest(range(len(l))) AS pos
  FROM (SELECT *, {sentence_list('text')} AS l FROM {source}))"""


DISTINCT = """sents AS (
  SELECT category, rating, review_id, pos, sentence FROM (
    SELECT *, row_number() OVER (PARTITION BY category, rating, lower(sentence) ORDER BY review_id, pos) AS place
    FROM corpus WHERE length(sentence) BETWEEN 30 AND 400) WHERE place = 1)"""

SENTENCE_TFIDF = f"""stf AS (
  SELECT category, rating, review_id, pos, term, count(*) AS tf
  FROM (SELECT category, rating, review_id, pos, unnest({word_terms('sentence')}) AS term FROM sents) GROUP BY ALL), sizes AS (
  SELECT category, rating, count(*) AS n FROM sents GROUP BY ALL), sdf AS (
  SELECT category, rating, term, count(*) AS df FROM stf GROUP BY ALL), sw AS (
  SELECT category, rating, review_id, pos, term, n, tf * (ln(CAST(1 + n AS DOUBLE) / (1 + df)) + 1) AS w
  FROM stf JOIN sdf USING (category, rating, term) JOIN sizes USING (category, rating) WHERE df <= CAST(0.9 AS DOUBLE) * n), sweights AS (
  SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY category, rating, review_id, pos)) AS weight FROM sw)"""

SENTENCE_SCORES = f"""{SENTENCE_TFIDF}, centroid AS (
  SELECT category, rating, term, sum(weight) / max(n) AS mean FROM sweights GROUP BY ALL), norms AS (
  SELECT category, rating, sqrt(sum(mean * mean)) AS norm FROM centroid GROUP BY ALL), dots AS (
  SELECT category, rating, review_id, pos, sum(weight * mean) AS dot FROM sweights JOIN centroid USING (category, rating, term) GROUP BY ALL), scores AS (
  SELECT category, rating, review_id, pos, sentence, round(coalesce(dot / norm, 0), 6) AS score
  FROM sents LEFT JOIN dots USING (category, rating, review_id, pos) LEFT JOIN norms USING (category, rating))"""

SUMMARY = """summaries AS (
  SELECT category, rating, string_agg(sentence, ' ' ORDER BY review_id, pos) AS summary FROM (
    SELECT *, row_number() OVER (PARTITION BY category, rating ORDER BY score DESC, review_id, pos) AS place FROM scores)
  WHERE place <= 6 GROUP BY category, rating)"""


def flat_of(cap=REVIEWS_PER_RATING):
    kept = f"least(count(e.review_id), {cap})" if cap else "count(e.review_id)"
    return f"""flat AS (
  SELECT c.category, {slug('c.category')} AS category_slug, c.total_reviews, r.rating, count(e.review_id) AS review_count,
    {kept} AS sampled, coalesce(max(s.summary), '') AS summary
  FROM chosen c CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS r(rating)
  LEFT JOIN exploded e ON e.category = c.category AND e.rating = r.rating
  LEFT JOIN summaries s ON s.category = c.category AND s.rating = r.rating
  GROUP BY c.category, c.total_reviews, r.rating)"""


def summary_sql(where="true", top_n=TOP_CATEGORIES, least=MIN_CATEGORY_REVIEWS, cap=REVIEWS_PER_RATING):
    return ", ".join([EXPLODED, chosen(where, top_n, least), sampled(cap), corpus_of("sampled"), DISTINCT,
                      SENTENCE_SCORES, SUMMARY, flat_of(cap)])


SRC = "contains(lower(category), 'src')"
FLAT = "SELECT category, category_slug, total_reviews, rating, review_count, sampled, summary FROM flat"
BY_LANGUAGE = f"""{NORMAL}, grouped AS (
  SELECT d.lang AS category, n.rating, n.review_id, n.text FROM normal n JOIN documents d ON d.doc_id = n.review_id)"""
LANGUAGE_SENTENCES = f"{BY_LANGUAGE}, {corpus_of('grouped')}, {DISTINCT}"


def packed(source):
    """Greedy packing by recursion over the sentences of each group."""
    return f"""RECURSIVE {source}, ordered AS (
  SELECT category, rating, sentence, length(sentence) AS chars, row_number() OVER (PARTITION BY category, rating ORDER BY review_id, pos) AS i
  FROM corpus), walk AS (
  SELECT category, rating, i, CAST(0 AS BIGINT) AS chunk_no, CAST(chars + 1 AS BIGINT) AS total FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.category, o.rating, o.i, w.chunk_no + CASE WHEN w.total + o.chars + 1 > {CHUNK_CHARS} THEN 1 ELSE 0 END,
    CASE WHEN w.total + o.chars + 1 > {CHUNK_CHARS} THEN o.chars ELSE w.total + o.chars + 1 END
  FROM walk w JOIN ordered o ON o.category = w.category AND o.rating = w.rating AND o.i = w.i + 1), packed AS (
  SELECT category, rating, chunk_no, string_agg(sentence, ' ' ORDER BY i) AS chunk
  FROM walk JOIN ordered USING (category, rating, i) GROUP BY category, rating, chunk_no)"""


def two_level():
    first = packed(f"{EXPLODED}, {chosen()}, {sampled()}, {corpus_of('sampled')}")
    return f"""{first}, partials AS (SELECT category, rating, chunk_no, substr(chunk, 1, {PARTIAL_CHARS}) AS partial FROM packed), summaries AS (
  SELECT category, rating, CASE WHEN count(*) = 1 THEN min(partial) ELSE substr(string_agg(partial, ' ' ORDER BY chunk_no), 1, {PARTIAL_CHARS}) END AS summary
  FROM partials GROUP BY category, rating),
{flat_of()}"""


def two_level_extractive():
    """Extractive summaries of the chunks of each group, and of these where a group has several."""
    first = packed(f"{EXPLODED}, {chosen()}, {sampled()}, {corpus_of('sampled')}")
    by_chunk = "corpus AS (SELECT category || chr(31) || chunk_no AS category, rating, i AS review_id, 0 AS pos, sentence FROM walk JOIN ordered USING (category, rating, i))"
    of_partials = (f"corpus AS (SELECT category, rating, chunk_no AS review_id, unnest(l) AS sentence, unnest(range(len(l))) AS pos "
                   f"FROM (SELECT *, {sentence_list('partial')} AS l FROM partials))")
    return f"""{first}, partials AS MATERIALIZED (
  WITH {by_chunk}, {DISTINCT}, {SENTENCE_SCORES}, {SUMMARY}
  SELECT split_part(category, chr(31), 1) AS category, rating, CAST(split_part(category, chr(31), 2) AS BIGINT) AS chunk_no, summary AS partial FROM summaries), unified AS MATERIALIZED (
  WITH {of_partials}, {DISTINCT}, {SENTENCE_SCORES}, {SUMMARY} SELECT * FROM summaries), summaries AS (
  SELECT category, rating, CASE WHEN n = 1 THEN single ELSE coalesce(u.summary, '') END AS summary
  FROM (SELECT category, rating, count(*) AS n, min(partial) AS single FROM partials GROUP BY category, rating) LEFT JOIN unified u USING (category, rating)),
{flat_of()}"""


# --- the queries ------------------------------------------------------------------------


def with_(tables, body):
    return f"WITH {tables}\n{body}"


def oracle_sql() -> dict[str, str]:
    latin = "regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g')"
    union = f"""{RAW}, both_sources AS (
      SELECT CAST(review_id AS VARCHAR) AS source_key, 'hub' AS data_source, text, rating, categories FROM raw
      UNION ALL SELECT conv_id || '-' || turn, 'local', text, CAST(turn % 5 + 1 AS VARCHAR), NULL FROM conversations)"""
    stages = [("has_text", "text IS NOT NULL"), ("long_enough", "length(text) >= 10"), ("known_sentiment", "sentiment <> 'Unknown'"),
              ("cleaned", f"length({clean('text')}) > 0"), ("processed", f"len({processed('text')}) > 0")]
    funnel, before = [], "true"
    for name, test in stages:
        after = f"{before} AND {test}"
        funnel.append(f"SELECT '{name}' AS stage, count(*) FILTER (WHERE {before}) AS rows_in, count(*) FILTER (WHERE {after}) AS rows_out, "
                      f"count(*) FILTER (WHERE {before}) - count(*) FILTER (WHERE {after}) AS removed FROM rated")
        before = after
    encode = f"""{LABELLED}, {split_of('labelled', ', text')}, tokens AS (
      SELECT review_id, split, list_filter({words('text')}, lambda w: length(w) > 0) AS t FROM split), freq AS (
      SELECT term, count(*) AS cf FROM (SELECT unnest(t) AS term FROM tokens WHERE split = 'train') GROUP BY term), dictionary AS (
      SELECT term, {FIRST_WORD_ID} - 1 + row_number() OVER (ORDER BY cf DESC, term) AS id FROM (SELECT * FROM freq ORDER BY cf DESC, term LIMIT {VOCABULARY_SIZE})), shown AS (
      SELECT review_id, split, t[1:{MAX_SEQUENCE - 2}] AS t FROM tokens), longest AS (
      SELECT split, max(len(t)) + 2 AS n FROM shown GROUP BY split), placed AS (
      SELECT review_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM shown), ids AS (
      SELECT review_id, string_agg(CAST(coalesce(id, {UNK_ID}) AS VARCHAR), ' ' ORDER BY pos) AS body FROM placed LEFT JOIN dictionary USING (term) GROUP BY review_id)"""
    tuned = model_metrics(MODELS[:2])
    names = "('LABEL_0'), ('LABEL_1'), ('LABEL_2'), ('1 star'), ('3 stars'), ('4 stars'), ('neutral'), ('positive')"
    sql = {
        "csv_read": with_(RAW, "SELECT review_id, length(text) AS n_chars, rating, CASE WHEN review_id % 2 = 0 THEN categories END AS categories FROM raw"),
        "csv_encodings": with_(RAW, f"SELECT review_id, md5(regexp_replace({latin}, '\\r\\n?', chr(10), 'g')) AS text_md5 FROM raw"),
        "csv_first_rows": "SELECT CAST(5 AS BIGINT) AS n, CAST(4 AS BIGINT) AS files FROM documents HAVING count(*) >= 20",
        "adapter_star": "SELECT doc_id AS review_id, text, doc_id % 5 + 1 AS rating FROM documents",
        "adapter_binary": "SELECT d.doc_id AS review_id, text, CASE toxic WHEN 0 THEN 5 ELSE 2 END AS rating FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
        "normalize_schema": with_(NORMAL, "SELECT * FROM normal"),
        "detected_columns": "SELECT 'documents' AS table_name, 'text' AS text_column, '' AS rating_column, count(text) AS n FROM documents "
            "UNION ALL SELECT 'conversations', 'text', '', count(text) FROM conversations UNION ALL SELECT 'benchmark', 'text', '', count(text) FROM benchmark "
            "UNION ALL SELECT 'pages', 'page_id', '', count(page_id) FROM pages",
        "union_sources": with_(union, "SELECT * FROM both_sources"),
        "source_counts": with_(union, "SELECT data_source, count(*) AS n FROM both_sources GROUP BY data_source"),
        "catalogue_read": with_(summary_sql(), "SELECT category, category_slug, total_reviews, rating, review_count, sampled, length(summary) AS summary_chars, md5(summary) AS summary_md5 FROM flat"),
        "catalogue_entry": with_(summary_sql(), f"{FLAT} WHERE category_slug = (SELECT category_slug FROM flat ORDER BY total_reviews DESC, category LIMIT 1)"),
        "scored_csv": with_(SCORED, "SELECT review_id, sentiment, confidence FROM scored"),
        "sentiment_labels": with_(RATED, "SELECT review_id, rating, sentiment FROM rated"),
        "rating_coercion": with_(RAW, "SELECT review_id, CAST(round_even(TRY_CAST(rating AS DOUBLE), 0) AS INTEGER) AS whole, "
            "CAST(round_even(CAST(review_id AS DOUBLE) / 4, 0) AS INTEGER) AS quarter FROM raw"),
        "label_codes": with_(RATED, f"SELECT review_id, sentiment, c.code, coalesce(c.s, 'Unknown') AS decoded FROM rated LEFT JOIN {CLASSES} AS c(s, code) ON c.s = sentiment"),
        "label_normalise": with_(f"{RAW}, names AS (SELECT name, row_number() OVER () - 1 AS i FROM (VALUES {names}) AS v(name))",
            "SELECT review_id, name AS label, CASE WHEN regexp_matches(upper(name), 'NEGATIVE|1|2|LABEL_0') THEN 'Negative' "
            "WHEN regexp_matches(upper(name), 'NEUTRAL|3|LABEL_1') THEN 'Neutral' ELSE 'Positive' END AS sentiment FROM raw JOIN names ON i = review_id % 8"),
        "clean_text": f"SELECT doc_id AS review_id, {clean('text')} AS cleaned_text FROM documents",
        "tokens": f"SELECT doc_id AS review_id, array_to_string({words('text')}, '|') AS tokens FROM documents",
        "content_words": f"SELECT doc_id AS review_id, array_to_string({content('text')}, '|') AS words FROM documents",
        "lemmas": f"SELECT word, {lemma('word')} AS lemma, count(*) AS n FROM (SELECT unnest({words('text')}) AS word FROM documents) GROUP BY word",
        "stream_summary": with_(f"{RATED}, timed AS (SELECT DISTINCT review_id, sentiment, 1704067200 + review_id * 3600 AS t FROM rated WHERE sentiment IS NOT NULL), "
            "days AS (SELECT t - t % 86400 AS window_start, sentiment, count(*) AS n FROM timed GROUP BY ALL), "
            "totals AS (SELECT window_start, sum(n) AS total FROM days GROUP BY window_start)",
            f"SELECT t.window_start, c.s AS sentiment, coalesce(d.n, 0) AS n, round(100.0 * CAST(coalesce(d.n, 0) AS DOUBLE) / total, 1) AS pct "
            f"FROM totals t CROSS JOIN {CLASSES} AS c(s, code) LEFT JOIN days d ON d.window_start = t.window_start AND d.sentiment = c.s"),
        "lemma_lookup": with_(lexicon_sql(), "SELECT word, lemma, n_texts FROM changed"),
        "processed_lookup": with_(f"{lexicon_sql()}, placed AS (SELECT doc_id, unnest({content('text')}) AS word, generate_subscripts({content('text')}, 1) AS i FROM documents)",
            "SELECT d.doc_id AS review_id, coalesce(p.t, '') AS processed_text FROM documents d LEFT JOIN "
            "(SELECT doc_id, string_agg(lemma, ' ' ORDER BY i) AS t FROM placed JOIN changed USING (word) GROUP BY doc_id) p USING (doc_id)"),
        "processed_text": f"SELECT doc_id AS review_id, array_to_string({processed('text')}, ' ') AS processed_text FROM documents",
        "slugs": with_(f"{EXPLODED}, named AS (SELECT DISTINCT '  ' || category || ' & Co., ' || rating || '!! ' AS name FROM exploded)", f"SELECT name, {slug('name')} AS slug FROM named"),
        "sentences": f"SELECT doc_id AS review_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence FROM (SELECT doc_id, {sentence_list('text')} AS l FROM documents)",
        "scored_part": "SELECT doc_id AS review_id, substr(text, 1, 1000) AS shown FROM documents",
        "usable_reviews": with_(RATED, "SELECT review_id, sentiment FROM rated WHERE text IS NOT NULL AND length(text) >= 10 AND sentiment <> 'Unknown'"),
        "processed_reviews": with_(RATED, f"SELECT review_id, CAST(len({processed('text')}) AS INTEGER) AS n_tokens FROM rated WHERE length(text) >= 10 AND sentiment <> 'Unknown' AND length({clean('text')}) > 0 AND len({processed('text')}) > 0"),
        "category_is": with_(EXPLODED, f"SELECT * FROM (SELECT review_id, replace(category, 'src', 'Src & ') AS category, rating FROM exploded) WHERE lower(category) = 'src-1' OR {slug('category')} = 'src-1'"),
        "category_contains": with_(EXPLODED, f"SELECT category, {slug('category')} AS category_slug, count(*) AS total_reviews FROM exploded WHERE contains(lower(category), 'src1') GROUP BY category HAVING count(*) >= 20 ORDER BY count(*) DESC, category LIMIT 5"),
        "category_members": with_(EXPLODED, "SELECT review_id, category FROM exploded WHERE category IN (SELECT category FROM exploded GROUP BY category ORDER BY count(*) DESC, category LIMIT 3)"),
        "catalogue_search": with_(EXPLODED, f"SELECT category, {slug('category')} AS category_slug, count(*) AS total_reviews FROM exploded WHERE regexp_matches(category, '(?i)SRC1[0-4]|^e') GROUP BY category"),
        "sentiment_distribution": with_(RATED, "SELECT sentiment, count(*) AS n, round(100 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 2) AS pct FROM rated GROUP BY sentiment"),
        "rating_sentiment_map": with_(RATED, "SELECT rating, sentiment, count(*) AS n FROM rated GROUP BY rating, sentiment"),
        "dataset_overview": "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM documents",
        "cleaning_funnel": with_(RATED, " UNION ALL ".join(funnel)),
        "text_stats": with_(f"{RATED}, done AS (SELECT text, {processed('text')} AS t FROM rated WHERE length(text) >= 10 AND sentiment <> 'Unknown')",
            "SELECT round(avg(length(text)), 6) AS avg_chars_raw, round(avg(length(array_to_string(t, ' '))), 6) AS avg_chars_processed, round(avg(len(t)), 6) AS avg_words FROM done WHERE len(t) > 0"),
        "category_explode": with_(EXPLODED, "SELECT review_id, category, rating FROM exploded"),
        "category_counts": with_(EXPLODED, "SELECT category, count(*) AS total_reviews FROM exploded GROUP BY category"),
        "category_rating_counts": with_(EXPLODED, f"SELECT c.category, r.rating, count(e.review_id) AS review_count, least(count(e.review_id), {REVIEWS_PER_RATING}) AS sampled "
            "FROM (SELECT DISTINCT category FROM exploded) c CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS r(rating) LEFT JOIN exploded e ON e.category = c.category AND e.rating = r.rating GROUP BY c.category, r.rating"),
        "category_totals": with_(EXPLODED, "SELECT category, rating, count(*) AS n FROM exploded GROUP BY category, rating UNION ALL SELECT category, NULL, count(*) FROM exploded GROUP BY category"),
        "distinct_categories": with_(EXPLODED, "SELECT DISTINCT category FROM exploded"),
        "top_categories": with_(EXPLODED, f"SELECT category, {slug('category')} AS category_slug, count(*) AS total_reviews FROM exploded GROUP BY category HAVING count(*) >= 20 ORDER BY count(*) DESC, category LIMIT 10"),
        "class_distribution": with_(f"{SCORED}, parts AS (SELECT 'train' AS part, sentiment, 1 AS k FROM train UNION ALL SELECT 'balanced', sentiment, copies FROM train "
            "UNION ALL SELECT 'test', sentiment, 1 FROM split WHERE split = 'test' UNION ALL SELECT 'predicted', sentiment, 1 FROM scored)",
            f"SELECT p.part, c.s AS sentiment, CAST(coalesce(sum(k) FILTER (WHERE sentiment = c.s), 0) AS BIGINT) AS n FROM parts p CROSS JOIN {CLASSES} AS c(s, code) GROUP BY p.part, c.s"),
        "mean_probabilities": with_(SCORED, "SELECT round(avg(prob_negative), 6) AS prob_negative, round(avg(prob_neutral), 6) AS prob_neutral, round(avg(prob_positive), 6) AS prob_positive FROM scored"),
        "neutral_diagnostics": with_(SCORED, "SELECT count(*) AS n_neutral, round(avg(prob_neutral), 6) AS avg_neutral, round(avg(prob_positive), 6) AS avg_positive FROM scored WHERE actual = 'Neutral'"),
        "worst_neutral": with_(SCORED, "SELECT review_id, sentiment AS predicted, prob_neutral, prob_positive FROM scored WHERE actual = 'Neutral' ORDER BY prob_neutral, review_id LIMIT 5"),
        "accuracy_by_model": with_(model_metrics(MODELS), "SELECT model, round(avg(accuracy), 6) AS avg_accuracy, round(max(accuracy), 6) AS max_accuracy FROM metrics GROUP BY model"),
        "accuracy_histogram": with_(model_metrics(MODELS), "SELECT CAST(CASE WHEN hi = lo THEN 5 ELSE least(floor(10 * (accuracy - lo) / (hi - lo)), 9) END AS INTEGER) AS bin, count(*) AS n "
            "FROM metrics, (SELECT min(accuracy) AS lo, max(accuracy) AS hi FROM metrics) GROUP BY bin"),
        "capped_sample": with_(RAW, f"SELECT review_id FROM raw ORDER BY {key()}, review_id LIMIT 300"),
        "group_sample": with_(EXPLODED, f"SELECT category, rating, review_id FROM (SELECT *, row_number() OVER (PARTITION BY category, rating ORDER BY {key()}, review_id) AS place FROM exploded) WHERE place <= 40"),
        "baseline_rows": with_(RAW, f"SELECT review_id FROM raw ORDER BY {key()}, review_id LIMIT {min(BASELINE_ROWS, SAMPLE_ROWS)}"),
        "stratified_split": with_(f"{LABELLED}, {split_of('labelled')}", "SELECT * FROM split"),
        "class_weights": with_(LABELLED, "SELECT sentiment, count(*) AS n, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight FROM labelled GROUP BY sentiment"),
        "boosted_weights": with_(f"{LABELLED}, w AS (SELECT sentiment, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS w FROM labelled GROUP BY sentiment)",
            "SELECT sentiment, round(CASE sentiment WHEN 'Neutral' THEN w * CAST(1.5 AS DOUBLE) ELSE w END, 6) AS boosted, round(CASE sentiment WHEN 'Neutral' THEN w * CAST(1.725 AS DOUBLE) ELSE w END, 6) AS reboosted FROM w"),
        "sample_weights": with_(LABELLED, "SELECT review_id, round(CAST(count(*) OVER () AS DOUBLE) / ((SELECT count(DISTINCT sentiment) FROM labelled) * count(*) OVER (PARTITION BY sentiment)), 6) AS weight FROM labelled"),
        "oversample": with_(TRAIN_IDS, "SELECT sentiment, count(*) AS n_before, CAST(CASE sentiment WHEN 'Neutral' THEN max(neg) ELSE count(*) END AS BIGINT) AS n_after FROM train GROUP BY sentiment"),
        "oversample_rows": with_(f"{TRAIN_IDS}, extra AS (SELECT unnest(range(neg - neu)) AS i, neu FROM (SELECT max(neg) AS neg, max(neu) AS neu FROM train))",
            "SELECT review_id, sentiment, CAST(0 AS BIGINT) AS copy_no FROM train UNION ALL SELECT review_id, sentiment, i // e.neu + 1 FROM extra e JOIN train t ON t.sentiment = 'Neutral' AND t.place = i % e.neu + 1"),
        "cross_folds": with_(LABELLED, f"SELECT review_id, sentiment, CAST(CASE WHEN place <= floor(n / CAST(3 AS DOUBLE)) THEN 0 WHEN place <= floor(n * CAST(2 AS DOUBLE) / 3) THEN 1 ELSE 2 END AS INTEGER) AS fold "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {key()}, review_id) AS place, count(*) OVER (PARTITION BY sentiment) AS n FROM labelled)"),
        "ngrams": with_(CORPUS, "SELECT review_id, term, tf FROM tf"),
        "vocabulary": with_(CORPUS, "SELECT term, idx, df, cf FROM vocab"),
        "first_features": with_(CORPUS, "SELECT term FROM vocab ORDER BY term LIMIT 20"),
        "count_vectors": with_(CORPUS, "SELECT review_id, term, tf FROM tf JOIN vocab USING (term)"),
        "tfidf_vectors": with_(f"{CORPUS}, {TFIDF}", "SELECT review_id, term, round(value, 6) AS weight FROM weights"),
        "sentence_terms": f"SELECT review_id, pos, array_to_string({word_terms('sentence')}, '|') AS terms FROM (SELECT doc_id AS review_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS sentence FROM (SELECT doc_id, {sentence_list('text')} AS l FROM documents))",
        "encoded_ids": with_(encode, f"SELECT s.review_id, s.split, concat_ws(' ', '{CLS_ID}', body, '{SEP_ID}') || repeat(' {PAD_ID}', CAST(n - len(t) - 2 AS INTEGER)) AS input_ids, "
            "CAST(len(t) + 2 AS INTEGER) AS n_real, CAST(n AS INTEGER) AS n_all FROM shown s JOIN longest USING (split) LEFT JOIN ids USING (review_id)"),
        "nb_model": with_(SCORED, "SELECT term, round(max(lp) FILTER (WHERE s = 'Negative'), 6) AS log_negative, round(max(lp) FILTER (WHERE s = 'Neutral'), 6) AS log_neutral, round(max(lp) FILTER (WHERE s = 'Positive'), 6) AS log_positive "
            "FROM (SELECT * FROM liken UNION ALL SELECT '', s, lp FROM prior) GROUP BY term"),
        "nb_predict": with_(SCORED, "SELECT * FROM scored"),
        "nb_predict_tfidf": with_(f"{CORPUS}, {TFIDF}, {bayes('TF-IDF')}", "SELECT * FROM scored"),
        "ml_naive_bayes": with_(f"{CORPUS}, {TFIDF}, {bayes('TF-IDF', smoothed=1.0)}", "SELECT review_id, actual, sentiment AS predicted FROM scored"),
        "nb_predict_boosted": with_(f"{CORPUS}, {bayes('Count', NEUTRAL_BOOST)}", "SELECT * FROM scored"),
        "summary_metrics": with_(f"{PREDICTED}, {measures('predictions')}", "SELECT round(accuracy, 6) AS accuracy, round(wp, 6) AS precision, round(wr, 6) AS recall, round(wf, 6) AS f1, round(mf, 6) AS f1_macro FROM overall"),
        "class_metrics": with_(f"{PREDICTED}, {measures('predictions')}", "SELECT sentiment, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rates"),
        "confusion_matrix": with_(PREDICTED, f"SELECT a.s AS actual, p.s AS predicted, count(x.review_id) AS n FROM {CLASSES} AS a(s, i) CROSS JOIN {CLASSES} AS p(s, i) LEFT JOIN predictions x ON x.actual = a.s AND x.predicted = p.s GROUP BY a.s, p.s"),
        "confusion_table": with_(PREDICTED, "SELECT a.s AS actual, " + ", ".join(f"count(*) FILTER (WHERE x.predicted = '{s}') AS \"{s}\"" for s in SENTIMENTS) +
            f" FROM {CLASSES} AS a(s, i) LEFT JOIN predictions x ON x.actual = a.s GROUP BY a.s"),
        "classification_report": with_(f"{PREDICTED}, {measures('predictions')}", "SELECT sentiment AS line, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rates "
            "UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n FROM overall UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), n FROM overall "
            "UNION ALL SELECT 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), n FROM overall"),
        "model_comparison": with_(model_metrics(MODELS), "SELECT vectorizer, model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, round(f1_macro, 4) AS f1_macro FROM metrics"),
        "best_model": with_(model_metrics(MODELS), "SELECT vectorizer, model, accuracy FROM metrics ORDER BY accuracy DESC, ordinal LIMIT 1"),
        "best_tfidf_model": with_(model_metrics(MODELS), "SELECT vectorizer, model, f1_macro FROM metrics WHERE vectorizer = 'TF-IDF' ORDER BY f1_macro DESC, ordinal LIMIT 1"),
        "combined_results": with_(tuned, "SELECT vectorizer, 'Naive Bayes' AS model, accuracy, precision, recall, f1, f1_macro, CASE model WHEN 'Naive Bayes' THEN 'Baseline' ELSE 'Tuned' END AS type FROM metrics"),
        "improvement": with_(f"{tuned}, pairs AS (SELECT a.vectorizer, a.model, a.accuracy AS baseline, b.accuracy AS tuned, round(b.accuracy - a.accuracy, 6) AS improvement FROM metrics a JOIN metrics b ON a.vectorizer = b.vectorizer WHERE a.model = 'Naive Bayes' AND b.model <> 'Naive Bayes')",
            f"SELECT *, round({div('improvement * 100', 'baseline')}, 4) AS improvement_pct, CASE WHEN improvement > 0.05 THEN 'significant' WHEN improvement > 0.02 THEN 'moderate' WHEN improvement > 0 THEN 'small' ELSE 'none' END AS band FROM pairs"),
        "scored_summary": with_(SCORED, f"SELECT c.s AS sentiment, count(x.review_id) AS n, round(100 * CAST(count(x.review_id) AS DOUBLE) / (SELECT count(*) FROM scored), 1) AS pct FROM {CLASSES} AS c(s, code) LEFT JOIN scored x ON x.sentiment = c.s GROUP BY c.s"),
        "external_scores": with_("shown AS (SELECT doc_id AS review_id, length(substr(text, 1, 1000)) % 7 AS k FROM documents)",
            "SELECT review_id, CASE k WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'LABEL_0' WHEN 2 THEN '3 stars' WHEN 3 THEN '5 stars' WHEN 4 THEN 'neutral' WHEN 5 THEN 'LABEL_1' ELSE 'NEUTRAL' END AS label, "
            "CASE k WHEN 6 THEN CAST(0.5 AS DOUBLE) ELSE CAST(k AS DOUBLE) / 8 END AS score, CASE WHEN k IN (1, 5) THEN 'Negative' WHEN k IN (2, 4, 6) THEN 'Neutral' ELSE 'Positive' END AS sentiment FROM shown"),
        "sentence_corpus": with_(f"{EXPLODED}, {corpus_of('exploded')}", "SELECT category, rating, count(*) AS n_sentences, CAST(sum(length(sentence)) AS BIGINT) AS n_chars FROM corpus GROUP BY category, rating"),
        "sentence_dedup": with_(LANGUAGE_SENTENCES, "SELECT category, rating, review_id, CAST(pos AS INTEGER) AS pos, sentence FROM sents"),
        "sentence_tfidf": with_(f"{LANGUAGE_SENTENCES}, {SENTENCE_TFIDF}", "SELECT category, rating, review_id, CAST(pos AS INTEGER) AS pos, term, round(weight, 6) AS weight FROM sweights"),
        "sentence_scores": with_(f"{LANGUAGE_SENTENCES}, {SENTENCE_SCORES}", "SELECT category, rating, review_id, CAST(pos AS INTEGER) AS pos, sentence, score FROM scores"),
        "extractive_summary": with_(f"{LANGUAGE_SENTENCES}, {SENTENCE_SCORES}, {SUMMARY}", "SELECT category, rating, summary FROM summaries"),
        "category_rating_summary": with_(summary_sql(), FLAT),
        "summary_uncapped": with_(summary_sql(top_n=5, cap=None), FLAT),
        "summary_one_category": with_(summary_sql(f"lower(category) = 'src7' OR {slug('category')} = 'src7'", None, 0), FLAT),
        "chunks": with_(packed(f"{NORMAL}, grouped AS (SELECT CASE WHEN review_id % 3 = 0 THEN 'third' ELSE 'rest' END AS category, rating, review_id, text FROM normal), {corpus_of('grouped')}"),
            "SELECT category, rating, chunk_no, md5(chunk) AS chunk_md5, length(chunk) AS n_chars FROM packed"),
        "two_level_summary": with_(two_level(), FLAT),
        "summary_job": with_(summary_sql(SRC, 5), "SELECT category, total_reviews, category_slug, CAST(count(*) AS INTEGER) AS n_ratings, "
            "string_agg(rating || ':' || review_count || ':' || sampled || ':' || md5(summary), ' ' ORDER BY rating) AS ratings FROM flat GROUP BY category, total_reviews, category_slug"),
        "two_level_extractive": with_(two_level_extractive(), FLAT),
    }
    return sql
