"""One query per corpus operator, with production parameters over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm.bpe import bpe_decode, bpe_encode, digests
from starlens.llm.common import small_batches
from starlens.llm.contamination import contaminated
from starlens.llm.fill_middle import fill_in_middle, restored
from starlens.llm.html_text import main_text
from starlens.llm.jaccard import near_duplicates
from starlens.llm.language import identify, page_evidence
from starlens.llm.negatives import hard_negatives
from starlens.llm.pii import KINDS, personal_data, written
from starlens.llm.quality import THRESHOLD, fit_quality, quality_scores
from starlens.llm.token_files import read_token_files, write_token_files
from starlens.llm.topk import exact_top_k
from starlens.llm.toxicity import fit_toxicity, toxic_passages
from starlens.llm.warc import BLOCKS, DATE, ENTITIES, NO_TEXT, derivatives, responses


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(os.path.join(folder, f"{name}.parquet"))


def remainder(key: str, by: int) -> Column:
    """The CRC-32 of the key as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(by))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_toxicity(docs, labels, use=remainder("doc_id", 5) != 0)
    scored = toxic_passages(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_passages").alias("n_passages"),
    )


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_quality(docs, labels, use=remainder("doc_id", 4) != 2)
    scored = quality_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op3_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("text_key")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe_encode(table(spark, folder, "documents").select("doc_id", "text"), vocabulary).drop("text")
    return digests(bpe_decode(coded, vocabulary))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("pii_base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(written("pii_base").cast("binary"), 256).alias("base_sha256"), written("pii_spans").alias("spans"),
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = write_token_files(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return read_token_files(files).select(
        "doc_id", "start", (F.length("token_ids") / 4).cast("long").alias("n_tokens"), F.crc32("token_ids").alias("ids_crc32")
    )


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    found = identify(table(spark, folder, "documents"), page_evidence(table(spark, folder, "pages")))
    return found.drop("text_hash")


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return derivatives(responses(table(spark, folder, "pages"))).drop("record")


def warc_sql() -> str:
    """The same records in DuckDB SQL."""
    e = lambda x: "'" + x.replace("'", "''") + "'"
    text = f"regexp_replace(html, '{NO_TEXT}', ' ', 'gis')"
    text = f"regexp_replace({text}, '</?(?:{BLOCKS})(?:\\s[^>]*)?/?>', chr(10), 'gi')"
    text = f"regexp_replace({text}, '<[A-Za-z/!?][^>]*>', '', 'g')"

    def decode(x: str) -> str:
        for name, value in ENTITIES:
            x = f"replace({x}, {e(name)}, {e(value)})"
        return x

    def tidy(x: str) -> str:
        x = f"regexp_replace({x}, '[ \\t\\r\\f\\v\u00a0]+', ' ', 'g')"
        x = f"regexp_replace({x}, ' ?\\n[ \\n]*', chr(10), 'g')"
        return f"regexp_replace({x}, '^[ \\n]+|[ \\n]+$', '', 'g')"

    urn = lambda x: f"'<urn:uuid:' || substr({x},1,8) || '-' || substr({x},9,4) || '-3' || substr({x},14,3) || '-8' || substr({x},18,3) || '-' || substr({x},21,12) || '>'"
    nl = "chr(13) || chr(10)"
    links = decode("x")
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || url) AS m,
  'HTTP/1.1 200 OK' || {nl} || 'Content-Type: text/html; charset=utf-8' || {nl} || 'Content-Length: ' || strlen(html) || {nl} || {nl} AS http_headers,
  {tidy(decode(text))} AS plain,
  replace({tidy(decode("regexp_extract(html, '<title(?:\\s[^>]*)?>(.*?)</title\\s*>', 1, 'is')"))}, chr(10), ' ') AS title,
  list_transform(regexp_extract_all(html, '<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1, 'i'), lambda x: {links}) AS links FROM p),
r AS (SELECT *, {urn('m')} AS refers_to, 'sha256:' || sha256(html) AS payload_digest, 'sha256:' || sha256(http_headers || html) AS response_digest FROM h),
i AS (SELECT *, md5('conversion|' || refers_to) AS mc, md5('metadata|' || refers_to) AS mm FROM r),
b AS (SELECT page_id, refers_to, url, payload_digest, 'metadata' AS kind, {urn('mm')} AS record_id, 'application/json' AS content_type,
  CAST(to_json({{response: refers_to, conversion: {urn('mc')}, uri: url, http_headers: http_headers, payload_digest: payload_digest, block_digest: response_digest,
    payload_length: strlen(html), title: title, n_links: len(links), links: links, text_digest: 'sha256:' || sha256(plain), text_length: length(plain)}}) AS VARCHAR) AS block FROM i
  UNION ALL SELECT page_id, refers_to, url, payload_digest, 'conversion', {urn('mc')}, 'text/plain', plain FROM i),
d AS (SELECT *, 'sha256:' || sha256(block) AS block_digest FROM b)
SELECT page_id, kind, record_id, refers_to, url AS target_uri, '{DATE}' AS date, content_type, block, block_digest, payload_digest,
  'WARC/1.1' || {nl} || 'WARC-Type: ' || kind || {nl} || 'WARC-Record-ID: ' || record_id || {nl} || 'WARC-Date: {DATE}' || {nl} || 'WARC-Target-URI: ' || url
  || {nl} || 'WARC-Refers-To: ' || refers_to || {nl} || 'WARC-Block-Digest: ' || block_digest || {nl} || 'Content-Type: ' || content_type
  || {nl} || 'Content-Length: ' || strlen(block) || {nl} || {nl} AS header FROM d
"""


def op9_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


TOP_K_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 20
"""

def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The blocks of the article element; enough for pages that mark it and put nothing else into it, as the given ones do.
MAIN_TEXT_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(coalesce(html, ''), '<!--.*?-->', '', 'gs'), '<(script|style)[ >].*?</(script|style)>', '', 'gs') AS page FROM pages),
b AS (SELECT page_id, url, unnest(string_split_regex(regexp_extract(page, '<article>(.*?)</article>', 1, 's'), '</?(?:h1|p)>')) AS block,
  generate_subscripts(string_split_regex(regexp_extract(page, '<article>(.*?)</article>', 1, 's'), '</?(?:h1|p)>'), 1) AS i FROM a),
c AS (SELECT page_id, url, i, regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM b),
d AS (SELECT page_id, url, i, trim(regexp_replace(replace(regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', chr(1), 'g'), chr(1), '&'), '\s+', ' ', 'g')) AS x FROM c),
e AS (SELECT page_id, url, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (x <> ''), '') AS text FROM d GROUP BY page_id, url)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM e
"""


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    whole = F.col("form") != "plain"
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", F.when(whole, F.col("prefix_chars")).alias("prefix_chars"), F.when(whole, F.col("middle_chars")).alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


FILL_IN_MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, length(text) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || substring(text, 1, a) || '<S>' || substring(text, b + 1) || '<M>' || substring(text, a + 1, b - a)
  ELSE '<S>' || substring(text, b + 1) || '<P>' || substring(text, 1, a) || '<M>' || substring(text, a + 1, b - a) END AS output FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""

def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


HARD_NEGATIVES_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, e) = 1),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_jaccard": op3_jaccard,
    "op4_bpe": op4_bpe,
    "op5_pii": op5_pii,
    "op6_token_files": op6_token_files,
    "op7_language": op7_language,
    "op8_warc": op8_warc,
    "op9_contamination": op9_contamination,
    "op10_top_k": op10_top_k,
    "op11_main_text": op11_main_text,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op8_warc": warc_sql(),
    "op10_top_k": TOP_K_SQL,
    "op11_main_text": MAIN_TEXT_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
