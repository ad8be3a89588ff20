"""Language of documents by Bayesian fusion of text, markup, address and host.

The text gives likelihoods over hashed byte trigrams, learned from the whole labelled corpus. Declared markup
language and address suffix give likelihoods, and the host a prior that is smoothed towards its domain and that towards
the corpus; these come from grouped counts over the languages that the texts alone suggest. A uniform trigram
model stands for text in no known language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, per_slice, sized
from starlens.llm.words import folded, slices, text_bytes
from starlens.session import stage

BUCKETS = 1 << 16
#: Pseudo-count of each trigram bucket, and of the wider level in a narrower one's prior.
TRIGRAM_PRIOR, LEVEL_PRIOR = 0.1, 20.0
#: Each byte is part of three trigrams, so their log-likelihoods count a third.
OVERLAP = 3.0
#: Prior odds of text in no known language.
OTHER = 1e-6
#: A document is kept if its most likely language has at least this probability.
LEAST = 0.5


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts and the row of each; signs and digits count as spaces, spaces alone are left out."""
    data, offsets = text_bytes(texts)
    low, inside = folded(data)
    letters = np.where(inside & ~((low >= 48) & (low <= 57)), low, 32).astype(np.uint32)
    if len(letters) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    use = (rows[:-2] == rows[2:]) & ((letters[:-2] != 32).astype(np.int8) + (letters[1:-1] != 32) + (letters[2:] != 32) >= 2)
    return bucket[use], rows[:-2][use]


def fit_trigrams(docs: DataFrame, label: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """The labels and their log-probabilities by bucket, with the uniform model in the last column; counts cover all labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for low, high in slices(batch[text]):
                part = batch.slice(low, high - low)
                bucket, rows = trigrams(part[text])
                codes = part["label"].dictionary_encode()
                names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                for k, name in enumerate(names):
                    sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    sums[name] += np.bincount(bucket[code[rows] == k], minlength=BUCKETS)
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["label", "bucket", "n"])

    labelled = known(docs, text).where(F.col(label).isNotNull()).select(text, F.col(label).alias("label"))
    table = labelled.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(table["label"].unique())
    n = np.zeros((BUCKETS, len(names)))
    n[table["bucket"].to_numpy(), table["label"].map({x: i for i, x in enumerate(names)}).to_numpy(dtype=np.int64)] = table["n"].to_numpy()
    n += TRIGRAM_PRIOR
    return names, np.column_stack([np.log(n / n.sum(axis=0)), np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32)


def text_likelihoods(docs: DataFrame, names: list[str], logs: np.ndarray, text: str = "text") -> DataFrame:
    """All columns but the text, with ``likelihoods``: a log-likelihood per language and, last, of no known one; null without letters."""
    sent = docs.sparkSession.sparkContext.broadcast(logs)
    kept = docs.drop("likelihoods")
    columns = [c for c in kept.columns if c != text]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, rows = trigrams(batch[text])
        n = batch.num_rows
        first = np.searchsorted(rows, np.arange(n + 1))
        values = np.zeros((n, sent.value.shape[1]))
        for k in range(values.shape[1]):
            sums = np.concatenate([[0.0], np.cumsum(sent.value[:, k][bucket], dtype=np.float64)])
            values[:, k] = (sums[first[1:]] - sums[first[:-1]]) / OVERLAP
        listed = [x if some else None for x, some in zip(values.tolist(), (np.diff(first) > 0).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(listed, pa.list_(pa.float64()))], names=[*columns, "likelihoods"])

    schema = ", ".join([*(kept.select(c).schema.toDDL() for c in columns), "likelihoods array<double>"])
    return known(kept, text).mapInArrow(per_slice(slices, run, text), schema)


def best(values: str | Column) -> Column:
    """The place of the largest value, from 0; the first of equals."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def add(*lists: Column) -> Column:
    out = lists[0]
    for x in lists[1:]:
        out = F.zip_with(out, x, lambda a, b: a + b)
    return out


def level(rows: DataFrame, *keys: str, size: int) -> DataFrame:
    """(keys, counts): the documents of each language, as the texts suggest it, by host or domain."""
    counts = F.array(*(F.sum((F.col("guess") == k).cast("long")).cast("double") for k in range(size)))
    return rows.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(counts.alias("counts"))


def smoothed(counts: Column, wider: Column) -> Column:
    """Shares out of counts, with the shares of the wider level as prior."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, wider, lambda n, p: (n + LEVEL_PRIOR * p) / (total + LEVEL_PRIOR))


def likelihood_table(rows: DataFrame, key: str, totals: list[float]) -> DataFrame:
    """(key, logs): ln P(key | language) per language, smoothed by the key's share; the last entry is ln P(key)."""
    size, n = len(totals), sum(totals)
    counts = [F.sum((F.col("guess") == k).cast("long")).cast("double") for k in range(size)]
    share = F.count(F.lit(1)) / F.lit(max(n, 1.0))
    logs = [F.log((c + LEVEL_PRIOR * share) / F.lit(t + LEVEL_PRIOR)) for c, t in zip(counts, totals, strict=True)]
    return rows.where(F.col(key).isNotNull() & F.col("guess").isNotNull()).groupBy(key).agg(F.array(*logs, F.log(share)).alias(f"{key}_logs"))


def identify(docs: DataFrame, evidence: DataFrame | None = None, key: str = "doc_id", text: str = "text", label: str = "lang", host: str = "source", names_logs: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """One row per document: key, text_hash, language, probability, text_language, kept.

    ``evidence`` has (key, declared, url_host) of some documents, one row each; where it names no host, the column ``host``
    counts as one. Nulls and unknown values are no evidence. A text without letters has only the other evidence; without any, or if no language
    reaches ``LEAST``, the language is null and ``kept`` false. Ties go to the first language by name. Repeated rows get equal results.
    ``text_hash`` is xxhash64 of the text, so that (key, text_hash) tells apart documents of one key.
    """
    names, logs = names_logs or fit_trigrams(docs, label, text)
    size = len(names)
    slim = known(docs, text).select(F.col(key).alias("k"), F.col(host).alias("own_host") if host in docs.columns else F.lit(None).cast("string").alias("own_host"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))
    rows = text_likelihoods(slim, names, logs, "t")
    guess = F.when(best(F.slice("likelihoods", 1, size)) >= 0, best(F.slice("likelihoods", 1, size))) if size else F.lit(None).cast("int")
    rows = rows.withColumn("guess", guess)
    if evidence is not None:
        more = evidence.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(F.struct("declared", "url_host")).alias("e")).select("k", "e.declared", "e.url_host")
        rows = rows.join(more, "k", "left")
    else:
        rows = rows.withColumns({"declared": F.lit(None).cast("string"), "url_host": F.lit(None).cast("string")})
    declared = F.lower(F.regexp_extract("declared", "^\\s*([A-Za-z]+)", 1))
    parts = F.split("url_host", "\\.")
    rows = rows.withColumns({
        "declared": F.when(declared != "", declared),
        "suffix": F.when(F.size(parts) > 1, F.element_at(parts, -1)),
        "host": F.coalesce("url_host", F.concat(F.lit("own:"), "own_host")),
        "domain": F.coalesce(F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."), F.concat(F.lit("own:"), "own_host")),
    }).drop("own_host", "url_host")
    rows = stage(rows, "language-rows")
    count = rows.groupBy("guess").count().where("guess is not null").collect()
    totals = [0.0] * size
    for x in count:
        totals[x["guess"]] = float(x["count"])
    n = sum(totals)
    overall = F.array(*(F.lit((t + 1) / (n + size)) for t in totals))
    seen = rows.where(F.col("guess").isNotNull())
    domains = level(seen, "domain", size=size).select("domain", smoothed(F.col("counts"), overall).alias("wider"))
    own = smoothed(F.col("counts"), F.col("wider"))
    hosts = level(seen, "host", "domain", size=size).join(domains, "domain").select("host", "domain", F.transform(own, lambda p: F.log(p)).alias("host_logs"))
    hosts = stage(hosts, "language-hosts")
    out = rows.join(sized(hosts), ["host", "domain"], "left")
    for evidence_key in ("declared", "suffix"):
        out = out.join(sized(stage(likelihood_table(seen, evidence_key, totals), f"language-{evidence_key}")), evidence_key, "left")
    none = F.array(*(F.lit(0.0) for _ in range(size + 1)))
    prior = F.concat(F.coalesce("host_logs", F.transform(overall, lambda p: F.log(p))), F.array(F.lit(float(np.log(OTHER)))))
    score = add(prior, F.coalesce("likelihoods", none), F.coalesce("declared_logs", none), F.coalesce("suffix_logs", none))
    any_evidence = F.col("likelihoods").isNotNull() | F.col("declared_logs").isNotNull() | F.col("suffix_logs").isNotNull()
    out = out.withColumn("score", score).withColumn("place", best("score"))
    weight = F.aggregate(F.transform("score", lambda x: F.exp(x - F.array_max("score"))), F.lit(0.0), lambda a, x: a + x)
    listed = F.array(*(F.lit(x) for x in names)) if names else F.array().cast("array<string>")
    probability = 1 / weight
    kept = any_evidence & (F.col("place") < size) & (probability >= LEAST)
    return out.select(
        F.col("k").alias(key), "text_hash", F.when(kept, F.get(listed, F.col("place"))).alias("language"), F.when(any_evidence, probability).otherwise(0.0).alias("probability"),
        F.get(listed, F.col("guess")).alias("text_language"), kept.alias("kept"),
    )


def page_evidence(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, declared, url_host) out of web pages whose address names the document: .../<language>/<number>."""
    number = F.regexp_extract("url", r"^[a-z]+://[^/]+/[^/]+/([0-9]{1,18})(?:[^0-9].*)?$", 1)
    rows = pages.select(
        F.when(number != "", number).cast("long").alias(key), "page_id",
        F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
        F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)).alias("url_host"),
    )
    one = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("page_id", "declared", "url_host")).alias("e"))
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    return one.select(key, "e.declared", "e.url_host").select(key, blank("declared").alias("declared"), blank("url_host").alias("url_host"))
