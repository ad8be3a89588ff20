"""Derivative archive records: metadata and plain-text conversions of web responses.

``responses`` makes response records out of pages; ``derivatives`` gives for each of them a metadata record (source
headers, title, links, digests as JSON) and a conversion record (plain text), both with the identifier of the response in
WARC-Refers-To, its target address, its date and the digests. All of it is SQL functions. ``write_archives`` puts records in files, one gzip
member each, that any reader of the format takes.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.functions.text import let
from starlens.llm.token_files import file_system
from starlens.session import stage, staging_path

#: Elements whose content is no text, those that end a line, and the entities that the SQL decodes; all others that HTML names are decoded too.
HIDDEN = ["script", "style", "noscript", "template", "svg", "head"]
NO_TEXT = "|".join(["<!--.*?-->", *(rf"<{x}(?:\s[^>]*)?>.*?</{x}\s*>" for x in HIDDEN)])
# The same with the sign in front of all alternatives, so that the search leaps from one to the next.
HIDDEN_PARTS = rf"(?is)<(?:!--.*?-->|({'|'.join(HIDDEN)})(?:\s[^>]*)?>.*?</\1\s*>)"
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
ENTITIES = [("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]
NAMES = dict(html5)
COMMON_NAMES = {f"{x};": NAMES[f"{x};"] for x in ("amp", "nbsp", "quot", "lt", "gt", "copy", "middot", "apos")}
SHORT = "|".join(sorted((x for x in NAMES if not x.endswith(";")), key=len, reverse=True))
REFERENCE = rf"^(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{SHORT}))"
NO_MORE = "(?:(?<=;)|(?![=A-Za-z0-9]))"
DATE = "1970-01-01T00:00:00Z"
EOL = "\r\n"


def plain_text(html: str | Column) -> Column:
    """The text of a page: without hidden elements, comments and tags; blocks start lines; white space is reduced."""
    x = F.regexp_replace(html, HIDDEN_PARTS, " ")
    x = F.regexp_replace(x, rf"(?i)</?(?:{BLOCKS})(?:\s[^>]*)?/?>", "\n")
    x = F.regexp_replace(x, r"<[A-Za-z/!?][^>]*>", "")
    return tidy(decoded(x))


def decoded(x: Column, attribute: bool = False) -> Column:
    """Character references by number and by name, each read once; in an attribute a name without semicolon must not go on with = or a letter or digit."""
    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda part: after_sign(part, attribute))
        return F.concat(parts[0], F.array_join(rest, ""))

    return let(x, lambda text: F.when(F.contains(text, F.lit("&")), let(F.split(text, "&"), joined)).otherwise(text))


def character(code: Column) -> Column:
    """The character of a number; numbers of none give U+FFFD, and 128 to 159 those of Windows-1252, as in HTML."""
    windows = F.array(*(F.lit(bytes([x]).decode("cp1252", "ignore") or chr(x)) for x in range(128, 160)))
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(bad, F.lit("\ufffd")).when(code.between(128, 159), F.get(windows, (code - 128).cast("int"))).otherwise(plain)


def after_sign(part: Column, attribute: bool) -> Column:
    """What stands for an ampersand and the text behind it, which has no other one."""
    table = F.create_map(*(F.lit(v) for pair in NAMES.items() for v in pair))

    def number(found: Column) -> Column:
        name = F.rtrim(F.lower(found), F.lit(";"))
        digits = F.regexp_replace(name, "^#x?0*(?=.)", "")
        code = F.when(F.length(digits) > 7, F.lit(0x110000)).when(name.startswith("#x"), F.conv(digits, 16, 10).cast("long")).otherwise(digits.cast("long"))
        return let(code, character)

    def value(found: Column) -> Column:
        sign = F.when(found == "", F.lit("&"))
        for known, common in COMMON_NAMES.items():
            sign = sign.when(found == known, F.lit(common))
        sign = sign.when(found.startswith("#"), number(found)).otherwise(F.coalesce(F.try_element_at(table, found), F.concat(F.lit("&"), found)))
        return F.concat(sign, F.substr(part, F.length(found) + 1))

    return let(F.regexp_extract(part, REFERENCE + (NO_MORE if attribute else ""), 0), value)


def tidy(x: Column) -> Column:
    """White space reduced to single spaces and line feeds; the patterns leave single spaces between words alone, which are most of it."""
    x = F.regexp_replace(x, "[\\t\\r\\f\\x0b\\xa0][ \\t\\r\\f\\x0b\\xa0]*+| [ \\t\\r\\f\\x0b\\xa0]++", " ")
    x = F.regexp_replace(x, r" \n[ \n]*+|\n[ \n]++", "\n")
    return F.btrim(x, F.lit(" \n"))


def title(html: str | Column) -> Column:
    return F.regexp_replace(tidy(decoded(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>", 1))), "\n", " ")


def links(html: str | Column) -> Column:
    """The targets of all links, in order, repeated ones too."""
    value = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>=`][^\s>]*)"""), 1)
    return F.transform(value, lambda x: decoded(F.when(x.rlike("^[\"']"), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x), attribute=True))


def identifier(*parts: str | Column) -> Column:
    """A urn:uuid out of the MD5 of the parts, of version 3 in form."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def digest(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(x.cast("binary"), 256))


def size(x: Column) -> Column:
    return F.octet_length(x).cast("long")


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """(key, record_id, target_uri, date, http_headers, payload, payload_digest, block_digest, ip_address null) of each page.

    A null address or page counts as empty. Repeated rows make equal records.
    """
    page = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("target_uri"), F.coalesce(F.col(html), F.lit("")).alias("payload"))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), size(F.col("payload")).cast("string"), F.lit(f"{EOL}{EOL}"))
    return page.select(
        "page_id", identifier(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri").alias("record_id"), "target_uri", F.lit(date).alias("date"),
        headers.alias("http_headers"), "payload", digest(F.col("payload")).alias("payload_digest"), digest(F.concat(headers, F.col("payload"))).alias("block_digest"),
    )


def derivatives(answers: DataFrame) -> DataFrame:
    """Two rows per response: (page_id, kind, record_id, refers_to, target_uri, date, content_type, block, block_digest, header, record).

    ``record`` is the whole record, ``header`` its named fields; the conversion's block is the plain text, the metadata's a
    JSON object that links the conversion and keeps the response's own headers and digests. A page without text has an empty conversion.
    Records are told apart by the response's identifier; rows of one identifier give equal records.
    """
    text = plain_text("payload")
    conversion_id, metadata_id = identifier(F.lit("conversion"), "record_id"), identifier(F.lit("metadata"), "record_id")
    rows = answers.select("page_id", "record_id", "target_uri", "date", "http_headers", "payload_digest", "block_digest", text.alias("plain"), title("payload").alias("title"), links("payload").alias("links"), size(F.col("payload")).alias("payload_length"))
    about = F.to_json(F.struct(
        F.col("record_id").alias("response"), conversion_id.alias("conversion"), F.col("target_uri").alias("uri"), F.col("http_headers").alias("http_headers"), F.col("payload_digest"), F.col("block_digest"),
        F.col("payload_length"), F.col("title"), F.size("links").alias("n_links"), F.col("links"), digest(F.col("plain")).alias("text_digest"), F.length("plain").alias("text_length"),
    ))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("kind"), metadata_id.alias("id"), F.lit("application/json").alias("content_type"), about.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), conversion_id.alias("id"), F.lit("text/plain").alias("content_type"), F.col("plain").alias("block")),
    )
    out = rows.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", F.explode(kinds).alias("r")).select("page_id", "r.kind", F.col("r.id").alias("record_id"), "refers_to", "target_uri", "date", "r.content_type", "r.block", digest(F.col("r.block")).alias("block_digest"), "payload_digest")
    header = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "), "kind", F.lit(f"{EOL}WARC-Record-ID: "), "record_id", F.lit(f"{EOL}WARC-Date: "), "date", F.lit(f"{EOL}WARC-Target-URI: "), "target_uri",
        F.lit(f"{EOL}WARC-Refers-To: "), "refers_to", F.lit(f"{EOL}WARC-Block-Digest: "), "block_digest", F.lit(f"{EOL}Content-Type: "), "content_type", F.lit(f"{EOL}Content-Length: "), size(F.col("block")).cast("string"), F.lit(f"{EOL}{EOL}"),
    )
    return out.withColumn("header", header).withColumn("record", F.concat("header", "block", F.lit(EOL + EOL)))


def write_archives(records: DataFrame, folder: str | None = None, record: str = "record") -> DataFrame:
    """Write the records to .warc.gz files, one gzip member each; returns the staged list (part, file, records, bytes).

    Each task writes one file under a new name, and only files of tasks that ended well are listed.
    """
    spark = records.sparkSession
    folder = folder or staging_path(spark, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        out, n, total = None, 0, 0
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            for value in batch[record].to_pylist():
                if value is None:
                    continue
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip.compress(value.encode(), mtime=0)
                out.write(member)
                n, total = n + 1, total + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["part", "file", "records", "bytes"])

    return stage(records.select(record).mapInArrow(run, "part int, file string, records long, bytes long"), "archive-list")
