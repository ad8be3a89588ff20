"""CSV input and output."""

from __future__ import annotations

import csv
import io
from collections import Counter, defaultdict
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.sources.reviews import union_sources

OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
# The writer keeps blanks around values, as the reader does.
WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def csv_reader(spark: SparkSession, encoding: str = "UTF-8"):
    return spark.read.options(**OPTIONS).option("encoding", encoding)


def column_names(header: str) -> list[str]:
    """The names in a header line as the reader gives them: blank ones by place, repeated ones with their place."""
    names = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"))), [])
    often = Counter(name.lower() for name in names)
    return [f"_c{i}" if not name else f"{name}{i}" if often[name.lower()] > 1 else name for i, name in enumerate(names)]


def layouts(spark: SparkSession, path: str) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """Files by encoding and column list, out of one distributed pass over their lines.

    A file is UTF-8 if all its lines are, else Latin-1, and its header is read in that encoding. The driver gets one
    short row per file. Column names must not hold line breaks. Files without a line are left out.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        .withColumn("place", F.monotonically_increasing_id())
    )
    first = F.min(F.when(F.col("start") == 0, F.struct("place", F.col("value").cast("binary").alias("header"))))
    found = lines.groupBy("file").agg(F.every(F.is_valid_utf8("value")).alias("utf8"), first.alias("first"))
    groups = defaultdict(list)
    for row in found.select("file", "utf8", F.col("first.header").alias("header")).toLocalIterator():
        encoding = "UTF-8" if row.utf8 else "ISO-8859-1"
        groups[encoding, tuple(column_names(bytes(row.header or b"").decode(encoding)))].append(row.file)
    return {key: sorted(files) for key, files in sorted(groups.items())}


def read_reviews(spark: SparkSession, path: str, sample_rows: int | None = None, multi_line: bool = True) -> DataFrame:
    """All CSV files of ``path`` as one table of strings, with ``__source_file``.

    Files may differ in columns (matched by name) and in encoding (UTF-8, else
    Latin-1). ``sample_rows`` keeps the first rows of each file, for debugging.
    Without ``multi_line`` values hold no line breaks, and large files are split.
    """
    groups = layouts(spark, path)
    if not groups:
        raise FileNotFoundError(f"nothing to read: {path} has no file that ends in .csv")
    frames = []
    for (encoding, columns), members in groups.items():
        schema = ", ".join(f"`{c}` string" for c in columns)
        # Row order only means something within one file, so a sample reads file by file.
        for batch in [[f] for f in members] if sample_rows else [members]:
            frame = csv_reader(spark, encoding).option("multiLine", str(multi_line).lower()).schema(schema).csv(batch)
            frame = frame.withColumn("__source_file", F.col("_metadata.file_path"))
            frames.append(frame.limit(sample_rows) if sample_rows else frame)
    return union_sources(frames)


def read_scoring_batch(spark: SparkSession, path: str) -> DataFrame:
    """A CSV to be scored, with columns of any name."""
    return csv_reader(spark).csv(path)


def write_scored(scored: DataFrame, folder: str, now: datetime | None = None) -> str:
    """Write a scored batch as CSV under a time-stamped name; returns the path."""
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    path = f"{folder}/sentiment_analysis_results_{stamp}"  # fixed value: the name that readers of results look for
    scored.write.options(**WRITE_OPTIONS).csv(path)
    return path
