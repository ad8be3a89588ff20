"""Personal data: patterns of four kinds, and identifiers found by bootstrapped contexts.

The base patterns find emails, addresses, cards and phone numbers; they are the seeds. The words around a seed
induce lexical patterns; a graph of patterns and instances (the identifier-like strings that stand in them) is scored in rounds: a pattern is as
good as the share of known instances in all its places in the corpus, an instance is as good as the patterns that hold it, taken
as independent. Instances above ``ACCEPT`` induce patterns in the next round as seeds do; those that end above it are added; base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.llm.common import known, per_slice, sized
from starlens.llm.words import BASE, mix, slices, words_of
from starlens.session import stage

#: The kinds in their order, and the patterns of the last three.
KINDS = ["email", "ip", "card", "phone"]
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
GROUPS = re.compile(r"(?<![0-9])[0-9]++(?:[ -][0-9]++)+")
#: Digits of groups with spaces between them, at most; more are a row of numbers. Single runs have no such bound.
JOINED = 34
#: Different seeds or accepted identifiers that a pattern needs, rounds of scoring, and the least score of a good pattern and of a new identifier.
SUPPORT, ROUNDS, GOOD, ACCEPT = 3, 3, 0.5, 0.6
#: Patterns whose places are counted in one pass over the corpus; more take more passes.
PATTERN_BLOCK = 500_000
SPAN = "array<struct<kind:int,start:long,stop:long>>"
SLOT = "array<struct<kind:int,start:long,stop:long,instance:string,patterns:array<long>>>"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot, in linear time: one look around each @."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    total = sum(int(x) for x in digits[-1::-2]) + sum(2 * int(x) - 9 * (x > "4") for x in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the four kinds in code points, by start and kind; matches that fail their test are dropped."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if MARK.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split(".") if len(x.lstrip("0")) <= 3) and all(len(x.lstrip("0")) <= 3 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start():
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15]
    return sorted(out)


def joined_groups(text: str, edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Groups of digits joined by single spaces, or spaces and hyphens, outside of the spans; runs at their ends that hold letters are left off."""
    out, k = [], 0
    for m in GROUPS.finditer(text):
        a, b = m.span()
        left, right = a, b
        while left and not text[left - 1].isspace() and not text[left - 1].isalnum():
            left -= 1
        while right < len(text) and not text[right].isspace() and not text[right].isalnum():
            right += 1
        if left and not text[left - 1].isspace():
            a = text.find(" ", a, b) + 1 or b
        if right < len(text) and not text[right].isspace():
            b = text.rfind(" ", a, b)
        if b <= a or text.find(" ", a, b) < 0:
            continue
        while k < len(edges) and edges[k][1] <= a:
            k += 1
        if (k >= len(edges) or edges[k][0] >= b) and b - a >= 5 and 3 <= sum(c not in " -" for c in text[a:b]) <= JOINED:
            out.append((a, b))
    return out


def other_slots(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like strings outside of the spans: runs without white space, trimmed of signs, with three digits or an @; then joined groups of digits.

    The runs inside of joined groups stay slots of their own.
    """
    out, end, at = [], 0, 0
    edges = sorted((a, b) for a, _, b in taken)
    k = 0
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        stop = SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        while k < len(edges) and edges[k][1] <= start:
            k += 1
        if k < len(edges) and edges[k][0] < end:
            continue
        a, b = start, end
        while a < b and not text[a].isalnum():
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        value = text[a:b]
        if len(value) >= 5 and ("@" in value or sum(c.isdigit() for c in value) >= 3):
            out.append((a, b))
    return out + joined_groups(text, edges)


def pattern_hashes(before2: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place: the pattern of the two words before it, and of the words on both sides."""
    left = mix(before2 * np.uint64(BASE) + before * np.uint64(3))
    around = mix(before * np.uint64(BASE) + after * np.uint64(5) + np.uint64(1))
    return left.view(np.int64), around.view(np.int64)


def slot_rows(texts: pa.Array) -> tuple[list, list]:
    """Base spans of each text, and its slots: base spans and other identifier-like strings with their patterns."""
    words = words_of(texts)
    spans, slots = [], []
    for row, text in enumerate(texts.to_pylist()):
        text = text or ""
        base = base_spans(text)
        spans.append([{"kind": k, "start": a, "stop": b} for a, k, b in base])
        mine = [*((a, b, k) for a, k, b in base), *((a, b, -1) for a, b in other_slots(text, base))] if MARK.search(text) else []
        first, last = int(words.first[row]), int(words.first[row + 1])
        begin, end = words.begin[first:last] - words.offsets[row], words.end[first:last] - words.offsets[row]
        listed = []
        for a, b, k in mine:
            low, high = (a, b) if text.isascii() else (len(text[:a].encode()), len(text[:b].encode()))
            left, right = int(np.searchsorted(end, low, side="right")), int(np.searchsorted(begin, high))
            patterns = []
            if left >= 2:
                patterns.append(int(pattern_hashes(words.hashes[first + left - 2 : first + left - 1], words.hashes[first + left - 1 : first + left], words.hashes[:1])[0][0]))
            if left >= 1 and right < last - first:
                patterns.append(int(pattern_hashes(words.hashes[:1], words.hashes[first + left - 1 : first + left], words.hashes[first + right : first + right + 1])[1][0]))
            listed.append({"kind": k, "start": a, "stop": b, "instance": text[a:b].lower(), "patterns": patterns})
        slots.append(listed)
    return spans, slots


def scanned(docs: DataFrame, text: str) -> DataFrame:
    """The documents with a row number, their base spans and slots, staged."""
    rows = known(docs.drop("pii_row", "pii_base", "pii_slots"), text).withColumn("pii_row", F.monotonically_increasing_id())
    names = rows.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, slots = slot_rows(batch[text])
        span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
        slot = pa.struct([*span, ("instance", pa.string()), ("patterns", pa.list_(pa.int64()))])
        return pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(spans, pa.list_(span)), pa.array(slots, pa.list_(slot))], names=[*names, "pii_base", "pii_slots"])

    return rows.mapInArrow(per_slice(slices, run, text), f"{rows.schema.toDDL()}, pii_base {SPAN}, pii_slots {SLOT}")


def ordinary_places(docs: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """(pattern, n_other): how often each pattern stands around an ordinary word, in the whole corpus.

    The patterns go to the executors in blocks of a bounded size, each block with one pass.
    """
    spark = docs.sparkSession
    blocks = max(1, -(-patterns.count() // PATTERN_BLOCK))
    parts = []
    for block in range(blocks):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block).toArrow()["pattern"].to_numpy()
        sent = spark.sparkContext.broadcast(np.sort(mine))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            wanted = sent.value
            total = np.zeros(len(wanted), np.int64)
            for batch in batches:
                for low, high in slices(batch[text]):
                    words = words_of(batch[text].slice(low, high - low))
                    if len(words.hashes) < 3:
                        continue
                    rows, h = words.rows, words.hashes
                    left, around = pattern_hashes(h[:-2], h[1:-1], h[2:])
                    for keys, inside in ((left, rows[:-2] == rows[2:]), (pattern_hashes(h[:-2], h[:-2], h[2:])[1], rows[:-2] == rows[2:])):
                        at = np.minimum(np.searchsorted(wanted, keys), max(len(wanted) - 1, 0))
                        if len(wanted):
                            total += np.bincount(at[(wanted[at] == keys) & inside], minlength=len(wanted))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(total[some])], names=["pattern", "n"])

        parts.append(known(docs, text).select(text).mapInArrow(run, "pattern long, n long"))
    return reduce(DataFrame.union, parts).groupBy("pattern").agg(F.sum("n").alias("n_other"))


def bootstrapped(slots: DataFrame, docs: DataFrame, text: str, support: int = SUPPORT, rounds: int = ROUNDS) -> DataFrame:
    """(instance, kind, score) of identifiers that only their contexts give away.

    Each round chooses the patterns anew: those of ``support`` seeds or identifiers accepted so far. Places of a pattern are counted once.
    """
    edges = slots.select("instance", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    # a pattern of fewer instances can never be chosen
    held = stage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support), "pii-patterns")
    edges = stage(edges.join(sized(held.select("pattern")), "pattern"), "pii-edges")
    members = edges.select("pattern", "instance")
    seeds = edges.where("kind >= 0").groupBy("instance").agg(F.max("kind").alias("kind")).withColumns({"score": F.lit(1.0), "seed": F.lit(True)})
    scores = stage(seeds, "pii-scores")
    seeds = scores
    size = None
    for _ in range(rounds):
        sure = scores.where(F.col("seed") | (F.col("score") >= ACCEPT)).select("instance")
        fit = stage(members.join(sure, "instance").groupBy("pattern").agg(F.count(F.lit(1)).alias("sure")).where(F.col("sure") >= support).select("pattern"), "pii-fit")
        fresh = fit if size is None else stage(fit.join(size, "pattern", "left_anti"), "pii-fresh")
        if size is None or not fresh.isEmpty():
            more = held.join(sized(fresh), "pattern").join(ordinary_places(docs, text, fresh), "pattern", "left")
            more = stage(more.select("pattern", (F.col("n") + F.coalesce("n_other", F.lit(0)) + 1).alias("size")), "pii-pattern-sizes")
            size = more if size is None else size.unionByName(more)
        good = (
            members.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
            .join(size, "pattern").join(fit, "pattern", "left_semi").select("pattern", "kind", (F.col("mass") / F.col("size")).alias("trust")).where(F.col("trust") >= GOOD)
        )
        found = (
            members.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("trust"), F.lit(0.999)))))).alias("score"))
            .groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
            .select("instance", (-F.col("best.k")).alias("kind"), F.col("best.score").alias("score"), F.lit(False).alias("seed")).join(seeds.select("instance"), "instance", "left_anti")
        )
        scores = stage(seeds.unionByName(found), "pii-scores")
    return scores.where(~F.col("seed") & (F.col("score") >= ACCEPT)).drop("seed")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``pii_base`` and ``pii_spans``: lists of (kind, start, stop) in code points by start, then kind.

    Every text is read whole; null and empty texts have no spans. ``pii_spans`` has the base spans and those that the contexts
    add; an added span takes the kind of its pattern's seeds and never overlaps a base one. Repeated rows stay and get the same spans.
    """
    found = stage(scanned(docs, text), "pii-scan")
    slots = found.select("pii_row", F.explode("pii_slots").alias("s")).select("pii_row", "s.*")
    new = stage(bootstrapped(slots, docs, text), "pii-found")
    span = F.struct("kind", "start", "stop")
    added = slots.where("kind < 0").drop("kind").join(sized(new), "instance").select("pii_row", span.alias("s")).groupBy("pii_row").agg(F.collect_list("s").alias("pii_added"))
    added = stage(added, "pii-added")
    by_place = F.array_sort(F.transform("pii_all", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    in_order = F.transform(by_place, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return (
        found.drop("pii_slots").join(sized(added), "pii_row", "left")
        .withColumn("pii_all", F.concat("pii_base", F.coalesce("pii_added", F.expr(f"cast(array() as {SPAN})"))))
        .withColumn("pii_spans", in_order).drop("pii_row", "pii_added", "pii_all")
    )


def written(spans: str) -> Column:
    """The spans as kind:start:stop, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def redacted(found: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in brackets; spans that overlap are replaced together, by the kind of the first, then longest. Drops the lists."""
    kept = found.drop("pii_base", "pii_spans")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, spans in zip(batch[text].to_pylist(), batch["pii_spans"].to_pylist(), strict=True):
                if spans:
                    parts, at = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
                        if s["start"] >= at:
                            parts += [value[at : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                        at = max(at, s["stop"])
                    value = "".join([*parts, value[at:]])
                texts.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else batch[c] for c in names], names=names)

    return found.drop("pii_base").select(*names, "pii_spans").mapInArrow(run, kept.schema)
