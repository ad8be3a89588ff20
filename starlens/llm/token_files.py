"""Token ids of documents in binary files of independent zstandard frames.

A file is a sequence of frames in the public seekable layout: every frame holds the ids of some whole documents and
can be decompressed alone; a skippable frame lists the documents (id, first token, number of tokens, frame); the last
one is the seek table with each frame's two sizes and the low half of the XXH64 of its content. A reader fetches the end
of a file, then only the frames of the documents asked for, and checks their sums.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import sys
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.llm.bpe import byte_letters
from starlens.llm.words import CHUNK, slices, text_bytes, words_of, worker_memory
from starlens.session import stage, staging_path

#: Fixed values of the seekable layout.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: Bytes of ids after which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 1 << 18
LEVEL = 1
#: Bytes of text that are encoded together; the same pieces are looked up once.
TOGETHER = 1 << 22
#: The listing of one document: id, whether it has one, first token in the file, tokens, frame.
ENTRY = np.dtype([("doc", "<i8"), ("known", "u1"), ("first", "<u8"), ("tokens", "<u8"), ("frame", "<u4")])
#: What a byte is to ``pieces``: anything else, ASCII white space, a sign, a letter.
OTHER, BREAK, SIGN, LETTER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = BREAK
KIND[[ord(x) for x in ".,;:!?"]] = SIGN
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
#: Signs that are one token run behind a word; the apostrophe is none, it begins English endings.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Pieces, and ids of pieces, from which on a worker forgets what it knows.
REMEMBERED, REMEMBERED_IDS = 1 << 20, 1 << 23
#: Words that the model is asked for as one text, and what stands between them.
ASKED, BETWEEN = 1000, "0"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path: a local path, or a URI that Arrow knows."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri)) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


class Writer:
    """Writes one file; ``add`` takes documents in their final order."""

    def __init__(self, out: io.RawIOBase, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.pending: list[bytes] = []
        self.held = self.tokens = 0
        self.entries: list[tuple[int, int, int, int, int]] = []
        self.frames: list[tuple[int, int, int]] = []
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, doc: int | None, ids: bytes) -> None:
        if self.held and self.held + len(ids) > self.frame_bytes:
            self.flush()
        self.entries.append((doc or 0, doc is not None, self.tokens, len(ids) // 4, len(self.frames)))
        self.pending.append(ids)
        self.held += len(ids)
        self.tokens += len(ids) // 4

    def flush(self) -> None:
        plain = b"".join(self.pending)
        frame = self.press.compress(plain)
        self.out.write(frame)
        self.frames.append((len(frame), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.pending, self.held = [], 0

    def close(self) -> None:
        if self.pending:
            self.flush()
        listing = np.array(self.entries, dtype=ENTRY).tobytes()
        packed = self.press.compress(struct.pack("<I", xxhash.xxh64_intdigest(listing) & 0xFFFFFFFF) + listing)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed)) + packed)
        self.frames.append((len(packed) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


class Reader:
    """Reads one file; only the end at first, then the frames that are asked for."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        frames, flags, magic = struct.unpack("<IBI", self.part(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("this file has no seek table")
        self.table = np.frombuffer(self.part(size - 9 - 12 * frames, 12 * frames), dtype="<u4").reshape(-1, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        self.unpress = zstandard.ZstdDecompressor()
        packed = self.part(int(self.starts[-2]) + 8, int(self.table[-1, 0]) - 8)
        listing = self.unpress.decompress(packed)
        if struct.unpack("<I", listing[:4])[0] != xxhash.xxh64_intdigest(listing[4:]) & 0xFFFFFFFF:
            raise ValueError("the listing of documents is damaged")
        self.entries = np.frombuffer(listing[4:], dtype=ENTRY)
        self.first_of_frame = np.concatenate([[0], np.cumsum(self.table[:-1, 1].astype(np.int64) // 4)])

    def part(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        plain = self.unpress.decompress(self.part(int(self.starts[k]), int(self.table[k, 0])), max_output_size=int(self.table[k, 1]))
        if len(plain) != self.table[k, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return plain

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(id, first token in the file, ids) of all documents or of those in ``wanted``, in file order."""
        last, plain = -1, b""
        for doc, known, first, tokens, frame in self.entries.tolist():
            if wanted is not None and (not known or doc not in wanted):
                continue
            if frame != last:
                last, plain = frame, self.frame(frame)
            at = 4 * (first - int(self.first_of_frame[frame]))
            yield doc if known else None, first, plain[at : at + 4 * tokens]


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as they are, which of them are no ASCII white space, and signs between a letter and white space, which are pieces of their own."""
    kind = KIND[data]
    signs = np.flatnonzero(kind[1:-1] == SIGN) + 1
    return data, kind != BREAK, signs[(kind[signs - 1] == LETTER) & (kind[signs + 1] == BREAK)]


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unbroken(texts: pa.Array) -> list[int]:
    """Rows with a run without ASCII white space that fills a chunk of ``words_of``, which would cut it."""
    data, offsets = text_bytes(texts)
    out = []
    for i in np.flatnonzero(np.diff(offsets) >= CHUNK - 2).tolist():
        gaps = np.flatnonzero(KIND[data[offsets[i] : offsets[i + 1]]] == BREAK)
        if np.diff(np.concatenate([[-1], gaps, [offsets[i + 1] - offsets[i]]])).max() >= CHUNK - 1:
            out.append(i)
    return out


class Known:
    """The ids of pieces by the pieces' 64-bit hashes: open addressing in arrays, so that all pieces of some texts are looked up at once."""

    def __init__(self, slots: int = 2 * REMEMBERED):
        self.keys = np.zeros(slots, np.uint64)  # 0 is a free slot
        self.start, self.size = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        self.ids = np.zeros(1 << 16, "<u4")
        self.pieces = self.used = 0

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or the free one where it belongs."""
        mask = len(self.keys) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        there = self.keys[at]
        left = np.flatnonzero((there != hashes) & (there != 0))
        while len(left):
            at[left] = (at[left] + 1) & mask
            there = self.keys[at[left]]
            left = left[(there != hashes[left]) & (there != 0)]
        return at

    def put(self, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Fill a slot for each of some different hashes that have none."""
        while len(hashes):
            at = self.places(hashes)
            self.keys[at] = hashes  # of several at one slot one stays, the others look on
            mine = self.keys[at] == hashes
            self.start[at[mine]], self.size[at[mine]] = start[mine], size[mine]
            hashes, start, size = hashes[~mine], start[~mine], size[~mine]

    def add(self, hashes: np.ndarray, coded: list[bytes]) -> None:
        """Add different new pieces; there are at least twice as many slots as pieces, and slots move when they become more."""
        self.pieces += len(hashes)
        if 2 * self.pieces > len(self.keys):
            old = self.keys, self.start, self.size
            slots = 1 << (2 * self.pieces).bit_length()
            self.keys, self.start, self.size = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
            full = old[0] != 0
            self.put(*(x[full] for x in old))
        new = np.frombuffer(b"".join(coded), "<u4")
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(self.used, 1 << 16) + len(new), "<u4")])
        self.ids[self.used : self.used + len(new)] = new
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        self.put(hashes, self.used + np.cumsum(size) - size, size)
        self.used += len(new)


class Encoder:
    """The tokenizers library, asked once for each piece of text between ASCII white space.

    For a vocabulary that drops white space the ids of a text are those of its pieces, one after the other. A piece
    of Latin letters with signs behind is asked for in small letters, the signs apart;
    these need no normaliser and are one word each, so a tokenizer of the same model alone takes them, many as one text.
    """

    plain = re.compile(rf"([a-zß-öø-ÿ]+)([{re.escape(SIGNS)}]*)")

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        self.model = Tokenizer.from_str(json.dumps(json.loads(file) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
        for x in (self.tokenizer, self.model):
            x.no_truncation()
            x.no_padding()
        self.letters = dict(enumerate(byte_letters())) | {32: " "}
        self.by_piece = self.whole("a b\xa0c\u2003d\ne") == b"".join(self.whole(x) for x in "abcde") and not self.whole(" \t\n\r\x0b\x0c\x85\xa0\u1680\u2000\u2028\u2029\u202f\u205f\u3000")
        between = self.model.encode(BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self.small = self.by_piece and self.between is not None and self.one_word_each()
        self.known = Known()

    def one_word_each(self) -> bool:
        """Whether capitals are small letters, signs behind a word are one word, and the model alone gives the same ids."""
        tried = ["house", "été", "größe", "ÿ", ".", "?", "niñoundso", *(x + y for x in SIGNS for y in SIGNS)]
        try:
            asked = self.ask_model(tried)
        except ValueError:
            return False
        if self.whole("Été. GRÖßE") != self.whole("été") + self.whole(".") + self.whole("größe") or asked != [self.whole(x) for x in tried]:
            return False
        return self.whole(" ".join(f"Été{x}" for x in tried[7:])) == b"".join(self.whole("été") + x for x in asked[7:])

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ask(self, texts: list[str]) -> list[bytes]:
        return [packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ask_model(self, words: list[str]) -> list[bytes]:
        """The ids of words of small letters or of signs; ``BETWEEN`` is neither and has an id that they cannot have."""
        out = []
        texts = [f" {BETWEEN} ".join(words[k : k + ASKED]).encode().decode("latin-1").translate(self.letters) for k in range(0, len(words), ASKED)]
        for x in self.model.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(x.ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.between)).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True)]
        if len(out) != len(words):
            raise ValueError("the model does not keep words apart")
        return out

    def ids_of(self, fresh: list[bytes]) -> list[bytes]:
        """The ids of pieces in UTF-8."""
        if not self.small:
            return self.ask([x.decode() for x in fresh])
        match = self.plain.fullmatch
        lower = b"\n".join(fresh).decode().lower().split("\n")  # no piece has a line break
        found = list(map(match, lower))
        rest = [i for i, m in enumerate(found) if m is None]
        parts = [m.groups() if m else ("", "") for m in found]
        words = list({x for pair in parts for x in pair if x})
        coded = {"": b""} | dict(zip(words, self.ask_model(words), strict=True))
        out = [coded[word] + coded[signs] for word, signs in parts]
        for i, ids in zip(rest, self.ask([fresh[i].decode() for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self.ask(texts.to_pylist())
        long = unbroken(texts)
        if long:
            apart = dict(zip(long, self.ask([texts[i].as_py() for i in long]), strict=True))
            others = self.encode(pa.array(["" if i in apart else x for i, x in enumerate(texts.to_pylist())], texts.type))
            return [apart.get(i, x) for i, x in enumerate(others)]
        found = words_of(texts, separate=pieces)
        if not len(found.hashes):
            return [b""] * len(texts)
        if self.known.pieces > REMEMBERED or self.known.used > REMEMBERED_IDS:
            self.known = Known()
        known = self.known
        hashes = np.maximum(found.hashes, 1)
        at = known.places(hashes)
        new = np.flatnonzero(known.keys[at] == 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            raw = found.data.tobytes()
            cuts = zip(found.begin[new[first]].tolist(), found.end[new[first]].tolist(), strict=True)
            slots = len(known.keys)
            known.add(fresh, self.ids_of([raw[a:b] for a, b in cuts]))
            if len(known.keys) == slots:
                at[new] = known.places(hashes[new])
            else:
                at = known.places(hashes)
        size, start = known.size[at], known.start[at]  # of every piece in the text's order
        ends = np.cumsum(size)
        ids = known.ids[np.arange(ends[-1]) + np.repeat(start - ends + size, size)].tobytes()
        bounds = (4 * np.append(0, ends)[found.first]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def encoder_of(file: bytes) -> Encoder:
    """A worker's encoder for a vocabulary, kept with what it knows from task to task."""
    memory, key = worker_memory(), ("encoder", hash(file))
    if key not in memory:
        memory[key] = Encoder(file)
    return memory[key]


def write_token_files(docs: DataFrame, vocabulary: str, end: int | None = 2, key: str = "doc_id", text: str = "text", folder: str | None = None, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode every whole text and write the ids in ascending order of ``key``; returns the list of files.

    The files go to ``folder`` (by default a new one below ``spark.checkpoint.dir``), one for each range of keys. A task
    writes under a new name each time it runs and the list, a staged table (part, file, documents, tokens, first_token), has only the names of those
    that ended well, so a lost executor leaves at most a file that nothing names. Null keys come first,
    equal keys by text. Null texts count as empty and have the end id alone. An empty table gives no file.
    """
    spark = docs.sparkSession
    folder = folder or staging_path(spark, "token-files")
    store, place = file_system(folder)
    store.create_dir(place, recursive=True)
    with open(vocabulary, "rb") as file:
        sent = spark.sparkContext.broadcast(file.read())
    ordered = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).repartitionByRange("k").sortWithinPartitions("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tokens"
        encoder, writer = None, None
        last = b"" if end is None else struct.pack("<I", end)
        where, base = file_system(folder)
        out = None
        for batch in batches:
            for low, high in slices(batch["t"], TOGETHER):
                if writer is None:
                    encoder = encoder_of(sent.value)
                    where.create_dir(base, recursive=True)
                    out = where.open_output_stream(f"{base}/{name}")
                    writer = Writer(out, frame_bytes)
                rows = batch.slice(low, high - low)
                for doc, ids in zip(rows["k"].to_pylist(), encoder.encode(rows["t"]), strict=True):
                    writer.add(doc, ids + last)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([len(writer.entries)], pa.int64()), pa.array([writer.tokens], pa.int64())],
                names=["part", "file", "documents", "tokens"],
            )

    files = stage(ordered.mapInArrow(run, "part int, file string, documents long, tokens long"), "token-file-list")
    return with_starts(spark, files)


def with_starts(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The list of files (one row per partition of the write) with the number of tokens in the files before each."""
    listed = sorted(files.collect(), key=lambda x: x["part"])
    rows, start = [], 0
    for x in listed:
        rows.append((x["part"], x["file"], x["documents"], x["tokens"], start))
        start += x["tokens"]
    return spark.createDataFrame(rows, "part int, file string, documents long, tokens long, first_token long")


def read_token_files(files: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, token_ids) of all documents, or of those in ``wanted``: then only their frames are decompressed.

    ``start`` counts the ids of all documents before; ``token_ids`` has little-endian unsigned 32-bit integers. A
    frame whose sum is wrong is an error.
    """
    want = None if wanted is None else set(wanted)
    tasks = files.sparkSession.sparkContext.defaultParallelism * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["file"].to_pylist(), batch["first_token"].to_pylist(), strict=True):
                store, place = file_system(path)
                with store.open_input_file(place) as file:
                    docs, starts, ids, held = [], [], [], 0
                    for doc, first, tokens in Reader(file).documents(want):
                        docs.append(doc)
                        starts.append(base + first)
                        ids.append(tokens)
                        held += len(tokens)
                        if held > 1 << 22:
                            yield rows_of(docs, starts, ids)
                            docs, starts, ids, held = [], [], [], 0
                    if docs:
                        yield rows_of(docs, starts, ids)

    return files.select("file", "first_token").repartition(tasks).mapInArrow(run, "doc_id long, start long, token_ids binary")


def rows_of(docs: list, starts: list, ids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "token_ids"])
