"""Token ids in binary segments: each document is compressed alone with a shared zstandard dictionary.

A written output is two tables below one path. ``dictionary`` has one row: the dictionary and its hash. ``segments`` has
rows of about ``SEGMENT`` bytes, numbered inside the parts that follow the order of ids; each holds

    magic ``LFT1`` | dictionary hash, 8 bytes | ids of documents before the segment in its part, u64 | n, u32 | bytes an id, u32
    | offset index: n + 1 u64, from the first frame's beginning | ids of each document: n u32 | frames

in little-endian order, so one document is found by its offset and read without the others.

Texts are encoded and compressed where they are scanned; only frames are shuffled into the order of ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfield.llm.common import shuffle_partitions, stash

MAGIC = b"LFT1"
SEGMENT = 1 << 20
#: Short documents that the dictionary is trained on, at most, and the characters of each, at most.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 4000
DICTIONARY_BYTES = 1 << 15
SEGMENT_SCHEMA = "part int, seq int, n_docs int, n_tokens long, doc_ids array<bigint>, data binary"
FRAME_SCHEMA = "doc_id long, tie long, n_tokens long, frame binary"

#: Bytes of text encoded at once; longer texts are cut at blanks, so this bounds the memory that any text takes.
CHUNK = 1 << 22
#: Pieces that are given to the tokenizer in one text.
JOINED = 500
#: A blank between characters other than white space.
BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Texts with other blanks than these, or white space other than a blank or line feed.
UNEVEN = r"  | \n|\n |^[ \n]|[ \n]$|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MARKS = np.isin(np.arange(256), list(b".,;:!?"))
LETTERS = np.array([chr(c).isalpha() and c < 128 for c in range(256)])


@lru_cache(1)
def load(content: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(content)


class Encoder:
    """The ids of texts, the same as the tokenizer gives for each whole text. It stays for the worker's next tasks.

    A byte-level pre-tokenizer never joins what ``borders`` cuts, so pieces can be encoded alone. Numpy cuts a chunk of texts, Arrow
    finds the distinct pieces, those not seen before are encoded many at a time, and the ids of all texts are gathered from them.
    """

    def __init__(self, content: str, width: str, cached: int = 1 << 19):
        self.tokenizer, self.width = load(content), width
        before = self.tokenizer.pre_tokenizer
        self.by_piece = (before.__class__.__name__, self.tokenizer.normalizer) == ("ByteLevel", None) and "ByteLevel(add_prefix_space=False" in repr(before)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cached = cached
        # the letters that stand for a blank and a line feed begin a token and are never inside one of a piece without others
        names = self.tokenizer.get_vocab()
        self.opens = {}
        for mark, letter in ((" ", "Ġ"), ("\n", "Ċ")):
            self.opens[mark] = np.zeros(max(names.values(), default=0) + 1, bool)
            self.opens[mark][[i for t, i in names.items() if t.startswith(letter)]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces. What was not used since the cache was last full is forgotten."""
        if len(self.known) > self.cached:
            self.known, self.old = {}, self.known
        out = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        fresh: dict[str, list[int]] = {" ": [], "\n": [], "": []}
        for i in missing:
            p = pieces[i]
            if (x := self.old.get(p)) is not None:
                out[i] = self.known[p] = x
            else:
                fresh[" " if p[:1] == " " and p.count(" ") == 1 else "\n" if p.isalpha() else ""].append(i)
        for mark, own in fresh.items():
            for at in range(0, len(own), JOINED):
                some = own[at : at + JOINED]
                for i, x in zip(some, self.joined([pieces[i] for i in some], mark) if mark else [self.whole(pieces[i]) for i in some]):
                    out[i] = self.known[pieces[i]] = x
        return out

    def joined(self, pieces: list[str], mark: str) -> list[bytes]:
        """The ids of pieces that begin with a blank, or of words of letters put after a line feed each, from one text."""
        text = "".join(pieces) if mark == " " else mark + mark.join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        cuts = np.flatnonzero(self.opens[mark][ids])
        if len(cuts) != len(pieces):
            return [self.whole(p) for p in pieces]
        raw, size = ids.astype(self.width).tobytes(), int(self.width[2])
        ends = (size * np.append(cuts[1:], len(ids))).tolist()
        begins = (size * (cuts if mark == " " else cuts + 1)).tolist()
        return [raw[a:b] for a, b in zip(begins, ends)]

    def chunk(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each of some texts without uneven white space."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        rows = offsets - offsets[0]
        cuts = np.flatnonzero(borders(data, rows)).astype(np.int32)
        # a row without text has no piece
        first = np.searchsorted(cuts, rows)
        parts = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, np.int32(len(data)))), pa.py_buffer(data.tobytes()))
        coded = parts.dictionary_encode()
        place, known = coded.indices.to_numpy(), self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = int(self.width[2])
        ids = np.frombuffer(b"".join(known), self.width)
        length = np.fromiter(map(len, known), np.int64, len(known)) // size
        begin = np.cumsum(length) - length
        each = length[place]
        end = np.concatenate(([0], np.cumsum(each)))
        at = np.repeat((begin[place] - end[:-1]).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        raw, ends = ids[at].tobytes(), (end[first] * size).tolist()
        return (raw[a:b] for a, b in zip(ends, ends[1:]))

    def uneven(self, text: str) -> bytes:
        head, *rest = BLANK.split(text)
        return b"".join(self.whole(p) if len(p) > 64 else self.ids_of([p])[0] for p in (head, *(" " + p for p in rest)))

    def spans(self, text: str) -> Iterator[str]:
        """Parts of a very long text, each but the first from a blank on that texts can be cut at."""
        at = 0
        while at < len(text):
            found = BLANK.search(text, at + CHUNK // 4)
            stop = found.start() if found else len(text)
            yield text[at:stop]
            at = stop

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as bytes; a null is empty."""
        texts = texts.fill_null("").cast(pa.string())
        if not self.by_piece:
            yield from (self.whole(t) for t in texts.to_pylist())
            return
        odd = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(texts).to_numpy()
        alone = odd | (sizes > CHUNK)
        # runs of texts that stand alone or belong to one chunk
        key = np.where(alone, -1 - np.arange(len(alone)), np.cumsum(np.where(alone, 0, sizes)) // CHUNK)
        bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else []
        for a, b in zip(bounds, bounds[1:]):
            if not alone[a]:
                yield from self.chunk(texts.slice(a, b - a))
            elif odd[a]:
                yield self.uneven(texts[a].as_py())
            else:
                yield b"".join(next(iter(self.chunk(pa.array([s], pa.string())))) for s in self.spans(texts[a].as_py()))


def borders(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte of texts without uneven white space: with a text, at a blank, at a mark after a letter,
    at a line feed, and after a single one."""
    cut = data == 0x20
    if len(data) > 1:
        before, line = data[:-1], data == 0x0A
        letter = LETTERS[before]
        letter[1:] |= (before[:-1] == 0xC3) & (before[1:] != 0x97) & (before[1:] != 0xB7)  # Latin letters with accents
        cut[1:] |= letter & MARKS[data[1:]]
        cut[1:] |= line[1:] & ~line[:-1]
        after = line[:-1] & ~line[1:]
        after[1:] &= ~line[:-2]
        cut[1:] |= after
    cut[rows[:-1][rows[:-1] < len(data)]] = True
    return cut


@lru_cache(2)
def encoder(content: str, width: str) -> Encoder:
    return Encoder(content, width)


def id_type(tokenizer, end_id: int) -> str:
    """The narrowest type that holds every id."""
    return "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, content: str, width: str) -> bytes:
    """A dictionary from the ids of a seeded, bounded sample of short documents (``SAMPLE_ROWS`` of ``SAMPLE_CHARS`` characters at most).

    Where there are too few samples to train on, or they are too uniform, the ids of the samples are the dictionary themselves; where
    there is none, the first 256 ids are.
    """
    key = F.xxhash64(F.lit(7), "doc_id", "text").alias("key")
    short = docs.filter(F.length("text").between(1, SAMPLE_CHARS)).select("doc_id", "text", key)
    # the least keys first, as each task sends its own least rows to the driver
    chosen = F.broadcast(short.select("key").orderBy("key").limit(SAMPLE_ROWS))
    texts = [r["text"] for r in short.join(chosen, "key", "left_semi").orderBy("key", "doc_id", "text").limit(SAMPLE_ROWS).collect()]
    samples = list(encoder(content, width).encode(pa.array(texts, pa.string())))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return raw if len(raw) >= 8 else np.arange(256).astype(width).tobytes()


def hash_of(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:8]


def pack(dictionary: bytes, before: int, width: str, counts: list[int], frames: list[bytes]) -> bytes:
    offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames], dtype=np.uint64))).astype("<u8")
    head = MAGIC + hash_of(dictionary) + np.array([before], "<u8").tobytes() + np.array([len(frames), int(width[2])], "<u4").tobytes()
    return head + offsets.tobytes() + np.array(counts, "<u4").tobytes() + b"".join(frames)


class Segment:
    """Reads documents of one segment through its offset index."""

    def __init__(self, data: bytes, dictionary: bytes):
        if data[:4] != MAGIC or data[4:12] != hash_of(dictionary):
            raise ValueError("not a segment of this dictionary")
        self.before = int(np.frombuffer(data, "<u8", 1, 12)[0])
        n, size = (int(x) for x in np.frombuffer(data, "<u4", 2, 20))
        self.type = f"<u{size}"
        self.offsets = np.frombuffer(data, "<u8", n + 1, 28)
        self.counts = np.frombuffer(data, "<u4", n, 28 + 8 * (n + 1))
        self.data, self.base = data, 28 + 8 * (n + 1) + 4 * n
        self.unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.base + int(self.offsets[i]) : self.base + int(self.offsets[i + 1])]
        raw = self.unzip.decompress(frame, max_output_size=int(self.counts[i]) * int(self.type[2]))
        return np.frombuffer(raw, self.type)


def frames(content: str, dictionary: bytes, width: str, end_id: int, level: int = 3):
    """mapInArrow function: documents to their compressed ids. The last columns are handed through."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level)
        zip_, end = zstandard.ZstdCompressor(level=level, dict_data=shared), np.array([end_id], width).tobytes()
        for batch in batches:
            n, out = [], []
            for raw in encoder(content, width).encode(batch.column("text")):
                n.append(len(raw) // int(width[2]) + 1)
                out.append(zip_.compress(raw + end))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "tie", "n_tokens", "frame"])

    return rows


def segments(dictionary: bytes, width: str):
    """mapInPandas function: frames of a part, in order, to its segments."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seq, before, ids, counts, held, size = 0, 0, [], [], [], 0

        def made() -> pd.DataFrame:
            data = pack(dictionary, before - sum(counts), width, counts, held)
            return pd.DataFrame({"seq": [seq], "n_docs": [len(ids)], "n_tokens": [sum(counts)], "doc_ids": [list(ids)], "data": [data]})

        for pdf in batches:
            for doc_id, n, frame in zip(pdf.doc_id.astype(object), pdf.n_tokens.tolist(), pdf.frame):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                counts.append(n)
                held.append(frame)
                before, size = before + n, size + len(frame)
                if size >= SEGMENT:
                    yield made()
                    seq, ids, counts, held, size = seq + 1, [], [], [], 0
        if ids:
            yield made()

    return rows


def write_token_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Write the ids of every text, in ascending ``doc_id`` order (null first, ties by a hash of the text), with ``end_id`` after each document.

    A null text is empty. Other columns are ignored; an empty table writes no segment. The tokenizer file is read
    on the driver and its content, of a fixed size, goes with the tasks. Rows of one id, or of none, are dealt to parts like
    others: the order is by id, hash and, for equal rows, the place at which they were scanned.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    width = id_type(load(content), end_id)
    dictionary = train_dictionary(docs, content, width)
    spark.createDataFrame([(bytearray(dictionary), hash_of(dictionary).hex())], "dictionary binary, hash string").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(content)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from frames(shared.value, dictionary, width, end_id)(batches)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for out in segments(dictionary, width)(batches):
            yield out.assign(part=part)[["part", "seq", "n_docs", "n_tokens", "doc_ids", "data"]]

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
    own = texts.mapInArrow(made, FRAME_SCHEMA).withColumn("place", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "place"]
    # the ranges are found in what is written, so nothing is encoded twice
    rows = stash(own, "frames").repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows.mapInPandas(placed, SEGMENT_SCHEMA).write.parquet(f"{path}/segments")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, frame_bytes, dictionary)`` of each document of a written output.

    ``start`` counts the ids of all documents before it: its part's start, from the totals of the parts (as many rows as the
    writer had partitions), and its place in the part, which the segment keeps.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    data = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments")
    totals = data.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zlib import crc32

        for pdf in batches:
            for part_start, doc_ids, raw in zip(pdf.part_start, pdf.doc_ids, pdf.data):
                segment = Segment(raw, dictionary)
                start = int(part_start) + segment.before + np.concatenate(([0], np.cumsum(segment.counts, dtype=np.int64)[:-1]))
                crc = [crc32(segment.ids(i).astype("<u4")) for i in range(len(doc_ids))]
                ids = pd.array(doc_ids, dtype="Int64")
                sizes = np.diff(segment.offsets.astype(np.int64))
                yield pd.DataFrame({"doc_id": ids, "start": start, "n_tokens": segment.counts.astype(np.int64), "ids_crc32": crc, "frame_bytes": sizes, "dictionary": hash_of(dictionary).hex()})

    # starts has a row for each of the writer's partitions
    placed = data.join(F.broadcast(starts), "part").select("part_start", "doc_ids", "data")
    return placed.mapInPandas(rows, "doc_id long, start long, n_tokens long, ids_crc32 long, frame_bytes long, dictionary string")
