"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from string import punctuation

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import Memo, slices

NONE = 1 << 60


def merge(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge pairs of ``ids``, lowest rank first and leftmost among equals, until no pair can be merged.

    A leaf of the tree has the rank of the pair that begins at a symbol; an inner node has the least of its leaves. The
    root gives the next rank and the way down its leftmost place. A merge changes three leaves.
    """
    n = len(ids)
    if n < 2:
        return ids
    size = 1 << (n - 2).bit_length()
    tree = [NONE] * (2 * size)
    get = ranks.get
    made = [0] * n
    for i in range(n - 1):
        if (hit := get((ids[i], ids[i + 1]))) is not None:
            tree[size + i], made[i] = hit
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, rank: int) -> None:
        k = size + i
        tree[k] = rank
        while k > 1:
            a, b = tree[k], tree[k ^ 1]
            k >>= 1
            least = a if a <= b else b
            if tree[k] == least:
                return
            tree[k] = least

    while (best := tree[1]) != NONE:
        k = 1
        while k < size:
            k *= 2
            if tree[k] != best:
                k += 1
        i = k - size
        gone = after[i]
        ids[i], end = made[i], after[gone]
        after[i] = end
        if gone < n - 1:
            put(gone, NONE)
        if end < n:
            before[end] = i
            hit = get((ids[i], ids[end]))
        else:
            hit = None
        if hit is None:
            put(i, NONE)
        else:
            made[i] = hit[1]
            put(i, hit[0])
        if (left := before[i]) >= 0:
            hit = get((ids[left], ids[i]))
            if hit is None:
                put(left, NONE)
            else:
                made[left] = hit[1]
                put(left, hit[0])
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible in Latin-1, or else one from 256 up."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


@dataclass
class WordBPE:
    """A BPE tokenizer with a word-end mark, from the content of a tokenizer file.

    Text is put in NFC, white space to a blank, and lower case; words are split by the file's pattern; each is encoded by
    ``merge`` over its bytes, the last of which carries the word-end mark. Added tokens in a text are taken as they are.
    """

    content: str
    cached: int = 1 << 17
    vocab: dict[str, int] = field(init=False)

    def __post_init__(self):
        file = json.loads(self.content)
        model = file["model"]
        kinds = [x["type"] for x in file["normalizer"]["normalizers"]], [x["type"] for x in file["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or file["decoder"] or not model["end_of_word_suffix"]:
            raise ValueError("not a word-end BPE file of the kind that is supported")
        self.vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        self.names = {i: t for t, i in self.vocab.items()} | {x["id"]: x["content"] for x in file["added_tokens"]}
        self.digits = {i: str(i) for i in self.names}
        self.ranks = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        letters = byte_letters()
        self.byte_ids = [self.vocab[x] for x in letters]
        self.end_ids = [self.vocab[x + self.end] for x in letters]
        self.words = regex.compile(file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.added = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.added_pattern = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")")
        self.added_heads = {x[0] for x in self.added}
        self.type = "H" if max(self.names) < 1 << 16 else "I"
        # bytes, as lists of numbers take several times the memory
        self.of_word = Memo(self.encode_word, self.cached * 2)
        self.of_piece = Memo(self.encode_piece, self.cached)

    def encode_word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.byte_ids[b] for b in raw]
        ids[-1] = self.end_ids[raw[-1]]
        return array(self.type, merge(ids, self.ranks)).tobytes()

    def encode_piece(self, piece: str) -> bytes:
        """The ids of a piece without white space."""
        if piece.isascii() and not any(h in piece for h in self.added_heads):
            text = piece.lower()
            word = text.rstrip(punctuation)
            if word.isalpha():  # letters, then marks: two words at most
                return self.of_word[word] + self.of_word[text[len(word) :]] if word != text else self.of_word[word]
        out = []
        for part in self.added_pattern.split(piece):
            if part in self.added:
                out.append(array(self.type, [self.added[part]]).tobytes())
            elif part:
                # lower case by single characters, without the form of sigma at a word's end
                text = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += map(self.of_word.__getitem__, self.words.findall(text))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text. White space only separates words, so the pieces between are encoded alone."""
        pieces = text.split()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split() also splits at these four
            pieces = regex.findall(r"[^\p{White_Space}]+", text)
        ids = array(self.type)
        ids.frombytes(b"".join(map(self.of_piece.__getitem__, pieces)))
        return ids.tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens with a blank between, as the file names no decoder; ids that it doesn't have are left out."""
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join(self.names[i] for i in ids if i in self.names)

    def encode_text(self, text: str) -> tuple[int, str, str]:
        """The number of ids of a whole text, the ids and the decoded text."""
        ids = self.encode(text)
        return len(ids), " ".join(map(self.digits.__getitem__, ids)), self.decode(ids)


_own: dict[tuple[str, int], WordBPE] = {}


def bpe_of(content: str, cached: int) -> WordBPE:
    """The tokenizer of this process for a file's content."""
    key = hashlib.sha256(content.encode()).hexdigest(), cached
    if key not in _own:
        _own[key] = WordBPE(content, cached)
    return _own[key]


def bpe_encode_decode(docs: DataFrame, tokenizer_file: str, cached: int = 1 << 17) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (decimal, a blank between) and ``decoded``; null texts are empty.

    ``cached`` bounds what a worker remembers of words that it has seen (about 1 kB for each): fewer take more time and less memory.

    The tokenizer file is read on the driver and its content, of a fixed size, goes to the executors. Columns of ``docs`` with
    these names are replaced. Repeated rows are coded alike, a very long text word by word, and an empty table gives no row.
    """
    shared = broadcast_file(docs, tokenizer_file)

    @F.pandas_udf("struct<n_tokens: bigint, ids: string, decoded: string>")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = bpe_of(shared.value, cached)
        for texts in (some for batch in batches for some in slices(batch)):
            yield pd.DataFrame([bpe.encode_text(t or "") for t in texts], columns=["n_tokens", "ids", "decoded"])

    return spread(docs, coded(F.col("text")), ["n_tokens", "ids", "decoded"])


def bpe_digests(docs: DataFrame, tokenizer_file: str, cached: int = 1 << 17) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, where only digests leave the tasks."""
    shared = broadcast_file(docs, tokenizer_file)
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()

    @F.pandas_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = bpe_of(shared.value, cached)
        for texts in (some for batch in batches for some in slices(batch)):
            rows = (bpe.encode_text(t or "") for t in texts)
            yield pd.DataFrame([(n, sha(ids), sha(decoded)) for n, ids, decoded in rows], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return spread(docs, coded(F.col("text")), ["n_tokens", "ids_sha256", "decoded_sha256"])


def broadcast_file(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def spread(docs: DataFrame, made, names: list[str]) -> DataFrame:
    return docs.withColumn("__made", made).withColumns({n: F.col(f"__made.{n}") for n in names}).drop("__made")
