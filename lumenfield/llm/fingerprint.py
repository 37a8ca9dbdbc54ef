"""Document fingerprints as a homomorphic multiset hash of paragraphs.

A document is the multiset of its passages: lines, where longer ones are cut at places that the text itself picks,
as one change should leave the rest of a paragraph as it was. Each passage is hashed to a wide vector, and a fingerprint is the sum of its passages' vectors, so the
order doesn't matter and passages can be added to or taken from a fingerprint without the others. Lanes are

    1 lane modulo 2**32: the number of passages
    8 lanes modulo 2**32: sums over all passages (256 bits, for equality)
    288 lanes modulo 2**32: sums of hashed draws from a Cauchy distribution (for likeness)

The difference of two fingerprints is the fingerprint of what the documents don't share. Its Cauchy lanes are draws from a Cauchy
distribution whose scale is the sum of the differences in how often each passage occurs, as that distribution is 1-stable. So repeats count,
no size of the difference fills the lanes, and the scale (within 8 % or so) gives a Jaccard similarity of multisets.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import shuffle_partitions, stash

DENSE, CAUCHY = 8, 288
SIZE = 4 * (1 + DENSE + CAUCHY)
PASSAGE = re.compile(r".{16,38}?(?:[.!?,;] |[dgkmtyz] |\Z)|.{38}[^ ]{0,10} ?|.+", re.S)
DIGEST = 40
#: Passages hashed at once; bounds the memory that one very long text takes.
BLOCK = 1 << 12
#: Cauchy draws for 16 random bits, in steps of 1 / UNIT. The first and last stand for tails, which ``draws`` spreads further.
UNIT = 16
TABLE = np.array([round(UNIT * math.tan(math.pi * ((i + 0.5) / 65536 - 0.5))) for i in range(65536)], np.int32)
TAIL = UNIT * 65536 / math.pi
STEPS = np.arange(1, CAUCHY // 4 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def passages(text: str) -> Iterator[str]:
    """The passages of a text, which put together are its lines.

    Each line is cut after a mark or a word with one of some last letters, from 16 characters on, and at 49 characters at the latest, so places move with the text, and the first half of a
    text of 100 characters or more always has a whole passage, whatever follows it.
    """
    for line in text.split("\n"):
        if len(line) <= 16:
            yield line
        else:
            yield from PASSAGE.findall(line)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def draws(seeds: np.ndarray) -> np.ndarray:
    """A row of Cauchy draws for each 64-bit seed, as whole numbers of 1 / UNIT."""
    words = mix(seeds[:, None] + STEPS)
    at = words.astype("<u8", copy=False).view("<u2")
    out = TABLE[at]
    row, lane = np.nonzero(at + np.uint16(1) < 2)
    if len(row):
        share = ((mix(words[row, lane // 4] + np.uint64(1) + lane.astype(np.uint64)) >> np.uint64(40)).astype(float) + 1) / (1 << 24)
        far = np.minimum(TAIL / share, 2.0**31 - 1).astype(np.int32)
        out[row, lane] = np.where(at[row, lane] == 0, -far, far)
    return out


def vector(parts: Iterable[str]) -> np.ndarray:
    """The fingerprint of a multiset of passages, as bytes."""
    wide = np.zeros(1 + DENSE + CAUCHY, np.uint32)
    blake = hashlib.blake2b
    held: list[bytes] = []

    def add() -> None:
        raw = np.frombuffer(b"".join(held), np.uint8).reshape(-1, DIGEST)
        wide[0] += np.uint32(len(raw))
        wide[1 : 1 + DENSE] += raw.view("<u4")[:, :DENSE].sum(axis=0, dtype=np.uint32)
        wide[1 + DENSE :] += draws(raw.view("<u8")[:, DENSE // 2]).view(np.uint32).sum(axis=0, dtype=np.uint32)
        held.clear()

    with np.errstate(over="ignore"):
        for p in parts:
            held.append(blake(p.encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest())
            if len(held) == BLOCK:
                add()
        if held:
            add()
    return wide.view(np.uint8)


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """The fingerprint of the union (or difference) of two multisets."""
    with np.errstate(over="ignore"):
        wide = a.view(np.uint32) + b.view(np.uint32) if sign > 0 else a.view(np.uint32) - b.view(np.uint32)
    return wide.view(np.uint8)


def insert(fp: np.ndarray, passage: str) -> np.ndarray:
    return combine(fp, vector([passage]))


def delete(fp: np.ndarray, passage: str) -> np.ndarray:
    return combine(fp, vector([passage]), -1)


def cauchy_scale(x: np.ndarray) -> float:
    """The likeliest scale of Cauchy draws around 0, by Newton's method on its logarithm."""
    square = x * x
    scale = max(float(np.median(np.abs(x))), 0.5)
    for _ in range(20):
        part = square / (square + scale * scale)
        slope = 2 * float((part * (1 - part)).mean())
        step = (float(part.mean()) - 0.5) / max(slope, 0.05)
        scale *= math.exp(min(1.0, max(-1.0, step)))
        if abs(step) < 1e-4:
            break
    return scale


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard similarity of two multisets of passages; 1 if their fingerprints are equal, 0 if nothing seems shared."""
    if np.array_equal(a, b):
        return 1.0
    n, m = int(a[:4].view(np.uint32)[0]), int(b[:4].view(np.uint32)[0])
    lanes = combine(a, b, -1).view(np.int32)[1 + DENSE :].astype(float)
    # passages that aren't shared: at least as many as the sizes differ by, and two if they are equal; all others come in pairs
    least = abs(n - m) or 2
    shared = round((n + m - cauchy_scale(lanes) / UNIT) / 2)
    shared = max(0, min(shared, (n + m - least) // 2))
    return shared / (n + m - shared) if n + m > shared else 1.0


def fingerprint(text: str | None) -> np.ndarray:
    return vector(passages(text or ""))


def bucket_of(cuts: list[tuple], key: Column) -> Column:
    """How many of the sorted ``cuts`` a key isn't below, by a coarse and a fine search of about ``sqrt(len(cuts))`` steps each."""
    k = max(1, math.isqrt(len(cuts)))
    array = lambda some: F.from_json(F.lit(json.dumps([{"d": d, "h": h} for d, h in some])), "array<struct<d: bigint, h: bigint>>")
    below = lambda some: F.size(F.filter(some, lambda c: c <= key))
    coarse = below(array(cuts[::k]))
    fine = below(F.slice(array(cuts), F.greatest(coarse - 1, F.lit(0)) * k + 1, F.lit(k)))
    return F.when(coarse > 0, (coarse - 1) * k + fine).otherwise(0).cast("int")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``bucket``, ``place`` and ``guest``, laid out so that each task has its rows' successors.

    Rows run by descending ``doc_id`` (null last), those of one id by a hash of their texts, and the first follows the last. Buckets are ranges of
    id and hash with about as many rows each, so rows of one id, or of none, may fill several; rows equal in both share one. The first row of
    each bucket is also a guest at the end of the bucket before it. The driver only gets some keys for each bucket, to cut the ranges.
    """
    spark = docs.sparkSession
    parts = parts or shuffle_partitions(spark)
    key = F.struct(F.col("doc_id").cast("long").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    # what ranges are cut by is written once, so that texts are read for it once
    keys = stash(docs.select(key.alias("key")), "keys")
    share = min(1.0, 64.0 * parts / max(1, keys.count()))
    order = lambda k: (k[0] is not None, k[0] or 0, k[1])
    # only where ranges are cut depends on the sample, not what comes out
    some = sorted(((r["key"]["d"], r["key"]["h"]) for r in keys.sample(share, 7).collect()), key=order)
    cuts = sorted({some[len(some) * i // parts] for i in range(1, parts)}, key=order) if some else []
    bucket = bucket_of(cuts, F.col("key")) if cuts else F.lit(0)
    rows = docs.select("doc_id", "text", key.alias("key")).withColumn("bucket", bucket)
    heads = {r["bucket"]: (r["head"]["d"], r["head"]["h"]) for r in keys.withColumn("bucket", bucket).groupBy("bucket").agg(F.max("key").alias("head")).collect()}
    full = sorted(heads, reverse=True)
    before = {b: full[i - 1] for i, b in enumerate(full)}
    known = [{"d": heads[b][0], "h": heads[b][1], "to": before[b]} if b in heads else None for b in range(len(cuts) + 1)]
    head = F.element_at(F.from_json(F.lit(json.dumps(known)), "array<struct<d: bigint, h: bigint, to: int>>"), F.col("bucket") + 1)
    first = head["d"].eqNullSafe(F.col("key.d")) & (head["h"] == F.col("key.h"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    other = F.struct(head["to"].alias("bucket"), F.lit(True).alias("guest"))
    out = rows.withColumn("__at", F.explode(F.when(first, F.array(own, other)).otherwise(F.array(own))))
    out = out.select("doc_id", "text", "key", "__at.bucket", "__at.guest")
    return out.repartitionByRange(parts, "bucket").sortWithinPartitions(F.desc("bucket"), "guest", F.desc("key"), "text")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of each row.

    Null texts are empty; rows that repeat an id run by a hash of their texts; a single row is its own next; an empty
    table gives an empty result; other columns are ignored. A very long text is hashed some thousand passages at a time; it and its edited text are held whole.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last own row: bucket, id, text, fingerprint
        for pdf in batches:
            out = []
            for doc_id, text, bucket, guest in zip(pdf.doc_id.astype(object), pdf.text, pdf.bucket, pdf.guest):
                if guest and held is None:
                    continue
                text = text or ""
                fp = fingerprint(text)
                if held is not None and held[0] == bucket:
                    new = edited(held[2], text)
                    new_fp = fingerprint(new)
                    sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((held[1], len(held[2]), sha, held[3].tobytes().hex(), new_fp.tobytes().hex(), likeness(held[3], new_fp), likeness(held[3], fp)))
                held = None if guest else (bucket, None if pd.isna(doc_id) else int(doc_id), text, fp)
            columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "n_chars": "int64"})

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).drop("key").mapInPandas(rows, schema)
