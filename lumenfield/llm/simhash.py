"""SimHash near-duplicate classes, found with BK-trees over sharded fingerprints.

1. ``fingerprints``: a fingerprint per text. A bit is 1 if it is set in over half of the hashes of the
   text's word shingles (repeats included).
2. Equal fingerprints collapse to one representative (the smallest id), by a partial aggregation.
3. Each distinct fingerprint is dealt to buckets, one for each entry of ``keys`` (lists of bit positions
   whose bits must be equal). ``exact_keys`` are pigeonhole keys: whatever is within the radius shares
   one bucket at least. Buckets with one member are dropped, large ones are cut into shards.
4. In each shard a BK-tree (children keyed by integer Hamming distance to the parent; only edges within
   the radius are followed) finds links. A union-find keeps only links that join two classes, so a
   shard returns fewer links than it has members, whatever the size of a group of copies. Each shard of a large bucket
   also holds the bucket's least member, which joins what the shards find.
5. Only large buckets that still hold several classes are compared across shards: what isn't of a bucket's main class is searched
   in the trees of all its shards.
6. Spark joins the links into connected components (``components``). A node is a fingerprint, not an id, so rows that share an id stay apart.

``drop_near_duplicates`` takes the same way with wide fingerprints in buckets of MinHash keys, and lets the exact Jaccard similarity of shingle
sets decide on what the trees find.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import WORD, slices, stash
from lumenfield.llm.components import connected_components

SEED = 42
#: Shingles hashed at once; bounds the memory that one very long text takes.
BLOCK = 1 << 15


def shingle_hashes(shingle: int, start: int, words: list[bytes]) -> np.ndarray:
    """XXH64 (seed 42) of shingles ``start`` to ``start + BLOCK`` of ``words``."""
    own = words[start : start + BLOCK + shingle - 1]
    joined = map(b" ".join, zip(*(own[i:] for i in range(shingle)))) if len(own) >= shingle else [b" ".join(own)]
    h = xxhash.xxh64_intdigest
    return np.array([h(x, SEED) for x in joined], dtype=np.uint64)


def widen(h: np.ndarray, bits: int) -> np.ndarray:
    """``bits / 64`` 64-bit hashes for each hash; the first is the hash itself."""
    out = [h]
    with np.errstate(over="ignore"):
        for k in range(1, bits // 64):
            z = h + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out.append(z ^ (z >> np.uint64(31)))
    return np.stack(out, axis=1)


def set_bits(h: np.ndarray) -> np.ndarray:
    """How many rows of ``h`` have each bit set."""
    raw = np.unpackbits(h.astype(">u8").view(np.uint8), axis=1)
    n, bits = raw.shape
    whole = n // 255 * 255  # sums of 255 bits fit a byte
    total = raw[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        total += raw[:whole].reshape(-1, 255, bits).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int, bits: int) -> bytes:
    """The bits that are set in over half of the hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return bytes(bits // 8)
    total, n = np.zeros(bits, np.int64), 0
    blocks = (shingle_hashes(shingle, start, words) for start in range(0, max(1, len(words) - shingle + 1), BLOCK))
    for h in blocks:
        total += set_bits(widen(h, bits))
        n += len(h)
    return np.packbits(2 * total > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, bits: int = 64, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(id_col, *keep, fp)``; ``fp`` is binary of ``bits`` bits. A null or blank text has the fingerprint zero."""

    @F.pandas_udf("binary")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, bits) for t in texts], dtype=object)

    return docs.select(F.col(id_col), *keep, fp(F.col(text_col)).alias("fp"))


def exact_keys(bits: int, radius: int, agree: int = 2) -> list[list[int]]:
    """Pigeonhole keys: of ``radius + agree`` blocks, ``agree`` are equal in any two fingerprints within the radius."""
    blocks = np.array_split(np.arange(bits), radius + agree)
    return [[int(i) for b in some for i in b] for some in combinations(blocks, agree)]


def bucket_rows(keys: list[list[int]]):
    """mapInPandas function: ``(node, fp)`` to a row ``(bucket, node)`` for each key."""
    base = len(keys).bit_length()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2000):
                part = pdf.iloc[at : at + 2000]
                raw = np.unpackbits(np.frombuffer(b"".join(part.fp), np.uint8).reshape(len(part), -1), axis=1)
                for k, positions in enumerate(keys):
                    value = raw[:, positions].astype(np.int64) @ (np.int64(1) << np.arange(len(positions), dtype=np.int64))
                    yield pd.DataFrame({"bucket": (value << base) | k, "node": part.node.to_numpy()})

    return rows


class BKTree:
    """A BK-tree of fingerprints (integers) that joins what lies within the radius.

    ``link(a, b)`` is called for members to join. A member within ``radius // 2`` of a node is kept in
    that node's ball instead of becoming a node: what is within the radius of the node belongs to the
    ball's class, so groups of thousands of close copies cost one comparison for each search.
    """

    def __init__(self, radius: int, find, link):
        self.radius, self.slack, self.find, self.link = radius, radius // 2, find, link
        self.root = None

    def search(self, fp: int, rep: int) -> list | None:
        """Join ``rep`` with all classes within the radius; return the node whose ball ``fp`` is in, if any."""
        if self.root is None:
            return None
        radius, slack, near = self.radius, self.slack, None
        reach, todo = radius + slack, [self.root]
        while todo:
            node = todo.pop()
            d = (node[0] ^ fp).bit_count()
            if d <= radius:
                self.link(rep, node[1])
                if d <= slack:
                    near = node
            elif d <= reach and node[3] and self.find(rep) != self.find(node[1]):
                for other, member in node[3]:
                    if (other ^ fp).bit_count() <= radius:
                        self.link(rep, member)
                        break
            for edge, child in node[2].items():
                if -reach <= edge - d <= reach:
                    todo.append(child)
        return near

    def insert(self, fp: int, rep: int, near: list | None) -> None:
        if near is not None:
            near[3].append((fp, rep))
            return
        new = [fp, rep, {}, []]
        if self.root is None:
            self.root = new
            return
        node = self.root
        while True:
            d = (node[0] ^ fp).bit_count()
            if d not in node[2]:
                node[2][d] = new
                return
            node = node[2][d]


class Classes(dict):
    """A union-find of integers; ``join`` says whether it joined two classes."""

    def find(self, x: int) -> int:
        top = x
        while (up := self.get(top, top)) != top:
            top = up
        while x != top:
            self[x], x = top, self.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        x, y = self.find(a), self.find(b)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


def forest_links(radius: int):
    """mapInPandas function: sorted rows of shards to the links that join their classes."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes, found = Classes(), []
        unit, tree = None, None

        def link(a: int, b: int) -> None:
            if classes.join(a, b):
                found.append((a, b))

        for pdf in batches:
            for bucket, shard, node, fp in zip(pdf.bucket, pdf.shard, pdf.node, pdf.fp):
                if unit != (bucket, shard):
                    classes.clear()
                    unit, tree = (bucket, shard), BKTree(radius, classes.find, link)
                value = int.from_bytes(fp, "big")
                tree.insert(value, node, tree.search(value, node))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
            found.clear()

    return rows


class SearchTree:
    """A BK-tree that gives all items within the radius of a fingerprint. Items with equal fingerprints share a node."""

    def __init__(self):
        self.root = None

    def insert(self, fp: int, item) -> None:
        node = self.root
        if node is None:
            self.root = (fp, [item], {})
        while node is not None:
            d = (node[0] ^ fp).bit_count()
            if d == 0:
                node[1].append(item)
                return
            if d not in node[2]:
                node[2][d] = (fp, [item], {})
                return
            node = node[2][d]

    def within(self, fp: int, radius: int) -> Iterator:
        todo = [self.root] if self.root else []
        while todo:
            own, items, children = todo.pop()
            d = (own ^ fp).bit_count()
            if d <= radius:
                yield from items
            todo += (child for edge, child in children.items() if -radius <= edge - d <= radius)


def cross_links(radius: int, similarity: float | None = None):
    """mapInPandas function: sorted rows of units, members (``side`` 0) before what is searched among them (1), to links of classes (``label``).

    With ``similarity`` what is within the radius is linked only if its ``hashes`` have that Jaccard similarity.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes, unit, tree = Classes(), None, None
        for pdf in batches:
            found = []
            sets = pdf.hashes if similarity is not None else pdf.label
            for bucket, a, b, side, label, fp, own in zip(pdf.bucket, pdf.a, pdf.b, pdf.side, pdf.label, pdf.fp, sets):
                if unit != (bucket, a, b):
                    classes.clear()
                    unit, tree = (bucket, a, b), SearchTree()
                value = int.from_bytes(fp, "big")
                if side == 0:
                    tree.insert(value, (label, own))
                    continue
                for other, its in tree.within(value, radius):
                    if classes.find(label) != classes.find(other) and (similarity is None or alike(own, its, similarity)):
                        classes.join(label, other)
                        found.append((label, other))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have that Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < similarity * len(b) - 1e-6:
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return both / (len(a) + len(b) - both) >= similarity


def counted_members(rows: DataFrame) -> DataFrame:
    """``(bucket, node, n, leader)`` of buckets with several members: their number and the least of them.

    Of buckets with the same members one is kept.
    """
    same = ("n", "leader", "xor", "sum")
    sums = F.bit_xor(F.xxhash64("node")).alias("xor"), F.sum(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 31))).alias("sum")
    many = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader"), *sums).filter("n > 1")
    many = stash(many.groupBy(*same).agg(F.min("bucket").alias("bucket")).select("bucket", "n", "leader"), "many")
    return stash(likely(rows, many, "bucket").join(many, "bucket"), "buckets")


def marked(rows: DataFrame, own: DataFrame, key: str, bits: int = 24) -> DataFrame:
    """``rows`` with ``__maybe``: whether their ``key``, a hash, may be one of ``own`` (a column of the same name), so that few rows need be shuffled to be joined.

    A bitmap of ``2**bits`` bits holds the hashes of ``own``: ``2**(bits - 6)`` rows of a word each at most, which are broadcast. The
    more hashes there are, the more other rows are marked.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    bit = F.expr("shiftleft(1L, cast(__place % 64 as int))")
    placed = lambda df: df.withColumn("__place", place).withColumn("__word", F.expr("__place div 64"))
    words = placed(own).groupBy("__word").agg(F.bit_or(bit).alias("__bits"))
    maybe = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return placed(rows).join(F.broadcast(words), "__word", "left").withColumn("__maybe", maybe).drop("__place", "__word", "__bits")


def likely(rows: DataFrame, own: DataFrame, key: str) -> DataFrame:
    return marked(rows, own, key).filter("__maybe").drop("__maybe")


def shards_of(members: DataFrame, shard_rows: int) -> DataFrame:
    """``(bucket, shard, node)``: each member in a shard of its bucket, and the least one in all of them."""
    shards = F.ceil(F.col("n") / shard_rows).cast("int")
    own = F.array(F.pmod(F.xxhash64("node"), shards).cast("int"))
    return members.select("bucket", F.explode(F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0), shards - 1)).otherwise(own)).alias("shard"), "node")


def cross_units(rows: DataFrame, shard_rows: int, shard_weight: int) -> DataFrame:
    """``(bucket, a, b, side, node, label)`` of buckets of ``rows`` (``bucket, node, label, weight``) that hold several classes.

    What isn't of a bucket's main class (side 1) is searched among all its members (side 0), shard by shard. A shard has
    about ``shard_rows`` rows and ``shard_weight`` of weight at most.
    """
    sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    sizes = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("weight").alias("all_weight"), F.max(F.struct("n", "weight", "label")).alias("main"), F.count("*").alias("classes"))
    parts = lambda n, weight: F.greatest(F.ceil(n / shard_rows), F.ceil(weight / shard_weight), F.lit(1)).cast("int")
    mixed = sizes.filter("classes > 1").select(
        "bucket", F.col("main.label").alias("main"), parts(F.col("n"), F.col("all_weight")).alias("all_parts"),
        parts(F.col("n") - F.col("main.n"), F.col("all_weight") - F.col("main.weight")).alias("other_parts"),
    )
    joined = rows.join(mixed, "bucket")
    own = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    base = joined.select("bucket", every("other_parts").alias("a"), own("all_parts").alias("b"), F.lit(0).alias("side"), "node", "label")
    asked = joined.filter("label != main").select("bucket", own("other_parts").alias("a"), every("all_parts").alias("b"), F.lit(1).alias("side"), "node", "label")
    return base.unionByName(asked)


def near_classes(fps: DataFrame, radius: int, keys: list[list[int]], shard_rows: int = 4096) -> DataFrame:
    """``(fp, rep, component)`` for each distinct fingerprint of ``fps`` (``id``, ``fp``).

    ``rep`` is the smallest id with that fingerprint, ``component`` the smallest id reachable by links of at
    most ``radius`` differing bits; both are null where there is none.
    """
    known = stash(fps.groupBy("fp").agg(F.min("id").alias("rep")).withColumn("node", F.xxhash64("fp")), "reps")
    # shuffled first, as a few small files hold what becomes many rows
    rows = known.select("node", "fp").repartition("node").mapInPandas(bucket_rows(keys), "bucket long, node long")
    members = counted_members(stash(rows, "buckets"))
    own = known.select("node", "fp")
    units = shards_of(members, shard_rows).join(own, "node")
    units = units.repartition("bucket", "shard").sortWithinPartitions("bucket", "shard", "node")
    links = stash(units.mapInPandas(forest_links(radius), "a long, b long").distinct(), "links")
    roots = connected_components(links)
    large = members.filter(F.col("n") > shard_rows)
    if not large.isEmpty():
        labelled = large.join(roots, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("label"), F.lit(1).alias("weight"))
        crossed = cross_units(labelled, shard_rows, shard_rows).join(own, "node").repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "side", "node")
        roots = connected_components(links.union(crossed.mapInPandas(cross_links(radius), "a long, b long").distinct()))
    labelled = known.join(roots, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    least = labelled.groupBy("label").agg(F.min("rep").alias("component"))
    return labelled.join(least, "label").select("fp", "rep", "component")


def simhash_components(docs: DataFrame, shingle: int = 3, bits: int = 64, radius: int = 3, keys: list[list[int]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for each row of ``docs``.

    Null, empty and blank texts have the fingerprint zero and link like any other; repeated ids keep a row
    each; an empty table gives an empty result; other columns are ignored.
    """
    keys = keys or exact_keys(bits, radius)
    fps = stash(fingerprints(docs, shingle, bits, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    classes = near_classes(fps, radius, keys)
    return fps.join(classes.select("fp", "component"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )


#: MinHash keys: two texts share one of TABLES keys of WIDTH minima with probability 1 - (1 - s**WIDTH)**TABLES: 0.99 at a similarity s of 0.8.
WIDTH, TABLES = 8, 28
#: Bits of the fingerprints of shingle sets.
SET_BITS = 256
_rng = np.random.default_rng(11)
MASKS, FACTORS = _rng.integers(0, (1 << 64) - 1, (2, WIDTH * TABLES), np.uint64)
FACTORS |= np.uint64(1)


def set_radius(similarity: float, bits: int = SET_BITS) -> int:
    """Bits in which the fingerprints of two sets of that Jaccard similarity differ, four standard deviations above the mean.

    A bit differs with the angle between the sets as its probability, and up to a quarter more in sets of a few shingles.
    """
    p = 1.25 * math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * p + 4 * math.sqrt(bits * p * (1 - p)))


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, in order."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.unique(np.concatenate([shingle_hashes(shingle, start, words) for start in range(0, max(1, len(words) - shingle + 1), BLOCK)]))


def min_keys(h: np.ndarray) -> list[int]:
    """The TABLES keys of a set of hashes."""
    least = np.full(WIDTH * TABLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 256):
        np.minimum(least, ((h[at : at + 256, None] ^ MASKS) * FACTORS).min(axis=0), out=least)
    raw = least.tobytes()
    return [signed(xxhash.xxh64_intdigest(raw[8 * WIDTH * k : 8 * WIDTH * (k + 1)], k)) for k in range(TABLES)]


def set_fingerprint(h: np.ndarray, bits: int = SET_BITS) -> bytes:
    """The SimHash of a set of hashes, block by block."""
    total = np.zeros(bits, np.int64)
    for at in range(0, len(h), BLOCK):
        total += set_bits(widen(h[at : at + BLOCK], bits))
    return np.packbits(2 * total > len(h)).tobytes()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def similar_sets(sketches: DataFrame, texts: DataFrame, shingle: int, similarity: float, shard_rows: int = 1024) -> DataFrame:
    """``(node, component)`` of the distinct shingle sets of ``sketches`` (``id, text_hash, node, keys, fp, size``) that are like another one.

    Sets are those of the low 32 bits of the shingles' hashes, where one in 10,000 shingles at most meets another by chance in texts of up to 400,000 words.
    Sets that share a key meet in a bucket. BK-trees over the fingerprints of its shards find links within ``set_radius``, and the exact
    Jaccard similarity decides on them, so what is lost is what shares no key. A link that fails may have
    stood for others, so buckets that then still hold several classes are searched again, with the exact similarity in the search.
    """
    radius = set_radius(similarity)
    least = F.min(F.struct("id", "text_hash")).alias("row")
    nodes = stash(sketches.groupBy("node").agg(least, *(F.first(c).alias(c) for c in ("keys", "fp", "size"))), "nodes")
    members = counted_members(nodes.select("node", F.explode("keys").alias("bucket")))
    own = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "row.*")
    found = likely(texts, own, "text_hash").join(own, ["id", "text_hash"]).select("node", "text").dropDuplicates(["node"])

    @F.pandas_udf("array<int>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in (some for batch in batches for some in slices(batch)):
            yield pd.Series([np.unique(shingle_set(t, shingle).astype(np.uint32).view(np.int32)) for t in column], dtype=object)

    sets = stash(found.select("node", hashes("text").alias("hashes")), "sets")
    units = shards_of(members, 4 * shard_rows).join(nodes.select("node", "fp"), "node")
    units = units.repartition("bucket", "shard").sortWithinPartitions("bucket", "shard", "node")
    pairs = stash(units.mapInPandas(forest_links(radius), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    pairs = pairs.join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
    both = F.size(F.array_intersect("left", "right"))
    first = stash(pairs.filter(both / (F.size("left") + F.size("right") - both) >= similarity).select("a", "b"), "first")
    labels = connected_components(first).select("node", F.col("component").alias("label"))
    rows = members.filter("n > 2").select("bucket", "node").join(labels, "node", "left").join(nodes.select("node", F.col("size").alias("weight")), "node")
    rows = stash(rows.select("bucket", "node", F.coalesce("label", "node").alias("label"), "weight"), "open")
    crossed = cross_units(rows, shard_rows, 1 << 22).join(nodes.select("node", "fp"), "node").join(sets, "node")
    crossed = crossed.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "side", "node")
    links = first.union(crossed.drop("node").mapInPandas(cross_links(radius, similarity), "a long, b long").distinct())
    return connected_components(links)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: the smallest ``doc_id``, among rows of one id that with the least hash of its text.

    Texts are near-duplicates if their sets of distinct ``shingle``-word shingles have a Jaccard similarity of ``similarity`` or more,
    and classes are what such links connect, also among different texts under one ``doc_id``. Of rows equal in ``doc_id`` and text one
    stays. Rows without a ``doc_id`` are compared like others and come after all that have one. Texts without a word are no copies of
    anything, and all of them stay.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    # the greatest id stands for none; with the hash of the text it names a row
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    worded = docs.filter(F.regexp_like(F.coalesce("text", F.lit("")), F.lit(WORD)))
    texts = worded.select(own_id.alias("id"), text_hash.alias("text_hash"), "text")

    @F.pandas_udf("node long, keys array<long>, fp binary, size long")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in (some for batch in batches for some in slices(batch)):
            sets = (shingle_set(t, shingle) for t in column)
            rows = [(signed(xxhash.xxh64_intdigest(h.tobytes(), SEED)), min_keys(h), set_fingerprint(h), len(h)) for h in sets]
            yield pd.DataFrame(rows, columns=["node", "keys", "fp", "size"])

    sketches = stash(texts.select("id", "text_hash", sketch("text").alias("s")).select("id", "text_hash", "s.*"), "sketches")
    classes = similar_sets(sketches, texts, shingle, similarity)
    rows = sketches.select("id", "text_hash", "node").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = rows.groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("least"))
    others = rows.join(least, "component").filter(F.struct("id", "text_hash") != F.col("least"))
    drop = stash(others.select("id", "text_hash").distinct().toDF("__id", "__hash"), "dropped")
    same = (own_id == F.col("__id")) & (F.col("__text") == F.col("__hash"))
    repeated = stash(sketches.groupBy("id", "text_hash").count().filter("count > 1").select("id", "text_hash").toDF("__id", "__hash"), "repeated")
    # rows that neither list may hold stay where they are, without a shuffle
    lists = drop.unionByName(repeated).select(F.col("__hash").alias("__text"))
    rows = marked(docs.withColumn("__text", text_hash), lists, "__text")
    checked = rows.filter("__maybe").join(drop, same, "left_anti")
    if not repeated.isEmpty():
        once = checked.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "__text"])
        checked = checked.join(repeated, same, "left_anti").unionByName(once)
    return rows.filter("NOT __maybe").unionByName(checked).select(docs.columns)
