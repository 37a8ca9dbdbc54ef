"""Hard negatives by coordinate pruning: buckets of vectors of like length hold sorted lists of each coordinate.

A score of at least ``theta`` needs, in a bucket whose longest vector has length ``l``, a cosine of ``theta / (|anchor| * l)`` or more. That
bounds each coordinate of the vector: with angles ``a`` and ``b`` of the anchor and the vector to an axis, ``|a - b|`` can't exceed the angle of that
cosine. The ranges of the anchor's largest coordinates (its focus) are cut out of the sorted lists and intersected, and what is left is scored exactly.

Anchors meet only buckets that are long enough for their threshold. A bucket above ``CHUNK`` rows is dealt to several, and where there are very many
anchors they are dealt to copies of a bucket, so that no task holds more than one of them and a batch of anchors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfield.llm.common import shuffle_partitions, stash

#: Rows of a bucket that are held at once, and anchors that one copy of a bucket serves, both about.
CHUNK, ANCHORS = 1 << 14, 1 << 16
#: Buckets for each doubling of the length.
PER_OCTAVE = 8
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
NO_ID = np.iinfo(np.int64).max


def usable(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """``(uid, vec_id, label, q, norm)`` of the rows that take part: a label, a vector, and all components finite; ``q`` is ``floor(scale * x)``.

    ``uid`` tells rows apart that share an id.
    """
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    out = vectors.filter(fine).select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), "label", q.alias("q"))
    return out.withColumn("norm", F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


class Bucket:
    """Vectors with the sorted lists of their coordinates, made when they are first needed."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        self.uids, self.ids, self.labels, self.q = uids, ids, labels, q
        self.norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        self.longest = float(self.norms.max()) if len(q) else 0.0
        self.order = self.real = None
        self.greatest = float(np.abs(q).max(initial=0))

    def sort(self) -> None:
        self.unit = self.q / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0).astype(np.int32)
        self.lists = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, anchor: np.ndarray, theta: float | None) -> np.ndarray | None:
        """Places of the vectors that may score ``theta`` or more; None stands for all."""
        length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if theta is None or theta <= 0:
            return None
        if length * self.longest < theta * (1 - 1e-12):
            return np.empty(0, np.int64)
        if self.order is None:
            self.sort()
        unit = anchor / length
        angle = np.arccos(min(theta / (length * self.longest), 1.0))
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            own = np.arccos(np.clip(unit[f], -1.0, 1.0))
            # the slack is far above the rounding of the cosines
            low, high = np.cos(min(own + angle, np.pi)) - 1e-7, np.cos(max(own - angle, 0.0)) + 1e-7
            a, b = np.searchsorted(self.lists[:, f], low, "left"), np.searchsorted(self.lists[:, f], high, "right")
            ranges.append((b - a, a, b, f, low, high))
        ranges.sort(key=lambda r: r[0])
        _, a, b, f, *_ = ranges[0]
        found = self.order[a:b, f]
        for _, _, _, f, low, high in ranges[1:]:
            x = self.unit[found, f]
            found = found[(x >= low) & (x <= high)]
        return found

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products of the vectors at these places. Where they are many, all are multiplied, which is faster than taking them out first."""
        most = self.greatest * float(np.abs(anchor).max(initial=0)) * self.q.shape[1]
        if most >= 2.0**56:
            raise OverflowError("scores are too large for a long")
        if most >= 2.0**53:
            return self.q[at] @ anchor
        if self.real is None:
            self.real = self.q.astype(np.float64)
        anchor = anchor.astype(np.float64)
        return ((self.real @ anchor)[at] if 4 * len(at) > len(self.real) else self.real[at] @ anchor).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, by score from the highest, then by id."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((uids[at], ids[at], -scores[at]))[:k]]


def buckets(rows: DataFrame, key: Column, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Rows with ``key, bucket, chunk``, and ``(key, bucket, chunks, n, longest)`` of each bucket; by length inside a key."""
    octave = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * PER_OCTAVE)).otherwise(-1).cast("int")
    placed = rows.withColumns({"key": key.cast("long"), "bucket": octave})
    sizes = placed.groupBy("key", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    sizes = stash(sizes.withColumn("chunks", F.ceil(F.col("n") / F.lit(chunk)).cast("long")), "buckets")
    own = placed.join(sizes.select("key", "bucket", "chunks"), ["key", "bucket"])
    return own.withColumn("chunk", F.pmod(F.xxhash64("uid"), F.col("chunks"))).drop("chunks"), sizes


MATCH = "anchor_uid long, anchor_id long, for_uid long, for_id long, for_score long, uid long, vec_id long, score long"
SENT = "key long, bucket int, chunk long, copy long, kind int, uid long, vec_id long, label long, q array<bigint>, theta double, for_uid array<bigint>, for_id array<bigint>, for_score array<bigint>"


def probe(index: DataFrame, anchors: DataFrame, copies: int, k: int, bands: tuple[int, int, int] | None) -> DataFrame:
    """The ``k`` best rows of each bucket for each anchor that is sent to it (``MATCH``).

    Without ``bands`` these are other rows that score the anchor's ``theta`` or more (null: all). With ``bands`` (``low, whole, high``) they are rows of
    another label, for each of the anchor's earlier matches (``for_*``), with ``low * for_score <= whole * score <= high * for_score``.
    """
    none = lambda kind: F.lit(None).cast(kind)
    held = index.select(
        "key", "bucket", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"), F.lit(0).alias("kind"), "uid", "vec_id", F.col("label").cast("long").alias("label"), "q",
        none("double").alias("theta"), *(none("array<bigint>").alias(c) for c in ("for_uid", "for_id", "for_score")),
    )
    lists = [F.col(c) if c in anchors.columns else none("array<bigint>").alias(c) for c in ("for_uid", "for_id", "for_score")]
    asked = anchors.select("key", "bucket", "chunk", F.pmod(F.xxhash64("uid"), F.lit(copies)).alias("copy"), F.lit(1).alias("kind"), "uid", "vec_id", F.col("label").cast("long").alias("label"), "q", "theta", *lists)
    where = ["key", "bucket", "chunk", "copy"]
    sent = held.unionByName(asked).repartition(shuffle_partitions(index.sparkSession), *where).sortWithinPartitions(*where, "kind")

    def matches(bucket: Bucket, uid: int, vec_id: int | None, label: int, anchor: np.ndarray, theta: float | None, wanted: Sequence[tuple]) -> Iterator[tuple]:
        width = max(bucket.q.shape[1], len(anchor))
        if width > bucket.q.shape[1]:
            bucket.q, bucket.order, bucket.real = widened(bucket.q, width), None, None
        anchor = widened(anchor[None, :], width)[0]
        at = bucket.candidates(anchor, theta)
        if at is None:
            at = np.arange(len(bucket.uids))
        at = at[bucket.uids[at] != uid] if bands is None else at[bucket.labels[at] != label]
        if not len(at):
            return
        scores = bucket.scores(anchor, at)
        for for_uid, for_id, for_score in wanted:
            if bands is None:
                fit = np.arange(len(at)) if theta is None else np.flatnonzero(scores >= theta)
            else:
                low, whole, high = bands
                fit = np.flatnonzero((scores * whole >= low * for_score) & (scores * whole <= high * for_score))
            for i in fit[best(scores[fit], bucket.ids[at[fit]], bucket.uids[at[fit]], k)].tolist():
                found = int(bucket.ids[at[i]])
                yield uid, vec_id, for_uid, for_id, for_score, int(bucket.uids[at[i]]), None if found == NO_ID else found, int(scores[i])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, parts, bucket = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)])
            cuts = [0, *(np.flatnonzero((places[1:] != places[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                where, kind = tuple(places[a, :4].tolist()), places[a, 4]
                if where != at:
                    at, parts, bucket = where, [], None
                run = batch.slice(a, b - a)
                uids, ids = run.column(5).to_numpy(), run.column(6)
                q = matrix(run.column(8))
                if kind == 0:
                    parts.append((uids, ids.fill_null(NO_ID).to_numpy(), run.column(7).to_numpy(), q))
                    continue
                if bucket is None:
                    if not parts:
                        continue
                    width = max(p[3].shape[1] for p in parts)
                    bucket, parts = Bucket(*(np.concatenate([p[i] for p in parts]) for i in range(3)), np.concatenate([widened(p[3], width) for p in parts])), []
                rest = [run.column(c).to_pylist() for c in (6, 7, 9, 10, 11, 12)]
                for i, (vec_id, label, theta, *lists) in enumerate(zip(*rest)):
                    wanted = list(zip(*lists)) if bands is not None else [(None, None, None)]
                    yield from matches(bucket, int(uids[i]), vec_id, label, q[i], theta, wanted)

    names = [x.split()[0] for x in MATCH.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in found(batches):
            held.append(row)
            if len(held) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=names)

    return sent.mapInArrow(made, MATCH)


def ranked(matches: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` best of all buckets with their ``rank``: by score from the highest, then by id (null last)."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def reached(longest: Column) -> Column:
    """Whether a bucket is long enough for the threshold of an anchor; a little below, as lengths are rounded."""
    return F.col("theta").isNull() | (F.col("theta") <= 0) | (F.col("norm") * longest >= F.col("theta") * (1 - 1e-9))


def by_chunk(anchors: DataFrame) -> DataFrame:
    return anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks", "longest")


def sent_to(anchors: DataFrame, sizes: DataFrame) -> DataFrame:
    """Anchors, once for each chunk of the buckets of their key that are long enough for their threshold."""
    own = anchors.join(sizes.select("key", "bucket", "chunks", "longest"), "key")
    return by_chunk(own.filter(reached(F.col("longest"))))


def sent_to_all(anchors: DataFrame, sizes: list) -> DataFrame:
    """The same where there is one key: its buckets, as many as lengths have eighths of octaves (some 240 at most, as scores are under 2^56), are given as a list."""
    each = F.array(*(F.struct(F.lit(r["bucket"]).alias("bucket"), F.lit(r["chunks"]).alias("chunks"), F.lit(r["longest"]).alias("longest")) for r in sizes))
    each = each.cast("array<struct<bucket: int, chunks: bigint, longest: double>>")
    own = anchors.withColumn("__b", F.explode(F.filter(each, lambda b: reached(b["longest"]))))
    return by_chunk(own.select(*anchors.columns, "__b.*"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, bands: tuple[int, int, int] = (50, 100, 95), chunk: int = CHUNK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from the rows of ``usable``.

    For each anchor and each of its ``positives`` best other rows of the same label, the ``negatives`` best rows of other labels with
    ``low * positive_score <= whole * score <= high * positive_score`` (``bands``). Scores are exact integer inner products; equal scores go by id, null last.
    Repeated rows are rows of their own, as anchors, positives and negatives. Components that a shorter vector lacks count as zero. A table without
    rows or anchors gives no row. Labels are integers. Scores must be under 2^56, else the job fails.
    """
    anchors = rows.filter(is_anchor)
    low, whole, _ = bands
    copies = max(1, -(-anchors.count() // ANCHORS))
    index, sizes = buckets(rows, F.col("label").cast("long"), chunk)
    index = stash(index, "by-label")
    asked = anchors.withColumn("key", F.col("label").cast("long"))
    # the fullest bucket of each label gives its anchors a threshold
    first = sizes.groupBy("key").agg(F.max_by("bucket", F.struct("n", "bucket")).alias("bucket")).withColumn("chunk", F.lit(0).cast("long"))
    seeds = probe(index.join(first, ["key", "bucket", "chunk"], "left_semi"), asked.join(first, "key").withColumn("theta", F.lit(None).cast("double")), copies, positives, None)
    floor = ranked(seeds, ["anchor_uid"], positives).filter(F.col("rank") == positives).select(F.col("anchor_uid").alias("uid"), F.col("score").cast("double").alias("theta"))
    asked = stash(asked.join(floor, "uid", "left"), "thresholds")
    near = ranked(probe(index, sent_to(asked, sizes), copies, positives, None), ["anchor_uid"], positives)
    # a band below zero is empty
    near = near.filter("score >= 0").groupBy(F.col("anchor_uid").alias("uid")).agg(F.sort_array(F.collect_list(F.struct("rank", "uid", "vec_id", "score"))).alias("p"))
    theta = F.array_min("p.score") * F.lit(low / whole)
    wanted = stash(near.select("uid", theta.alias("theta"), F.col("p.uid").alias("for_uid"), F.col("p.vec_id").alias("for_id"), F.col("p.score").alias("for_score")), "positives")
    index, sizes = buckets(rows, F.lit(0), chunk)
    index = stash(index, "by-length")
    asked = anchors.withColumn("key", F.lit(0).cast("long")).join(wanted, "uid")
    # the fullest bucket again raises the threshold, to the worst of what it has for each positive
    known = sizes.select("bucket", "chunks", "longest", "n").collect()
    fullest = max(((r["n"], r["bucket"]) for r in known), default=(0, 0))[1]
    seeds = probe(index.filter((F.col("bucket") == fullest) & (F.col("chunk") == 0)), asked.withColumns({"bucket": F.lit(fullest), "chunk": F.lit(0).cast("long")}), copies, negatives, bands)
    worst = ranked(seeds, ["anchor_uid", "for_uid"], negatives).filter(F.col("rank") == negatives).select(F.col("anchor_uid").alias("uid"), "for_uid", F.col("score").alias("worst"))
    each = wanted.select("uid", F.explode(F.arrays_zip("for_uid", "for_score")).alias("p")).select("uid", "p.for_uid", "p.for_score")
    raised = each.join(worst, ["uid", "for_uid"], "left").groupBy("uid").agg(F.min(F.coalesce(F.col("worst").cast("double"), F.col("for_score") * F.lit(low / whole))).alias("theta"))
    asked = stash(asked.drop("theta").join(raised, "uid"), "raised")
    far = probe(index, sent_to_all(asked, known), copies, negatives, bands)
    out = ranked(far, ["anchor_uid", "for_uid"], negatives)
    return out.select("anchor_id", F.col("for_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("for_score").alias("positive_score"), F.col("score").alias("negative_score"))
