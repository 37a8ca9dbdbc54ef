"""Conversation structure repair: faults of turns, and the cheapest edits that make the roles alternate.

The edits of a conversation are found by dynamic programming over (turn, state of the grammar ``(s?(ua)+)?``). Costs are computed
backwards, and only the vectors at every ``sqrt(n)``-th turn are kept; the walk forward computes each block's vectors again and
takes, among the edits that are tight, the one whose letter is least.

A conversation's codes (a byte a turn) and the hashes that tell repeated turns are all that is held in a task; its texts are streamed past.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import BLANKS, shuffle_partitions

#: Costs of the edits. A turn that is cut off and not deleted costs one more.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: Initials of the roles; the fourth class is any other role.
INITIALS = "sua"
FINE, TRUNCATED, REMOVED = 0, 1, 2
#: States: nothing yet, after system, after user, after assistant. What a kept initial leads to, and what an inserted or renamed turn leads to.
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
NEXT = (2, 2, 3, 2)
ROLE_OF_STATE = {2: "user", 3: "assistant"}
NEVER = 1 << 60
END_VECTOR = (0, 2 * INSERT, INSERT, 0)


def code_of(initial: str, state: int) -> int:
    at = INITIALS.find(initial) if initial else -1
    return 4 * (at if at >= 0 else 3) + state


def before(code: int, after: Sequence[int]) -> tuple[int, int, int, int]:
    """The costs from each state before a turn, from those after it."""
    kind, state = divmod(code, 4)
    if state == REMOVED:
        own = [DELETE + b for b in after]
    else:
        own = [min(DELETE + after[q], state + REROLE + after[NEXT[q]], state + after[KEPT[q][kind]] if kind in KEPT[q] else NEVER) for q in range(4)]
    user, assistant = min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])
    return min(own[0], INSERT + user), min(own[1], INSERT + user), user, assistant


def cheapest_edits(codes: Sequence[int]) -> tuple[int, str]:
    """The least cost and the edits' letters in order: (D)elete, (I)nsert, (K)eep, (R)ename; of equally cheap ones the least in ASCII."""
    n = len(codes)
    step = max(isqrt(n), 1)
    kept, vector = {n: END_VECTOR}, END_VECTOR
    for i in range(n - 1, -1, -1):
        vector = before(codes[i], vector)
        if i % step == 0:
            kept[i] = vector
    cost, state, letters = kept[0][0], 0, []
    for start in range(0, n + 1, step):
        stop = min(start + step, n)
        vectors = [kept[stop]]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(before(codes[i], vectors[-1]))
        vectors.reverse()
        # the last block also has the end, where turns may still be inserted
        for i in range(start, n + 1 if stop == n else stop):
            now = vectors[i - start]
            while True:
                left = now[state]
                if i < n and DELETE + vectors[i - start + 1][state] == left:
                    letters.append("D")
                    break
                if INSERT + now[NEXT[state]] == left:
                    letters.append("I")
                    state = NEXT[state]
                    continue
                if i == n:
                    break
                kind, fault = divmod(codes[i], 4)
                after = vectors[i - start + 1]
                if kind in KEPT[state] and fault + after[KEPT[state][kind]] == left:
                    letters.append("K")
                    state = KEPT[state][kind]
                else:
                    letters.append("R")
                    state = NEXT[state]
                break
        if stop == n:
            break
    return cost, "".join(letters)


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """``(first, rows)`` for each run of rows of one conversation in each batch; ``first`` if the conversation didn't begin in an earlier batch."""
    last: object = conversations
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        at = 0
        while at < len(rows):
            stop = at
            while stop < len(rows) and rows[stop][0] == rows[at][0]:
                stop += 1
            yield rows[at][0] != last, rows[at:stop]
            last, at = rows[at][0], stop


class Report:
    """What is wrong with one conversation, from its turns in order."""

    def __init__(self, conv_id: object):
        self.conv_id, self.codes, self.seen, self.turns = conv_id, bytearray(), set(), 0
        self.low = self.high = self.last = self.initial = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, tie: bytes, state: str) -> None:
        if state == "dropped":
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last
            self.high = self.last = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        key = (role, tie)
        if state == "blank":
            self.blank, fault = self.blank + 1, REMOVED
        elif key in self.seen:
            self.duplicate, fault = self.duplicate + 1, REMOVED
        elif state == "truncated":
            self.truncated, fault = self.truncated + 1, TRUNCATED
        else:
            fault = FINE
        self.seen.add(key)
        self.codes.append(code_of(initial, fault))

    def row(self) -> tuple:
        self.seen.clear()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *cheapest_edits(self.codes))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some thousand rows, or of about ``size`` characters where they are long."""
    held, held_size = [], 0
    for row in rows:
        held.append(row)
        held_size += sum(len(x) for x in row if isinstance(x, str)) + 64
        if held_size >= size or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, held_size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def ordered(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Rows of a conversation in one partition, one after the other; nulls first."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", *order)


def prepared(turns: DataFrame, *more: str) -> DataFrame:
    """``(conv_id, turn, role, text, tie)`` and the columns ``more``; a null role or text is one space."""
    said = F.coalesce(F.col("text"), F.lit(" "))
    return turns.select(
        *more,
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), said.alias("text"), F.unhex(F.md5(said)).alias("tie")
    )


def report(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of each conversation of ``turns``.

    Turns go by ``turn`` (nulls first), ties by role and a hash of the text. Each has its first fault: blank, a repetition of an earlier turn's role and
    text, or cut off (its last character other than white space isn't one of ``.!?``). ``illegal`` counts neighbours other than system-user, user-assistant and
    assistant-user, and ``audit`` has the cheapest edits. A null role or text is one space; turns without a ``conv_id`` are one conversation;
    an empty table gives no row, and other columns are ignored. Where the boolean column ``dropped`` is true, a row only makes its conversation known. Very long texts are hashed where they are scanned.
    """
    rows = prepared(turns, dropped) if dropped else prepared(turns)
    gone = F.col(dropped) if dropped else F.lit(False)
    end = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    state = F.when(gone, "dropped").when(end == "", "blank").when(end.isin(".", "!", "?"), "fine").otherwise("truncated")
    light = rows.select("conv_id", "turn", "role", "tie", state.alias("state"))

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = None
        for first, run in conversations(batches):
            if first:
                if own is not None:
                    yield own.row()
                own = Report(run[0][0])
            for _, *turn in run:
                own.add(*turn)
        if own is not None:
            yield own.row()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(reports(batches), REPORT)

    return ordered(light, "turn", "role", "tie").mapInArrow(made, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def repair(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the turns of each conversation after the edits of its report (``report(turns)``), numbered from 0; deleted ones are left out."""
    head = reports.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("tie"))
    body = prepared(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "tie")

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        audit, at, place, state = "", 0, 0, 0
        for _, run in conversations(batches):
            for conv_id, kind, _, role, text, _ in run:
                if kind == 0:
                    audit, at, place, state = text, 0, 0, 0
                else:
                    letter, at = audit[at], at + 1
                    if letter == "R":
                        state = NEXT[state]
                        role = ROLE_OF_STATE[state]
                    elif letter == "K":
                        state = KEPT[state][INITIALS.find(role[:1])]
                    if letter != "D":
                        yield conv_id, place, letter, role, text
                        place += 1
                while at < len(audit) and audit[at] == "I":
                    state, at = NEXT[state], at + 1
                    yield conv_id, place, "I", ROLE_OF_STATE[state], ""
                    place += 1

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(edited(batches), REPAIRED)

    return ordered(head.unionByName(body), "kind", "turn", "role", "tie").mapInArrow(made, "conv_id long, place long, edit string, role string, text string")


def repaired_digests(reports: DataFrame, repaired: DataFrame) -> DataFrame:
    """``reports`` with ``repaired_sha256``, of ``role:text`` of the repaired turns joined by line feeds. Texts are streamed past, whatever a conversation's size."""
    counts = [*COUNTS, "audit"]
    head = reports.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit("").alias("said"), *counts)
    body = repaired.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("said"), *(F.lit(None).cast(reports.schema[c].dataType).alias(c) for c in counts))
    schema = REPORT.append(pa.field("repaired_sha256", pa.string()))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own, digest = None, hashlib.sha256()
        for _, run in conversations(batches):
            for conv_id, place, said, *values in run:
                if place < 0:
                    if own is not None:
                        yield *own, digest.hexdigest()
                    own, digest = (conv_id, *values), hashlib.sha256()
                else:
                    digest.update((said if place == 0 else "\n" + said).encode())
        if own is not None:
            yield *own, digest.hexdigest()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(digested(batches), schema)

    return ordered(head.unionByName(body), "place").mapInArrow(made, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: turns damaged by ``crc32("conv_id:turn") % 20``, nulls being one space.

    0 marks a turn as dropped, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user; the others stay.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20).alias("by"))
    text = F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("by") == 4, "user").otherwise(F.col("role")), "copy": F.explode(F.when(F.col("by") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    return rows.select("conv_id", "turn", "role", "text", (F.col("by") == 0).alias("dropped"))
