"""Packing documents into sequences in their order, by dynamic programming over where to cut.

A stretch of ids is cut into windows of at most ``window`` ids. A window costs what it is padded by (nothing at a power of two) and what its end costs: nothing
after a document, ``sentence`` inside one after a sentence, ``inside`` elsewhere. Ends inside a sentence are looked at only where the window is
full and the last better end in reach, if any, would be padded by more than ``inside``. The padding to a given end is least from the earlier end with the least
``cost + place`` in reach, which a monotone queue keeps at its head.

Documents are packed where they are scanned and in the order in which they are stored: nothing is shuffled. A task packs one stretch of about ``STRETCH`` ids after another,
so its memory doesn't grow with the table or with the longest text's number of sentences, and a lost task gives the same sequences again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfield.llm.token_output import encoder, id_type, load

STRETCH = 1 << 20
#: What a cut costs, in ids of padding.
SENTENCE, INSIDE = 16, 48
#: Windows under this many ids are padded even at a power of two, but for the last of a stretch.
SHORTEST = 64
PACKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def cut_windows(ends: Sequence[int], costs: Sequence[int], window: int, inside: int = INSIDE, shortest: int = SHORTEST) -> list[int]:
    """Where to cut ``[0, ends[-1])``, with both bounds: the cheapest way. ``ends`` rise; ``costs`` are those of the ends."""
    n = ends[-1]
    powers = [p for p in (1 << k for k in range(window.bit_length())) if shortest <= p < window]
    place, total, before, node = [0], [0], [-1], {0: 0}
    queue, waiting = deque([0]), deque()
    at, reach, last = 0, 0, len(ends)
    while at < last and ends[at] <= 0:
        at += 1

    def spawn(i: int, x: int) -> None:
        nonlocal reach
        while reach < last and ends[reach] <= x + window:
            reach += 1
        found = ends[reach - 1] if reach else 0
        if (found <= x or x + window - found > inside) and x + window < n:
            waiting.append((x + window, i))

    spawn(0, 0)
    while at < last:
        x, i = ends[at], len(place)
        if waiting and waiting[0][0] < x:
            x, parent = waiting.popleft()
            if x in node:
                # two full windows end here
                j = node[x]
                if total[parent] + inside < total[j]:
                    total[j], before[j] = total[parent] + inside, parent
                continue
            cost = total[parent] + inside
            while queue and place[queue[0]] < x - window:
                queue.popleft()
        else:
            if waiting and waiting[0][0] == x:
                waiting.popleft()
            while place[queue[0]] < x - window:
                queue.popleft()
            parent = queue[0]
            cost = total[parent] + window - (x - place[parent])
            for p in powers:
                if (j := node.get(x - p)) is not None and total[j] < cost:
                    cost, parent = total[j], j
            cost += costs[at]
            at += 1
        place.append(x)
        total.append(cost)
        before.append(parent)
        node[x] = i
        while queue and total[queue[-1]] + place[queue[-1]] > cost + x:
            queue.pop()
        queue.append(i)
        spawn(i, x)
    # the rest of a stretch may also be cut into powers of two
    end = len(place) - 1
    cost, parent, split = total[end] - costs[-1], before[end], False
    for j in range(end - 1, -1, -1):
        left = n - place[j]
        if left > window:
            break
        if (own := total[j] + ((left.bit_count() - 1) * inside)) < cost:
            cost, parent, split = own, j, True
    cuts = [n] if n else []
    j = parent
    if split:
        left = n - place[j]
        tail = place[j]
        parts = []
        for k in range(left.bit_length() - 1, -1, -1):
            if left >> k & 1:
                tail += 1 << k
                parts.append(tail)
        cuts = parts[::-1]
    while j >= 0:
        cuts.append(place[j])
        j = before[j]
    return cuts[::-1]


class Marks:
    """Which ids end a sentence, by the strings of a vocabulary."""

    def __init__(self, tokenizer, end_id: int):
        names = tokenizer.get_vocab()
        size = max(max(names.values(), default=0), end_id) + 1
        self.ends, self.opens, self.lines = (np.zeros(size, bool) for _ in range(3))
        for name, i in names.items():
            self.ends[i] = name.rstrip("\"')]}").endswith((".", "!", "?", "。", "！", "？"))
            self.opens[i] = name.startswith(("Ġ", "Ċ", "▁"))
            self.lines[i] = name.startswith("Ċ")
        if not self.opens.any():
            self.opens[:] = True

    def sentences(self, ids: np.ndarray) -> np.ndarray:
        """Places at which a sentence begins, other than the first."""
        here, then = ids[:-1], ids[1:]
        return np.flatnonzero((self.ends[here] & self.opens[then]) | (self.lines[here] & ~self.lines[then])) + 1


class Packer:
    """Packs the documents of one task: ``add`` them in order, then ``close``. Both give finished batches (``PACKED``)."""

    def __init__(self, marks: Marks, window: int, first_sequence: int, sentence: int = SENTENCE, inside: int = INSIDE, stretch: int = STRETCH):
        self.marks, self.window, self.sequence, self.sentence, self.inside, self.stretch = marks, window, first_sequence, sentence, inside, stretch
        self.held: list[tuple[int | None, int, int, np.ndarray]] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.stretch - self.size]
            self.held.append((doc_id, start, len(ids), part))
            self.size, start = self.size + len(part), start + len(part)
            if self.size >= self.stretch:
                yield self.pack()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.pack()

    def pack(self) -> pa.RecordBatch:
        ids = np.concatenate([h[3] for h in self.held]).astype("<u4")
        lengths = np.array([len(h[3]) for h in self.held])
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        costs = np.full(len(ids) + 1, -1, np.int32)
        costs[self.marks.sentences(ids)] = self.sentence
        costs[begins] = 0
        costs[[0, len(ids)]] = -1, 0
        ends = np.flatnonzero(costs >= 0)
        cuts = np.array(cut_windows(ends.tolist(), costs[ends].tolist(), self.window, self.inside))
        bounds = np.union1d(cuts, begins)
        at, own = bounds[:-1], np.searchsorted(begins, bounds[:-1], "right") - 1
        sequence = np.searchsorted(cuts, at, "right") - 1
        column = lambda k: np.array([h[k] for h in self.held], np.int64)[own]
        packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.tobytes())])
        doc_ids = pa.array([h[0] for h in self.held], pa.int64()).take(pa.array(own))
        columns = [doc_ids, column(1) + at - begins[own], packed, column(2), self.sequence + sequence, at - cuts[sequence]]
        self.sequence, self.held, self.size = self.sequence + len(cuts) - 1, [], 0
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], schema=PACKED)


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int, window: int = 2048, sentence: int = SENTENCE, inside: int = INSIDE) -> DataFrame:
    """``(doc_id, start, ids, doc_tokens, sequence_id, offset)``: the pieces of documents that make up the sequences.

    ``ids`` are a piece's ids as little-endian unsigned 32-bit integers, those of its document from ``start``; ``offset`` is their place in the sequence.
    Each document ends with ``end_id``; a null text is empty. Rows of one id, or of none, and equal rows are packed like others. An empty table gives no row; other
    columns are ignored. A very long text is encoded in parts and continues from one stretch into the next. The tokenizer's file is read on the driver and
    its content, of a fixed size, goes with the tasks. ``sequence_id`` rises along each stored part of the table and is distinct over all.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    width = id_type(load(content), end_id)
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        marks, end = Marks(load(shared.value), end_id), np.array([end_id], width).tobytes()
        packer = Packer(marks, window, TaskContext.get().partitionId() << 32, sentence, inside)
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder(shared.value, width).encode(batch.column("text"))):
                yield from packer.add(doc_id, np.frombuffer(raw + end, width))
        yield from packer.close()

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(made, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
