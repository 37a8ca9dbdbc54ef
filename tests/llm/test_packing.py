import bisect
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenfield.llm import packing as P
from lumenfield.llm import queries
from tests.llm.data import AWKWARD, awkward, empty, sparse

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def slow_cost(ends, costs, window, inside, shortest):
    """The least cost by comparing all pairs of places."""
    n, cost, best = ends[-1], dict(zip(ends, costs)), {0: 0}
    for x in range(n):
        if x not in best:
            continue
        k = bisect.bisect_right(ends, x + window) - 1
        found = ends[k] if k >= 0 else 0
        if (found <= x or x + window - found > inside) and x + window < n and x + window not in cost:
            best[x + window] = min(best.get(x + window, 1 << 60), best[x] + inside)
        for e in ends:
            if x < e <= x + window:
                size = e - x
                padded = 0 if size.bit_count() == 1 and size >= shortest else window - size
                padded = min(padded, (size.bit_count() - 1) * inside) if e == n else padded
                best[e] = min(best.get(e, 1 << 60), best[x] + padded + cost[e])
    return best[n]


def cost_of(cuts, ends, costs, window, inside, shortest):
    """The cost of a way to cut; its last window may be cut into powers of two."""
    n, cost, total = ends[-1], dict(zip(ends, costs)), 0
    sizes, best = [b - a for a, b in zip(cuts, cuts[1:])], 1 << 60
    for i, (size, b) in enumerate(zip(sizes, cuts[1:])):
        assert 0 < size <= window
        if all(x.bit_count() == 1 for x in sizes[i:]) and sum(sizes[i:]) <= window and sizes[i:] == sorted(set(sizes[i:]), reverse=True):
            best = min(best, total + (len(sizes) - i - 1) * inside)
        total += 0 if size.bit_count() == 1 and size >= shortest else window - size
        total += 0 if b == n else cost.get(b, inside)
    return min(best, total)


def test_cuts_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(1500):
        n, window = rng.randrange(1, 120), rng.choice([8, 16, 32])
        ends = sorted({*rng.sample(range(1, n + 1), rng.randrange(1, min(n, 20) + 1)), n})
        costs = [rng.choice([0, 2]) for _ in ends[:-1]] + [0]
        rule = window, rng.choice([2, 3, 6, 40]), rng.choice([2, 4, 1 << 20])
        cuts = P.cut_windows(ends, costs, *rule)
        assert cuts[0] == 0 and cuts[-1] == n
        # less where a power of two at the end happens to meet a better end
        assert cost_of(cuts, ends, costs, *rule) <= slow_cost(ends, costs, *rule)


def test_sentences_end_where_a_reader_sees_it():
    t = Tokenizer.from_file(BYTE)
    text = 'One, two. "Three?" Four 5.5 (six!) seven\neight\n\nnine'
    ids = np.array(t.encode(text, add_special_tokens=False).ids)
    at = P.Marks(t, 1).sentences(ids)
    parts = [t.decode(ids[a:b].tolist()) for a, b in zip([0, *at], [*at, len(ids)])]
    assert "".join(parts) == text
    assert [p.strip() for p in parts] == ["One, two.", '"Three?"', "Four 5.5 (six!)", "seven", "eight", "nine"]


def check(rows, docs, window):
    """Every id in one piece, sequences gapless and not too long; gives the share that is padded and the number of cuts inside a sentence."""
    t = Tokenizer.from_file(BYTE)
    marks, want = P.Marks(t, 1), defaultdict(int)
    for doc_id, text in docs:
        want[doc_id, tuple(t.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    whole, sequences, at = defaultdict(list), defaultdict(list), {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
        at[r["sequence_id"]] = r
        if r["start"] == 0:
            whole[r["doc_id"]].append([])
        assert len(whole[r["doc_id"]][-1]) == r["start"]
        whole[r["doc_id"]][-1] += ids
        if len(whole[r["doc_id"]][-1]) == r["doc_tokens"]:
            want[r["doc_id"], tuple(whole[r["doc_id"]][-1])] -= 1
    assert not any(want.values())
    padded = total = inside = 0
    for s, pieces in sequences.items():
        size = 0
        for offset, n in pieces:
            assert offset == size
            size += n
        assert size <= window
        total += size
        padded += 0 if size.bit_count() == 1 else window - size
        r = at[s]
        end = r["start"] + len(r["ids"]) // 4
        ids = np.array([x for x in whole[r["doc_id"]] if len(x) == r["doc_tokens"]][0])
        inside += end < r["doc_tokens"] and end not in set(marks.sentences(ids).tolist())
    return padded / max(total, 1), inside, len(sequences)


def test_awkward_documents(spark):
    docs = [(i, t) for i, t, *_ in AWKWARD]
    for table in (awkward(spark), sparse(spark)):
        check(P.pack_documents(table, BYTE, 1, window=64).collect(), docs, 64)


def test_stretches_join_up(spark, monkeypatch):
    """Long texts go from one stretch to the next."""
    t = Tokenizer.from_file(BYTE)
    rng = random.Random(4)
    texts = ["", "One two three. " * 40, "word " * 700, "x", "Ein Satz. Noch einer! " * 9] * 3
    packer, rows = P.Packer(P.Marks(t, 1), 32, 5 << 32, stretch=200), []
    for i, text in enumerate(texts):
        for batch in packer.add(i, np.array(t.encode(text, add_special_tokens=False).ids + [1], "<u2")):
            rows += batch.to_pylist()
    for batch in packer.close():
        rows += batch.to_pylist()
    rng.shuffle(rows)
    check(rows, list(enumerate(texts)), 32)
    assert min(r["sequence_id"] for r in rows) == 5 << 32


def test_empty_table(spark):
    assert P.pack_documents(empty(spark), BYTE, 1).collect() == []


def test_little_padding_and_few_cut_sentences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = P.pack_documents(docs, BYTE, 1).collect()
    padded, inside, sequences = check(rows, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 2048)
    assert padded < 0.005
    assert inside < 0.2 * sequences


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = {(r["doc_id"], r["start"]): bytes(r["ids"]) for r in P.pack_documents(docs, BYTE, 1).collect()}
    rows = queries.op11_packing(spark, sf_dir).collect()
    assert {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in rows} == {k: (len(v) // 4, crc32(v)) for k, v in made.items()}
    again = queries.op11_packing(spark, sf_dir)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    assert again.agg(F.countDistinct("sequence_id")).first()[0] < len(rows)
