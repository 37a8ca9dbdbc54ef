import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lumenfield.llm import simhash
from lumenfield.llm.components import connected_components
from tests.llm.data import AWKWARD, awkward, empty, sparse


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, radius=3):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(zip(ids, fps)):
        for b, y in zip(ids[:i], fps[:i]):
            if (x ^ y).bit_count() <= radius:
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_whole_table_against_all_pairs(spark, sf_dir):
    rows = simhash.simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{x:016x}" for i, x in fps.items()}
    ids = sorted(texts)
    assert {r.doc_id: r.component_id for r in rows} == plain_components(ids, [fps[i] for i in ids])


def test_chains_and_large_groups_against_all_pairs(spark):
    rng = random.Random(3)
    fps = {}
    for g in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 200 if g == 0 else 3])):
            fps[len(fps)] = x
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    df = spark.createDataFrame([(i, x.to_bytes(8, "big")) for i, x in fps.items()], "id long, fp binary")
    want = plain_components(list(fps), list(fps.values()))
    for shard_rows in (4096, 7):
        got = simhash.near_classes(df, 3, simhash.exact_keys(64, 3), shard_rows).join(df, "fp").collect()
        assert {r.id: r.component for r in got} == want


def test_bk_tree_joins_what_is_near():
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = [center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for _ in range(300)]
    parent = {}

    def find(x):
        while x in parent:
            x = parent[x]
        return x

    def link(a, b):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)

    for radius in (0, 1, 3, 6):
        parent.clear()
        tree = simhash.BKTree(radius, find, link)
        for i, x in enumerate(fps):
            tree.insert(x, i, tree.search(x, i))
        assert {i: find(i) for i in range(300)} == plain_components(list(range(300)), fps, radius)


def test_awkward(spark):
    rows = simhash.simhash_components(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[2].fingerprint == f"{plain_fingerprint(AWKWARD[0][1]):016x}"
    assert by_id[2].component_id == 1
    assert {by_id[i].fingerprint for i in (3, 4, 5)} == {"0" * 16} and {by_id[i].component_id for i in (3, 4, 5)} == {3}
    assert simhash.simhash_components(empty(spark)).collect() == []


def test_rows_without_an_id_are_compared(spark):
    """One of equal texts stays, one with an id before those without; other texts and blank ones stay."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    long = [" ".join(rng.choices(words, k=200)) for _ in range(4)]
    near = lambda text: text + " more"
    rows = [(None, long[0]), (None, near(long[0])), (7, long[1]), (None, near(long[1])), (None, long[1]), (None, long[2]), (None, long[2]), (None, long[2]), ((1 << 63) - 1, long[3]), (None, ""), (None, None)]
    got = [tuple(r) for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(x in got for x in ((None, long[0]), (None, near(long[0])))) == 1
    assert sorted(got, key=str) == sorted([next(x for x in got if x[1] in (long[0], near(long[0]))), (7, long[1]), (None, long[2]), ((1 << 63) - 1, long[3]), (None, ""), (None, None)], key=str)


def test_drop_near_duplicates(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(i, " ".join(base if i % 2 else [*base[:200], f"new{i}", *base[201:]])) for i in range(20)]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(30)]
    rows += [(200, rows[25][1]), (300, ""), (301, None), (302, ""), (None, "x y"), (None, "x y"), (125, rows[25][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    kept = [r.doc_id for r in simhash.drop_near_duplicates(df).collect()]
    want = [0, *(i for i, _ in rows[20:50]), 300, 301, 302, None]
    assert sorted(kept, key=str) == sorted(want, key=str)
    assert simhash.drop_near_duplicates(awkward(spark)).columns == awkward(spark).columns
    assert sorted(map(str, simhash.drop_near_duplicates(sparse(spark)).collect())) == sorted(map(str, simhash.drop_near_duplicates(awkward(spark)).collect()))
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []


def test_rows_that_share_an_id(spark):
    """Different texts under one id are nodes of their own: nothing unrelated is lost, near copies go, and blank rows stay whatever else repeats."""
    rng = random.Random(6)
    words = [[rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(200)] for _ in range(3)]
    a, b, c = (" ".join(w) for w in words)
    near = lambda w: " ".join([*w[:100], "other", *w[101:]])
    keep = lambda rows: sorted(tuple(r) for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert keep([(5, a), (5, b), (3, near(words[0])), (4, near(words[1]))]) == [(3, near(words[0])), (4, near(words[1]))]
    assert len(keep([(5, a), (5, near(words[0])), (6, c)])) == 2
    assert keep([(7, ""), (7, "")]) == [(7, "")] * 2
    assert keep([(7, ""), (7, ""), (1, a), (1, a)]) == [(1, a), (7, ""), (7, "")]
    rows = simhash.simhash_components(spark.createDataFrame([(5, a), (5, b), (3, a), (4, b)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(5, 3), (5, 4), (3, 3), (4, 4)}


def test_recall_of_near_duplicates(spark):
    """On the documents of sf0.01 against all pairs: what a similarity of 0.8 or more should remove goes, and nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets, holders, links = {}, {}, Counter()
    for r in docs.collect():
        if (r.text or "").split():
            sets[r.doc_id] = set(simhash.shingle_set(r.text, 5).tolist())
            for h in sets[r.doc_id]:
                holders.setdefault(h, []).append(r.doc_id)
    for own in holders.values():
        links.update((a, b) for i, a in enumerate(own) for b in own[i + 1 :])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), both in links.items():
        if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {i for i in sets if find(i) != i}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert len(want) > 50 and len(want & kept) <= 0.02 * len(want)
    assert set(sets) - want <= kept


def test_wide_fingerprints_of_similar_sets():
    """Sets of a similarity of 0.8 are within the radius, also those of few shingles; unlike ones are not."""
    rng = np.random.default_rng(1)
    radius, gone = simhash.set_radius(0.8), 0
    for n, m, both in [(4, 5, 4), (9, 9, 8), (12, 15, 12), (45, 45, 40), (400, 500, 400)] * 40:
        h = rng.integers(0, 1 << 63, n + m - both, np.uint64)
        a, b = (int.from_bytes(simhash.set_fingerprint(x), "big") for x in (h[:n], h[n - both :]))
        c = int.from_bytes(simhash.set_fingerprint(rng.integers(0, 1 << 63, n, np.uint64)), "big")
        gone += (a ^ b).bit_count() > radius
        assert (a ^ c).bit_count() > radius
    assert gone <= 2


def test_large_buckets_of_several_classes(spark):
    """Shards, the search across them and the exact similarity give what all pairs give."""
    rng = random.Random(9)
    rows = []
    for g in range(6):
        base = [f"{g}w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    texts = spark.createDataFrame(rows, "id long, text string").withColumn("text_hash", F.xxhash64("text"))
    sets = {i: simhash.shingle_set(t, 5) for i, t in rows}
    node = {i: simhash.signed(simhash.xxhash.xxh64_intdigest(h.tobytes(), 42)) for i, h in sets.items()}
    data = [(i, node[i], simhash.min_keys(h), bytearray(simhash.set_fingerprint(h)), len(h)) for i, h in sets.items()]
    sketches = spark.createDataFrame(data, "id long, node long, keys array<long>, fp binary, size long").join(texts.drop("text"), "id")
    parent = {x: x for x in node.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in range(i):
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                x, y = find(node[i]), find(node[j])
                parent[max(x, y)] = min(x, y)
    for shard_rows in (1024, 4):
        got = {r.node: r.component for r in simhash.similar_sets(sketches, texts, 5, 0.8, shard_rows).collect()}
        assert {x: got.get(x, x) for x in parent} == {x: find(x) for x in parent}


def test_near_duplicates_by_exact_similarity(spark):
    """Pairs just over 0.8 lose one text, pairs just under it none; so do a chain and a group whose least member links to few."""
    rng = random.Random(4)
    rows, want = [], set()

    def text(shared, own):
        return [f"s{rng.getrandbits(60)}" for _ in range(shared)], [f"o{rng.getrandbits(60)}" for _ in range(own)]

    for i in range(400):
        # 5-word shingles of n shared words and k others at the end of each text: n - 4 shared, k more each
        n, k = (204, 24) if i % 2 else (204, 26)  # 200 / 248 = 0.806, 200 / 252 = 0.794
        shared, own = text(n, k)
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + text(0, k)[1]))]
        want |= {2 * i} if i % 2 else {2 * i, 2 * i + 1}
    words = text(300, 0)[0]
    chain = [" ".join(words[j : j + 200]) for j in range(0, 100, 10)]  # neighbours 186 / 206, ends nothing like it
    rows += [(5000 + j, x) for j, x in enumerate(chain)]
    want.add(5000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.drop_near_duplicates(df).collect()}
    assert want <= kept and len(kept - want) <= 8  # 200 pairs at 0.806, found with probability 0.99
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    assert all(len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) >= 0.8 for i in range(2, 800, 4))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = list(range(1200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
