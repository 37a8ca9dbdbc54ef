import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfield.llm import hard_negatives as H
from lumenfield.llm import queries
from lumenfield.llm.common import stash
from tests.llm.data import written

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every):
    """All answers by all scores, from rows (vec_id, vector, label)."""
    use = []
    for place, (vec_id, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            use.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v], place))
    out = []
    for a in use:
        if a[0] is None or a[0] % every:
            continue
        others = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in use if b[3] != a[3]]
        others.sort(key=lambda o: (-o[0], o[1][0] is None, o[1][0] or 0))
        for p, b in [o for o in others if o[1][1] == a[1]][:5]:
            far = [o for o in others if o[1][1] != a[1] and 50 * p <= 100 * o[0] <= 95 * p][:3]
            out += [(a[0], b[0], k, n[0], p, s) for k, (s, n) in enumerate(far, 1)]
    return sorted(out, key=repr)


def result(spark, rows, every, chunk=H.CHUNK, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).withColumns({"key": F.lit("x"), "bucket": F.lit("x"), "uid": F.lit("x"), "score": F.lit("x"), "n": F.lit(1)})
    use = stash(H.usable(written(df, 3)), "vectors")
    return sorted((tuple(r[c] for c in NAMES) for r in H.hard_negatives(use, F.col("vec_id") % every == 0, chunk=chunk).collect()), key=repr)


def vectors(rng, n, labels, d=12, spread=0.25):
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    return [(i, [c + rng.gauss(0, spread) for c in centres[i % labels]] if rng.random() < 0.9 else [rng.gauss(0, 3) for _ in range(d)], rng.randrange(labels)) for i in range(n)]


def test_all_scores_give_the_same(spark):
    rng = random.Random(2)
    rows = vectors(rng, 400, 3)
    assert result(spark, rows, 20) == brute(rows, 20)
    assert result(spark, rows, 20, chunk=17) == brute(rows, 20)


def test_awkward_vectors(spark):
    rng = random.Random(5)
    rows = vectors(rng, 120, 2, 4)
    rows += [(7, None, 1), (8, [], 1), (10, [0.0] * 4, 1), (11, [1.0, None, 0.0, 0.0], 1), (12, [1.0, float("nan"), 0.0, 0.0], 1), (13, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0, 1.0, 0.5, 0.1], 1), (20, [1.0, 1.0, 0.5, 0.1], None)]
    rows += [(1000, [0.5, 0.5, 0.1], 0), (1001, [0.5, 0.5, 0.1, 0.0, 2.0], 1)]  # shorter and longer vectors
    rows += [(2000 + i, [0.25, 0.25, 0.25, 0.25], i % 2) for i in range(60)]  # ties
    rows += [(2040, [3.0, 0.0, 0.0, 0.0], 5), (2041, [-3.0, 0.0, 0.0, 0.0], 5)]  # negative positive, few of a label
    rows += [(rows[0][0], rows[0][1], rows[0][2])] * 3  # repeated rows
    assert result(spark, rows, 20) == brute(rows, 20)
    assert result(spark, rows, 20, chunk=9) == brute(rows, 20)


def test_candidates_lose_nothing():
    rng = np.random.default_rng(0)
    q = rng.integers(-200, 200, (500, 16))
    q[:100] = q[0] + rng.integers(-9, 9, (100, 16))
    bucket = H.Bucket(np.arange(500), np.arange(500), np.zeros(500, np.int64), q)
    fewer = 0
    for anchor in q[:40]:
        scores = q @ anchor
        for theta in (1, np.sort(scores)[-50], np.sort(scores)[-3], scores.max(), scores.max() + 1):
            found = bucket.candidates(anchor, float(theta))
            need = np.flatnonzero(scores >= theta)
            assert found is None and theta <= 0 or set(need) <= set(found.tolist())
            fewer += found is not None and len(found) < 250
    assert fewer > 100


def test_no_anchor_and_no_row(spark):
    assert result(spark, [(3, [1.0], 1), (4, [1.0], 1)], 5) == []
    assert result(spark, [], 5) == []


def test_scores_too_large_fail(spark):
    with pytest.raises(Exception, match="too large"):
        result(spark, [(20, [1e12, 1.0], 1), (21, [1e12, 2.0], 1)], 20)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((tuple(r[c] for c in NAMES) for r in queries.op12_hard_negatives(spark, sf_dir).collect()), key=repr)
    assert got == brute(rows, 50)
