import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lumenfield.llm import quality, queries, toxicity
from tests.llm.data import AWKWARD, awkward, empty


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_counts(spark, sf_dir):
    rows = queries.op10_quality(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_statistics_of_awkward_texts():
    for _, text, *_ in AWKWARD:
        assert quality.statistics(text)[:5] == plain_base(text)


def test_trees_follow_the_constraints_and_the_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.random((1500, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(1500)) > 0.7).astype(float)
    trees = quality.fit_trees(x, y, [1, 0, -1])
    p = trees.score(x)
    assert ((p > 0.5) == y).mean() > 0.9
    for f, sign in ((0, 1), (2, -1)):
        for row in x[:50]:
            line = np.repeat(row[None], 40, 0)
            line[:, f] = np.linspace(0, 1, 40)
            assert (sign * np.diff(trees.score(line)) >= -1e-12).all()
    total = trees.base
    for f, t, left, right, v in zip(trees.feature, trees.threshold, trees.left, trees.right, trees.value):
        at = 0
        while left[at] != at:
            at = left[at] if x[0, f[at]] <= t[at] else right[at]
        total += v[at]
    assert abs(p[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    train = labels.filter("doc_id % 2 = 0")
    out = quality.quality_rules(spark.read.parquet(f"{d}/documents.parquet"), train).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = out.filter("NOT base_failed").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def test_quality_awkward(spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    rows = quality.quality_rules(awkward(spark), labels).collect()
    assert len(rows) == len(AWKWARD) and all(r.base_failed and not r.kept for r in rows)
    assert quality.quality_rules(empty(spark), labels).collect() == []


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    train = toxicity.category_labels(labels.filter("doc_id % 2 = 0"))
    held = labels.filter("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("y"), "quality")
    out = toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), train).join(held, "doc_id").toPandas()
    assert out[(out.y == 1) & (out.quality == 1)].toxic.mean() > 0.9
    assert out[out.y == 0].toxic.mean() < 0.01


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(1)
    x = (rng.random((2000, 5)) < 0.5).astype(np.float32)
    first = x[:, 0]
    second = first * x[:, 1]
    chain = toxicity.fit_chain(x, np.stack([first, second], 1), np.arange(2000) % 5, ["a", "b"], {c: i for i, c in enumerate("wxyz")})
    assert [len(w) for w in chain.weights] == [6, 7]
    p = chain.probabilities(chain.matrix(["w x", "w", "X!", None], 4)[0])
    assert p[0, 0] > 0.9 > 0.1 > p[2, 0] and p[0, 1] > 0.9 and p[3, 1] < 0.1
    assert abs(p[0, 1] - toxicity.sigmoid(np.array([1, p[0, 0], 1, 1, 0, 0, np.log1p(2) / 5]) @ chain.weights[1])) < 1e-9


def test_shuffled_words_have_the_terms_of_the_text(spark):
    texts = ["Bad bad\tBAD\x0bends... ends... ", "ΟΔΟΣ\u2003ΟΔΟΣ ΟΔΟΣ\u00a0x\x1cy  ", "", None, " \n", "a b a b, c. c.", "long " * 50_000 + "end"]
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    labels = docs.select("doc_id", "toxic", F.lit(1).alias("low_quality"))
    out = toxicity.labelled_rows(docs, labels, ["low_quality", "toxic"]).collect()
    assert sorted((r.doc_id, sorted(toxicity.terms_of(r.text))) for r in out) == [(i, sorted(toxicity.terms_of(t))) for i, t, _ in rows]
    assert max(len(r.text or "") for r in out) < 60


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 0, 1), (6, 0, 0), (None, 1, 1), (3, None, 1)], "doc_id long, low_quality int, toxic int")
    rows = toxicity.toxicity(awkward(spark), labels).collect()
    assert len(rows) == len(AWKWARD)
    assert not any(r.toxic for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.toxicity(empty(spark), labels).collect() == []
    assert not any(r.toxic for r in toxicity.toxicity(awkward(spark), labels.filter("false")).collect())
