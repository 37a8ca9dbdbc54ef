import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenfield.llm import quality
from lumenfield.llm.common import stash
from tests.llm.data import awkward, empty


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and returns on the smallest tables."""
    d = "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stash(stage(spark, docs, d), "test")
        out[name] = (docs, made)
        docs = made
    return out


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_columns(stages):
    for name, (docs, made) in list(stages.items())[:-1]:
        assert made.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {"doc_id", "n_tokens", "ids", "decoded"} <= set(stages["bpe"][1].columns)


def test_filters_against_labels(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    docs, made = stages["quality_rules"]
    kept = {r.doc_id for r in made.collect()}
    for r in docs.collect():
        n_words, _, _, _, repeated = quality.statistics(r.text)[:5]
        if n_words < 50 or 100 * repeated > 50 * n_words:
            assert r.doc_id not in kept
        elif r.doc_id in labels:
            assert (r.doc_id in kept) == (labels[r.doc_id].quality == 1)
    docs, made = stages["toxicity"]
    kept = {r.doc_id for r in made.collect()}
    known = [r.doc_id for r in docs.collect() if r.doc_id in labels]
    assert sum((i in kept) == (labels[i].toxic == 0) for i in known) >= 0.9 * len(known)  # 11 toxic documents to learn from
    assert all(i in kept for i in known if labels[i].toxic == 0)


def test_near_duplicates_against_all_pairs(stages):
    docs, made = stages["near_duplicates"]
    texts = {r.doc_id: shingles(r.text) for r in docs.collect()}
    kept = {r.doc_id for r in made.collect()}
    alike = lambda a, b: len(a & b) / len(a | b)
    pairs = [(i, j, alike(texts[i], texts[j])) for i in texts for j in texts if i < j]
    for i, j, s in pairs:
        assert not (s >= 0.9 and i in kept and j in kept)
    near = {x for i, j, s in pairs if s >= 0.65 for x in (i, j)}
    assert set(texts) - near <= kept and kept <= set(texts)


def test_mix_and_tokens(stages):
    docs, made = stages["mixing"]
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = docs.toPandas(), made.toPandas()
    total, mixed = before.text.map(n).sum(), after.text.map(n).sum()
    assert abs(total - mixed) < 0.15 * total and after.groupby("doc_id").size().max() <= 3
    assert set(after.text) <= set(before.text)
    assert stages["bpe"][1].count() == len(after)


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "n_tokens", F.md5("ids")).collect()
    assert sorted(rows) == sorted(stages["bpe"][1].select("doc_id", "n_tokens", F.md5("ids")).collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_documents(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = awkward(spark)
    made = stage(spark, docs, "/root/testdata/sf0.001")
    made.collect()
    if name != "bpe":
        assert made.columns == docs.columns
        assert {r.doc_id for r in made.filter("kept IS NOT NULL OR size IS NOT NULL").collect()} == set()
    assert stage(spark, empty(spark), "/root/testdata/sf0.001").collect() == []
