import hashlib
import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenfield.llm import bpe, queries, token_output
from tests.llm.data import AWKWARD, awkward, empty

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)


def odd_texts(n=400):
    rng = random.Random(4)
    parts = ["the", "ΣΊΣΥΦΟΣ", "İx", "é", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "don't", "'s", "we'LL", "12", "３", "½", "😀", "<|endoftext|>",
             "<|startoftext|>", "<|endof", "$$$", ",", "ﬁ", "ß", "한", "中文", "​", "a" * 50, "…", "_", "\r\n", "İ", "Å"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)] + [t or "" for _, t, *_ in AWKWARD]


def test_word_bpe_equals_the_library(libraries):
    own = bpe.WordBPE(open(WORD, encoding="utf-8").read(), cached=50)
    for text in odd_texts():
        want = libraries[0].encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want, repr(text)
        assert own.encode_text(text)[2] == own.decode(want) == libraries[0].decode(want, skip_special_tokens=False)


def test_merge_against_the_plain_loop():
    rng = random.Random(0)
    ranks = {}
    for rank in range(60):
        a, b = rng.randrange(8 + rank), rng.randrange(8 + rank)
        ranks.setdefault((a, b), (rank, 8 + rank))
    for n in [*range(20), 200, 3000]:
        ids = [rng.randrange(8) for _ in range(n)]
        plain = list(ids)
        while n < 1000 or len(plain) > 1:
            best = min(((ranks[p][0], i) for i, p in enumerate(zip(plain, plain[1:])) if p in ranks), default=None)
            if best is None:
                break
            i = best[1]
            plain[i : i + 2] = [ranks[plain[i], plain[i + 1]][1]]
        assert bpe.merge(list(ids), ranks) == plain


def test_pieces_equal_the_whole_text(libraries, monkeypatch):
    encoder = token_output.Encoder(open(BYTE, encoding="utf-8").read(), "<u2", cached=50)
    texts = odd_texts()
    rng = random.Random(8)
    some = [t for t in texts if t.strip()]
    ends = ["", ".", ",\n", "\n\n", "é.", "÷!", " a", "x.com", "\nOf"]
    texts += [" ".join(rng.choice(some) + rng.choice(ends) + rng.choice(some) for _ in range(rng.randrange(9))) for _ in range(400)]
    want = [libraries[1].encode(text, add_special_tokens=False).ids for text in texts]
    for chunk in (1 << 22, 100):
        monkeypatch.setattr(token_output, "CHUNK", chunk)
        for text, ids, raw in zip(texts, want, encoder.encode(pa.array(texts)), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == ids, repr(text)
        assert [len(x) for x in encoder.encode(pa.array([None, ""], pa.string()))] == [0, 0]
    assert list(encoder.encode(pa.array([], pa.string()))) == []


def test_op9_on_the_whole_table(spark, sf_dir, libraries):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op9_bpe(spark, sf_dir).collect():
        ids = libraries[0].encode(texts.pop(r.doc_id), add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(libraries[0].decode(ids, skip_special_tokens=False))
    assert not texts


def test_op2_on_the_whole_table(spark, sf_dir, libraries):
    rows = sorted(queries.op2_token_output(spark, sf_dir).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert [r.doc_id for r in rows] == [d for d, _ in docs]
    start = 0
    for r, (_, text) in zip(rows, docs):
        ids = [*libraries[1].encode(text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_awkward_and_short_document_access(spark, libraries, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT", 64)
    token_output.write_token_ids(awkward(spark), str(tmp_path / "a"), BYTE, 2)
    rows = sorted(token_output.read_token_ids(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    order = sorted(AWKWARD, key=lambda x: (x[0] is not None, x[0], x[1] or ""))
    assert [r.doc_id for r in rows] == [x[0] for x in order]
    for r, (_, text, *_) in zip(rows, order):
        ids = [*libraries[1].encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), crc32(np.array(ids, "<u4").tobytes()))
    dictionary = bytes(spark.read.parquet(str(tmp_path / "a" / "dictionary")).first()["dictionary"])
    for r in spark.read.parquet(str(tmp_path / "a" / "segments")).collect():
        segment = token_output.Segment(bytes(r.data), dictionary)
        assert segment.ids(len(r.doc_ids) - 1)[-1] == 2
        with pytest.raises(ValueError):
            token_output.Segment(bytes(r.data), dictionary + b"x")
    token_output.write_token_ids(empty(spark), str(tmp_path / "b"), BYTE, 2)
    assert token_output.read_token_ids(spark, str(tmp_path / "b")).collect() == []


def test_rows_of_one_id_go_to_several_parts(spark, libraries, tmp_path):
    texts = [f"text {i % 5000} of no id" for i in range(10_000)]
    df = spark.createDataFrame([(None, t) for t in texts] + [(3, "the same")] * 10_000, "doc_id long, text string")
    token_output.write_token_ids(df, str(tmp_path / "a"), BYTE, 2)
    parts = spark.read.parquet(str(tmp_path / "a" / "segments")).groupBy("part").agg(F.sum("n_docs").alias("n")).collect()
    assert len(parts) == 4 and max(r.n for r in parts) < 8_000
    rows = sorted(token_output.read_token_ids(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None] * 10_000 + [3] * 10_000
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    crc = lambda t: crc32(np.array([*libraries[1].encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in rows) == sorted([crc(t) for t in texts] + [crc("the same")] * 10_000)


def test_every_table_gets_a_dictionary(spark, tmp_path):
    for i, texts in enumerate([[], ["a"], ["word " * 2000], ["some words"] * 30]):
        df = spark.createDataFrame([(j, t) for j, t in enumerate(texts)], "doc_id long, text string")
        token_output.write_token_ids(df, str(tmp_path / str(i)), BYTE, 2)
        assert len(spark.read.parquet(str(tmp_path / str(i) / "dictionary")).first()["dictionary"]) >= 8
        assert token_output.read_token_ids(spark, str(tmp_path / str(i))).count() == len(texts)


def test_bpe_awkward(spark, libraries):
    rows = bpe.bpe_encode_decode(awkward(spark), WORD).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert r.ids.split() == [str(x) for x in libraries[0].encode(r.text or "", add_special_tokens=False).ids]
    assert bpe.bpe_encode_decode(empty(spark), WORD).collect() == []
