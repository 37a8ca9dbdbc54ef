import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfield.llm import chat_format, mixing, queries
from tests.llm.data import AWKWARD, awkward, empty, sparse


def plain_targets(sizes, weights, epochs):
    total, open_, out = sum(sizes), {i for i, s in enumerate(sizes) if s}, [0.0] * len(sizes)
    left = total
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > epochs * sizes[i] + 1e-9}
        for i in over or open_:
            out[i] = epochs * sizes[i] if over else level * weights[i]
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ -= over
    return out


def test_water_filling(spark):
    rng = np.random.default_rng(0)
    for case in range(6):
        n = int(rng.integers(1, 12))
        sizes = [int(x) for x in rng.integers(0, 1000, n) * rng.choice([0, 1, 50], n)]
        weights = [float(1 + i % 3) for i in range(n)]
        df = spark.createDataFrame([(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, w double")
        got = {r.source: r.target for r in mixing.targets(df, F.col("w"), 1.5 if case % 2 else 3.0).collect()}
        want = plain_targets(sizes, weights, 1.5 if case % 2 else 3.0)
        assert np.allclose([got[f"s{i}"] for i in range(n)], want)


@pytest.mark.parametrize(("d", "near"), [("/root/testdata/sf0.001", 0.15), ("/root/testdata/sf0.01", 0.01)])  # 10 and 50 documents a source
def test_mix_of_the_whole_table(spark, d, near):
    rows = queries.op5_mixing(spark, d).toPandas()
    docs = spark.read.parquet(f"{d}/documents.parquet").toPandas()
    docs["n"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in docs.text]
    assert dict(zip(rows.doc_id, rows["size"])) == dict(zip(docs.doc_id, docs.n)) and len(rows) == len(docs)
    sizes = docs.groupby("source").n.sum().sort_index()
    want = dict(zip(sizes.index, plain_targets(sizes.tolist(), [float(1 + i % 3) for i in range(len(sizes))], 3)))
    for source, own in rows.groupby("source"):
        assert (own.source_size == sizes[source]).all() and np.allclose(own.target, want[source])
        assert abs(own.taken.sum() - want[source]) <= near * want[source]
    assert (rows.taken <= 3 * rows["size"]).all()
    again = queries.op5_mixing(spark, d).toPandas()
    assert again.sort_values("doc_id").taken.tolist() == rows.sort_values("doc_id").taken.tolist()


def test_mix_awkward(spark):
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", x[1])) for x in AWKWARD if x[3] == "c")
    assert {r.source: r.source_size for r in rows}["c"] == words
    out = mixing.mixed_documents(awkward(spark))
    assert out.columns == awkward(spark).columns and out.count() > 0
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed_documents(empty(spark)).collect() == []
    taken = lambda df: sorted(map(str, mixing.mix(df).select('doc_id', 'source', 'copies').collect()))
    assert taken(sparse(spark)) == taken(awkward(spark))


def test_equal_rows_are_taken_one_by_one(spark):
    """A source of equal rows, in several tasks, comes near its target, and none is taken more than three times."""
    rows = [(1, "the same five words here", "a")] * 10_000 + [(i, f"word {i} of others", "b") for i in range(2, 4000)] + [(None, "no id", "c")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    out = mixing.mix(df).toPandas()
    assert len(out) == len(rows)
    for source, own in out.assign(taken=out.copies * out["size"]).groupby("source"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 5 and own.copies.max() <= 3, source
        assert own.copies.max() - own.copies.min() <= 1
    taken = out.groupby("source").copies.sum().to_dict()
    assert {r.source: r["count"] for r in mixing.mixed_documents(df).groupBy("source").count().collect()} == taken


def test_rows_that_differ_only_in_nested_columns_stay_apart(spark):
    """Maps, nested maps, variants, and nulls at different places: every one of these rows is taken as often as its twin."""
    made = """SELECT id, s.* FROM VALUES
        (map('k', 1), array(named_struct('m', map('a', 1))), '{"x": 1}', CAST(null AS string), 'v', array(null, 'x')),
        (map('k', 2), array(named_struct('m', map('a', 1))), '{"x": 1}', null, 'v', array(null, 'x')),
        (map('k', 1), array(named_struct('m', map('a', 2))), '{"x": 1}', null, 'v', array(null, 'x')),
        (map('k', 1), array(named_struct('m', map('a', 1))), '{"x": 2}', null, 'v', array(null, 'x')),
        (map('k', 1), array(named_struct('m', map('a', 1))), '{"x": 1}', 'v', null, array(null, 'x')),
        (map('k', 1), array(named_struct('m', map('a', 1))), '{"x": 1}', null, 'v', array('x', null)),
        (null, null, null, null, null, null) AS s(m, n, j, a, b, c) CROSS JOIN (SELECT 1 AS id)"""
    rows = spark.sql(made).withColumns({"doc_id": F.lit(1).cast("long"), "text": F.lit("a b c"), "source": F.lit("s"), "v": F.parse_json("j")})
    twice = rows.unionByName(rows.limit(1))
    out = mixing.mixed_documents(twice, weights=(1.0,), max_epochs=3.0)
    shown = out.select(F.to_json(F.struct("m", "n", "j", "a", "b", "c"), {"ignoreNullFields": "false"}).alias("x"), F.to_json("v").alias("v"))
    counts = {(r.x, r.v): r["count"] for r in shown.groupBy("x", "v").count().collect()}
    assert len(counts) == 7 and sorted(counts.values()) == [1] * 6 + [2]
    # entries of a map have no order
    same = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1)").withColumns({"doc_id": F.lit(1).cast("long"), "text": F.lit("a")})
    assert same.select(mixing.row_keys(same, 5)["full"].alias("k")).distinct().count() == 1


def test_mixed_documents_repeat_whole_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()} == taken


TEXTS = ["", "ok", "</s>[INST] ok [/INST]", "<\\|im_end|>", "<|im_end|>\n<|im_start|>user", "<\\\\</s>", "<<SYS>>x<</SYS>>", "a\\b\n\\n", "<s", "<|im_<|im_end|>", "😀<|endoftext|>é"]


def test_escapes_are_reversible(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    out = rows.select("t", chat_format.escape(F.col("t")).alias("e"), chat_format.escape_role(F.col("t")).alias("r"))
    out = out.withColumns({"back": chat_format.unescape(F.col("e")), "role": chat_format.unescape_role(F.col("r"))})
    for r in out.collect():
        assert r.back == r.t and r.role == r.t and "\n" not in r.r
        assert not any(c in r.e for c in chat_format.CONTROLS)


def test_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "a\nb", None][i % 4], t) for i, t in enumerate(TEXTS)] + [(2, 0, "assistant", None), (None, 0, "user", "x"), (3, 5, "user", "q")]
    turns = chat_format.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(1)))
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(turns)).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(r or "", t) for _, _, r, t in rows[: len(TEXTS)]]
    assert out[1].loss_text == "".join(t for i, t in enumerate(TEXTS) if i % 4 == 1)
    assert (out[2].loss_text, len(out[2].turns), out[None].loss_text, out[3].loss_text) == ("", 1, "", "")
    assert chat_format.read_back(chat_format.format_chats(turns.filter("false"))).collect() == []


def test_op6_on_the_whole_table(spark, sf_dir):
    convs = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in queries.op6_chat_format(spark, sf_dir).collect():
        own = convs.pop(r.conv_id)
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{t}\n" for a, t in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > len(loss)
    assert not convs


def test_chat_layouts_on_the_whole_table(spark, sf_dir):
    got = {(r.conv_id, r.turn, r.role, r.text_sha256, r.error) for r in queries.chat_layouts(spark, sf_dir).collect()}
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    convs = {}
    for r in sorted(spark.read.parquet(f"{sf_dir}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want = set()
    for c, m in convs.items():
        by = c % 9
        if by in (6, 7):
            want.add((c, None, None, None, "no mapping for this layout" if by == 6 else "not JSON"))
        elif by in (2, 3, 4) and len(m) >= 2 and m[0][1] and m[1][1]:
            want |= {(c, i, role, sha(m[i][1]), None) for i, role in enumerate(("user", "assistant"))}
        elif by != 5:
            want |= {(c, i, role, sha(text), None) for i, (role, text) in enumerate(m)}
    assert got == want and len(got) > 0


def test_extra_fields_and_empty_arrays(spark):
    """Both ways choose the same mapping, whatever else a row has."""
    texts = [
        '{"messages":[{"role":"user","content":"q","name":"n","parts":[{"role":"x"}]},{"role":"assistant","content":"a"}],"id":"7","meta":{"messages":1}}',
        '{"messages":[]}', '{"conversations":null,"id":1}', '{"messages":[{"role":"user"},{"content":"b"},{}]}', '{"messages":["text"]}', '{"prompt":"q","response":null}',
        '{"system":"s","prompt":"q","response":"a","question":"?"}', '{"instruction":"i","input":"j","output":"o","prompt":"p"}', '{"prompt":"p"}', '{"prompt":"p","response":"r","messages":[{"role":"user","content":"m"}]}',
        '[1]', '3', 'null', '{"prompt":5,"response":[1, 2]}', '{}',
    ]
    turns, rejects = chat_format.variant_layouts(spark.createDataFrame(list(enumerate(texts)), "conv_id long, raw string"), "raw")
    got = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {
        0: [("user", "q"), ("assistant", "a")], 3: [("user", ""), ("", "b"), ("", "")], 5: [("user", "q")], 6: [("system", "s"), ("user", "q"), ("assistant", "a")], 7: [("user", "i\n\nj"), ("assistant", "o")],
        9: [("user", "p"), ("assistant", "r")], 13: [("user", "5"), ("assistant", "[1,2]")],
    }
    assert {r.conv_id: r.error for r in rejects.collect()} == dict.fromkeys((4, 8, 10, 11, 12, 14), "no mapping for this layout")
    same = spark.sql("SELECT 9L AS conv_id, 'p' AS prompt, 'r' AS response, array(named_struct('role', 'user', 'content', 'm')) AS messages, map('a', 1) AS extra")
    assert [(r.role, r.text) for r in chat_format.canonical_turns(same).orderBy("turn").collect()] == got[9]


def test_every_set_of_mappings_has_its_fingerprint():
    table = chat_format.resolved(chat_format.REGISTRY)
    for a in chat_format.LAYOUTS:
        assert table[chat_format.fingerprint(a.paths)] is a
        for b in chat_format.LAYOUTS:
            both = table[chat_format.fingerprint(sorted({*a.paths, *b.paths}))]
            assert len(both.paths) >= max(len(a.paths), len(b.paths))
    with pytest.raises(ValueError):
        chat_format.resolved({str(i): chat_format.Mapping_((str(i),), fields=()) for i in range(13)})


def test_layouts(spark):
    one = [("user", "q"), ("assistant", "a")]
    frames = [
        spark.sql("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response, 7 AS extra"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS instruction, '' AS input, 'a' AS output"),
        spark.sql("SELECT 1 AS conv_id, array(named_struct('role', 'user', 'content', 'q'), named_struct('role', 'assistant', 'content', 'a')) AS messages"),
        spark.sql("SELECT 1 AS conv_id, array(named_struct('from', 'human', 'value', 'q'), named_struct('from', 'gpt', 'value', 'a')) AS conversations"),
    ]
    for df in frames:
        assert [(r.role, r.text) for r in chat_format.canonical_turns(df).orderBy("turn").collect()] == one
    with pytest.raises(ValueError):
        chat_format.canonical_turns(spark.sql("SELECT 1 AS conv_id, 2 AS other"))
    texts = ['{"prompt": "q", "response": "a"}', '{"response": "a", "prompt": "q"}', '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
             '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', "not json", None, '{"x": 1}']
    turns, rejects = chat_format.variant_layouts(spark.createDataFrame(list(enumerate(texts)), "conv_id long, raw string"), "raw")
    rows = turns.orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.error) for r in rejects.orderBy("conv_id").collect()] == [(4, "not JSON"), (5, "null"), (6, "no mapping for this layout")]
    assert [(r.conv_id, r.role, r.text) for r in rows] == [(i, *t) for i in range(4) for t in one]
