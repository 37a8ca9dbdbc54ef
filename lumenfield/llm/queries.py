"""The registered queries of the text operators and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfield.llm import bpe, chat_format, chat_repair, fingerprint, hard_negatives, html_extract, language_id, mixing, packing, quality, simhash, token_output, toxicity
from lumenfield.llm.common import shared_path, ship_package, stash

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = toxicity.category_labels(table(spark, sf_dir, "labels"))
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", "p_low_quality", "p_toxic", "toxic")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    token_output.write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_output.read_token_ids(spark, path)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    profiles = language_id.fit_profiles(docs.filter(fold != 0))
    out = language_id.predict(docs.select("doc_id", "text", (fold == 0).alias("held_out")), profiles)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "path")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    layout = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = chat_format.canonical_turns(layout.unionByName(added))
    back = chat_format.read_back(stash(chat_format.format_chats(turns), "chats"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def sent_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, raw)``: the conversations as JSON in the layouts of several senders, by id, all with fields of their own; some without turns, and some in no known layout."""
    rows = table(spark, sf_dir, "conversations")
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("m"))
    own = F.struct(F.col("conv_id").alias("id"), F.array(F.lit("x")).alias("tags"))
    sent = lambda role, text, name: F.to_json(F.struct(F.transform("m", lambda x: F.struct(x["role"].alias(role), x["text"].alias(text), x["turn"].alias("name"), own.alias("more"))).alias(name), own.alias("meta"), F.lit(1).alias("version")))
    fields = lambda *names: F.to_json(F.struct(*(F.col("m")[i]["text"].alias(c) for i, c in enumerate(names)), F.lit("").alias("input"), own.alias("meta")))
    pair = (F.size("m") >= 2) & F.forall(F.slice("m", 1, 2), lambda x: x["text"] != "")
    by = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(9))
    raw = (
        F.when(by == 0, sent("role", "content", "messages")).when(by == 1, sent("from", "value", "conversations")).when(pair & (by == 2), fields("prompt", "response")).when(pair & (by == 3), fields("question", "answer"))
        .when(pair & (by == 4), fields("instruction", "output")).when(by == 5, '{"messages": [], "id": 7}').when(by == 6, '{"turns": 3, "meta": {"prompt": "p", "response": "r"}}').when(by == 7, "{broken")
    ).otherwise(sent("role", "content", "messages"))
    return whole.select("conv_id", raw.alias("raw"))


def chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fingerprints of their paths make of JSON rows of many senders: turns, and the rejects with why."""
    turns, rejects = chat_format.variant_layouts(sent_chats(spark, sf_dir), "raw")
    turns = turns.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha256"), F.lit(None).cast("string").alias("error"))
    return turns.unionByName(rejects.select("conv_id", "error"), allowMissingColumns=True)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_next(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *(f"quality_stats.{c}" for c in quality.BASE), "base_failed", "kept", "quality_score")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1)
    length = F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("length")
    return out.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    rows = stash(hard_negatives.usable(vectors), "vectors")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_repair.damaged(table(spark, sf_dir, "conversations"))
    reports = chat_repair.report(turns, "dropped")
    return chat_repair.repaired_digests(reports, chat_repair.repair(turns.filter("NOT dropped"), reports))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_token_output, op3_language, op4_html, op5_mixing, op6_chat_format, op7_simhash, op8_fingerprint, op9_bpe, op10_quality, op11_packing, op12_hard_negatives, op13_chat_repair, pipeline, chat_layouts)}

#: The others hash, fit or tokenize in ways that SQL doesn't have; tests hold them against brute force.
ORACLE_SQL = {
    "chat_layouts": """
        WITH placed AS (
            SELECT conv_id, coalesce(conv_id, 0) % 9 AS by_, row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) - 1 AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        ), pairs AS (
            SELECT conv_id, count(*) >= 2 AND count(*) FILTER (turn < 2 AND text = '') = 0 AS pair FROM placed GROUP BY conv_id
        ), p AS (
            SELECT placed.*, pair AND by_ IN (2, 3, 4) AS fields FROM placed JOIN pairs ON placed.conv_id IS NOT DISTINCT FROM pairs.conv_id
        )
        SELECT conv_id, turn, CASE WHEN NOT fields THEN CASE role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' ELSE role END WHEN turn = 0 THEN 'user' ELSE 'assistant' END AS role, sha256(text) AS text_sha256, NULL AS error
        FROM p WHERE by_ NOT IN (5, 6, 7) AND (NOT fields OR turn < 2)
        UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS BIGINT), NULL, NULL, CASE by_ WHEN 6 THEN 'no mapping for this layout' ELSE 'not JSON' END FROM p WHERE by_ IN (6, 7)
    """,
    "op6_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), marked AS (
            SELECT *, len(regexp_extract_all(text, '[<\[]\\*(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)')) AS n_escapes
            FROM rows
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(12 + length(role) + 1 + length(text) + n_escapes + 11) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q, row_number() OVER () AS uid
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT uid, generate_subscripts(q, 1) AS k, unnest(q) AS x FROM v
        ), scores AS (
            SELECT a.uid AS a, b.uid AS b, CAST(sum(a.x * b.x) AS BIGINT) AS score FROM parts a JOIN parts b ON a.k = b.k AND a.uid <> b.uid
            WHERE a.uid IN (SELECT uid FROM v WHERE vec_id % 50 = 0) GROUP BY ALL
        ), s AS (
            SELECT a, b, score, va.vec_id AS anchor_id, vb.vec_id AS vec_id, va.label = vb.label AS same FROM scores JOIN v va ON va.uid = a JOIN v vb ON vb.uid = b
        ), positives AS (
            SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, b) <= 5
        ), found AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id NULLS LAST, n.b) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
            FROM positives p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
    """,
    "op13_chat_repair": r"""
        WITH RECURSIVE hashed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ord(x)::BIGINT)),
                    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, j: xor(v >> 1, (v & 1) * 3988292384)))) % 20 AS k
            FROM conversations
        ), bad AS (
            SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed) WHERE k <> 0
        ), convs AS (
            SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)
        ), placed AS (
            SELECT c, turn, role, text, left(role, 1) AS i, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text)) AS p
            FROM bad JOIN convs ON bad.conv_id IS NOT DISTINCT FROM convs.conv_id
        ), r AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate' WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'fine' ELSE 'truncated' END AS fault
            FROM (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY p) > 1 AS again, lag(i) OVER (PARTITION BY c ORDER BY p) AS i0 FROM placed)
        ), counts AS (
            SELECT c, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (p > 1 AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n FROM r GROUP BY c
        ), back AS (
            SELECT c, n + 1 AS p, 0 AS b0, 4 AS b1, 2 AS b2, 0 AS b3 FROM counts
            UNION ALL
            SELECT c, p, least(a0, 2 + a2, 4 + a3), least(a1, 2 + a2, 4 + a3), least(a2, 2 + a3), least(a3, 2 + a2) FROM (
                SELECT r.c, r.p,
                    CASE WHEN f THEN 3 + b0 ELSE least(3 + b0, t + 2 + b2, CASE i WHEN 's' THEN t + b1 WHEN 'u' THEN t + b2 END) END AS a0,
                    CASE WHEN f THEN 3 + b1 ELSE least(3 + b1, t + 2 + b2, CASE i WHEN 'u' THEN t + b2 END) END AS a1,
                    CASE WHEN f THEN 3 + b2 ELSE least(3 + b2, t + 2 + b3, CASE i WHEN 'a' THEN t + b3 END) END AS a2,
                    CASE WHEN f THEN 3 + b3 ELSE least(3 + b3, t + 2 + b2, CASE i WHEN 'u' THEN t + b2 END) END AS a3
                FROM back JOIN (SELECT *, fault IN ('blank', 'duplicate') AS f, CAST(fault = 'truncated' AS INT) AS t FROM r) r ON r.c = back.c AND r.p = back.p - 1)
        ), costs AS (
            SELECT c, p, [b0, b1, b2, b3] AS b FROM back
        ), walk AS (
            SELECT c, CAST(1 AS BIGINT) AS p, 0 AS q, '' AS audit, CAST([] AS VARCHAR[]) AS said FROM counts
            UNION ALL
            SELECT c, CASE letter WHEN 'I' THEN p ELSE p + 1 END,
                CASE letter WHEN 'D' THEN q WHEN 'K' THEN CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE nq END, audit || letter,
                CASE letter WHEN 'D' THEN said WHEN 'K' THEN list_append(said, role || ':' || text) WHEN 'R' THEN list_append(said, them || ':' || text) ELSE list_append(said, them || ':') END
            FROM (
                SELECT w.c, w.p, w.q, w.audit, w.said, CASE WHEN w.q = 2 THEN 3 ELSE 2 END AS nq, CASE WHEN w.q = 2 THEN 'assistant' ELSE 'user' END AS them, r.i, r.role, r.text,
                    CASE WHEN r.p IS NOT NULL AND 3 + z.b[w.q + 1] = now.b[w.q + 1] THEN 'D' WHEN 2 + now.b[CASE WHEN w.q = 2 THEN 4 ELSE 3 END] = now.b[w.q + 1] THEN 'I'
                        WHEN r.p IS NULL THEN '' WHEN CASE w.q WHEN 0 THEN r.i IN ('s', 'u') WHEN 2 THEN r.i = 'a' ELSE r.i = 'u' END
                            AND CAST(fault = 'truncated' AS INT) + z.b[CASE r.i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END] = now.b[w.q + 1] THEN 'K' ELSE 'R' END AS letter
                FROM walk w JOIN costs now ON now.c = w.c AND now.p = w.p LEFT JOIN r ON r.c = w.c AND r.p = w.p LEFT JOIN costs z ON z.c = w.c AND z.p = w.p + 1) WHERE letter <> ''
        ), ends AS (
            SELECT c, arg_max(audit, length(audit)) AS audit, arg_max(said, length(audit)) AS said FROM walk GROUP BY c
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            CAST(coalesce(costs.b[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
        FROM convs LEFT JOIN counts USING (c) LEFT JOIN ends USING (c) LEFT JOIN costs ON costs.c = convs.c AND costs.p = 1
    """,
}
