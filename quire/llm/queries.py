"""The registered queries of the training-data operators: each applies its
operator, with production parameters, to the whole table and derives the
digest columns of its contract from the operator's output. ``ORACLES`` has
the DuckDB statement where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, chat, exact_dedup, langid, licenses, mixing, quality, repair, simhash, topk, toxicity, warc, whitening
from quire.llm.common import read, shared_dir, unpacked
from quire.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ----------------------------------------------------------- 1 exact top-k search

@register("op1_topk_search", sql="""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op1_topk_search(spark, sf):
    return topk.top_k(read(spark, sf, "embeddings"), lambda vec_id: vec_id % 50 == 0)


# --------------------------------------------------------------- 2 toxicity

@register("op2_toxicity")
def op2_toxicity(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    grammar = toxicity.learn(docs, read(spark, sf, "labels"))
    return toxicity.annotate(docs, grammar).select(
        F.col("row")["doc_id"].alias("doc_id"), toxicity.held_out(F.col("row")["doc_id"]).alias("held_out"),
        F.col("toxicity")["score"].alias("score"), (F.col("toxicity")["score"] >= 0.5).cast("int").alias("predicted"),
        F.size(F.col("toxicity")["matches"]).alias("n_clauses"))


# -------------------------------------------------- 3 BPE encoding, decoding

def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op3_bpe_codec")
def op3_bpe_codec(spark, sf, tokenizer_path: str | None = None):
    path = tokenizer_path or tokenizer_file()
    docs = read(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(F.col("row")["doc_id"].alias("doc_id"), *bpe.digests(coded))


# --------------------------------------------------------------- 4 licenses

@register("op4_license_scan")
def op4_license_scan(spark, sf):
    found = licenses.scan(read(spark, sf, "documents").select("doc_id", "text"))
    return found.select(F.col("row")["doc_id"].alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
                        "score", F.size("detections").alias("n_detections"))


# ------------------------------------------------------------------ 5 WARC

@register("op5_warc", sql="""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
      FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f""")
def op5_warc(spark, sf):
    return warc.round_trip(read(spark, sf, "pages")).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


# ------------------------------------------------------------ 6 exact dedup

@register("op6_exact_dedup", sql=r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
w AS (SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
             row_number() OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) = 1 AS kept FROM d)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM w""")
def op6_exact_dedup(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.annotate(docs).select(
        F.col("row")["doc_id"].alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


# ------------------------------------------------------- 7 chat formatting

CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register("op7_chat_format", sql=r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length('<s></s>') + length(role) + 1 + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 ELSE 0 END
             + length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)')) AS chars,
             CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned FROM c),
o AS (SELECT conv_id, role, lag(role, 1, '^') OVER w AS before, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
m AS (SELECT conv_id, CASE WHEN bool_and(before || '>' || role IN ('^>system', '^>user', 'system>user', 'user>assistant', 'assistant>user'))
                           THEN max(CASE WHEN last THEN CASE role WHEN 'system' THEN 'briefed' WHEN 'user' THEN 'asked' ELSE 'answered' END END)
                           ELSE 'refused' END AS state FROM o GROUP BY conv_id),
f AS (SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(length(learned))::BIGINT AS loss_chars, sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id)
SELECT f.*, state, state IN ('asked', 'answered') AS valid FROM f JOIN m USING (conv_id)""")
def op7_chat_format(spark, sf):
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                "conv_id long, turn long, role string, text string")
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(own)
    back = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (chat.format_chats(turns)
            .withColumns({"read": chat.read_turns(F.col("formatted")), "learned": chat.trained_text(F.col("segments"))})
            .withColumn("back", back)
            .select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(F.col("back").cast("binary"), 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "state", "valid"))


# ------------------------------------------------------- 8 SimHash near-dedup

@register("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, sf):
    found = simhash.annotate(read(spark, sf, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"),
                        "component_id")


# ------------------------------------------- 9 mixing sources to target weights

@register("op9_mixing")
def op9_mixing(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    mixed, rates = mixing.mix(docs, mixing.domains_of(read(spark, sf, "labels")))
    totals = [F.lit(float(x[k])).alias(f"{name}_{d}") for name, x in (("aim", rates.aim), ("reached", rates.reached))
              for k, d in enumerate(mixing.DOMAINS)]
    return mixed.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"),
                        *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)], "rate", "copies",
                        *totals, F.lit(rates.converged).alias("converged"))


# --------------------------------------------------------- 10 quality classifier

@register("op10_quality")
def op10_quality(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = quality.learn(docs, quality.grades_of(read(spark, sf, "labels")))
    return quality.annotate(docs, model).select(
        F.col("row")["doc_id"].alias("doc_id"), F.col("rated")["expected_grade"].alias("expected_grade"),
        F.col("rated")["tail"].alias("tail_probability"), (F.col("rated")["tail"] >= 0.5).alias("kept"))


# ------------------------------------------------------------ 11 language ID

@register("op11_language_id")
def op11_language_id(spark, sf):
    docs = read(spark, sf, "documents")
    model = langid.learn(docs)
    return langid.annotate(docs.select("doc_id", "text"), model).select(
        F.col("row")["doc_id"].alias("doc_id"), langid.held_out(F.col("row")["doc_id"]).alias("held_out"),
        F.col("found")["lang"].alias("lang_pred"), F.col("found")["score"].alias("score"),
        F.array_join(F.col("found")["languages"], ",").alias("languages"))


# ----------------------------------------- 12 conversation structure repair

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of op12, damaged by a checksum of conversation and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    action = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return (conversations.select(
        "conv_id", "turn", action.alias("action"),
        F.when(action == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(action == 1, F.lit("")).when(action == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
        .where("action <> 0")
        .withColumn("again", F.explode(F.when(F.col("action") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("action", "again"))


@register("op12_structure_repair")
def op12_structure_repair(spark, sf):
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.summaries(damaged(turns)).withColumnRenamed("conv_id", "found_id").withColumn("found", F.lit(True))
    every = turns.select("conv_id").distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


# -------------------------------------------------------- 13 embedding whitening

@register("op13_whitening")
def op13_whitening(spark, sf):
    found = whitening.whiten(read(spark, sf, "embeddings").select("vec_id", "embedding"))
    return found.select(F.col("row")["vec_id"].alias("vec_id"), "component", "n", "deviation", "whitened", "explained",
                        "identity_error", "residual")
