"""Registered streaming queries (X1-X5): each drives a file stream over a
test table with ``availableNow`` into a sink under the shared checkpoint
folder, then returns the sink read back as a batch DataFrame (stream =
batch is the check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import bleu  # noqa: F401  (keeps import order stable)
from quire.plans.catalog import r6, register
from quire.plans.queries_runs import CHUNK, STOP, _length_scorer
from quire.streaming import streams as st


@register("stream_ingest", sql="""
SELECT conv_id, turn, 'Q: ' || text AS prompt FROM conversations
WHERE text IS NOT NULL AND text <> '' AND role IS NOT NULL AND role <> ''""")
def stream_ingest(spark, sf):
    """Stateless preparation (P4 + P12) of a conversation stream into a
    checkpointed parquet sink."""
    s = st.table_stream(spark, sf, "conversations")
    prepared = st.prepare_stream(s, "text", "role", "Q: ").select("conv_id", "turn", "prompt")
    out = st.scratch_dir(spark, "x1")
    st.run_available_now(prepared, out + "/data", out + "/ckpt")
    return spark.read.parquet(out + "/data")


@register("stream_scores", sql="""
SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS k, round(length(text) * 0.001 - 1.0, 6) AS score,
       ('0x' || substr(md5(CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)), 1, 8))::BIGINT % 3 AS shard
FROM conversations""")
def stream_scores(spark, sf):
    """X2 + Q8: a pluggable scorer (mapInPandas) on a stream, rows dealt to
    three shards by a hash of their key."""
    from quire.operators.infer import score_texts
    s = st.table_stream(spark, sf, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("k"), "text")
    scored = st.shard_stream(score_texts(s, "k", "text", _length_scorer), "k", 3)
    out = st.scratch_dir(spark, "x2")
    st.run_available_now(scored, out + "/data", out + "/ckpt")
    r = spark.read.parquet(out + "/data")
    return r.select("k", r6(F.col("score")).alias("score"), F.col("shard").cast("long"))


@register("stream_clear_segments", sql="""
WITH s AS (
  SELECT user_id, event_id, event_type = 'error' AS is_clear, event_type || ' ' || event_id AS text,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS segment
  FROM events WHERE NOT (value < 1.0))
SELECT user_id, event_id, segment,
       sum(CASE WHEN is_clear THEN 0 ELSE 1 END) OVER w::BIGINT AS history_len,
       md5(coalesce(string_agg(CASE WHEN is_clear THEN NULL ELSE text END, chr(10)) OVER w, '')) AS history_md5
FROM s WINDOW w AS (PARTITION BY user_id, segment ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def stream_clear_segments(spark, sf):
    """Per-user chat history as text in streaming state, reset by 'clear'
    ('error' events), empty inputs (value < 1) skipped; equals batch W2. Events
    may come late by 10,000 ids."""
    ev = st.table_stream(spark, sf, "events")
    text = F.when(~(F.col("value") < 1.0), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")))
    h = st.chat_history_stream(ev, text=text, is_clear=(F.col("event_type") == "error") & ~(F.col("value") < 1.0),
                               lateness=10_000)
    out = st.scratch_dir(spark, "x3")
    st.run_available_now(h, out + "/data", out + "/ckpt")
    r = st.latest(spark.read.parquet(out + "/data"), ["user_id", "event_id"])
    return r.select("user_id", "event_id", "segment", "history_len", F.md5("history").alias("history_md5"))


INTERVAL = 20


@register("stream_run_state", sql=f"""
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS v,
                  row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
g AS (SELECT user_id, i // {INTERVAL} AS interval, list(v ORDER BY event_id) AS xs, count(*) AS samples,
             max(CASE WHEN isnan(v) THEN NULL ELSE v END) AS top FROM e GROUP BY user_id, i // {INTERVAL}),
b AS (SELECT *, max(top) OVER (PARTITION BY user_id ORDER BY interval) AS best_value,
             list_reduce(list_zip(xs, range(0, len(xs))), lambda acc, x: CASE WHEN isnan(x[1])
                    THEN acc + acc / (1 + x[2]) ELSE acc + x[1] END, 0.0::DOUBLE) AS total FROM g),
f AS (SELECT user_id, v, min(event_id) AS best_step FROM e WHERE NOT isnan(v) GROUP BY user_id, v)
SELECT b.user_id, interval, samples, round(total / samples, 6) AS loss, round(best_value, 6) AS best_value, best_step
FROM b LEFT JOIN f ON b.user_id = f.user_id AND b.best_value = f.v""")
def stream_run_state(spark, sf):
    """X4 over whole runs: per run and 20 samples the loss by the NaN rule,
    and the best value so far with its step, in streaming state; 'error' events
    are NaN. Equals the batch W3, W4 and W5."""
    ev = st.table_stream(spark, sf, "events").withColumn(
        "v", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    out = st.scratch_dir(spark, "x4")
    st.run_available_now(st.run_state_stream(ev, "user_id", "event_id", "v", INTERVAL, lateness=10_000),
                         out + "/data", out + "/ckpt")
    r = st.latest(spark.read.parquet(out + "/data"), ["user_id", "interval"])
    return r.select("user_id", "interval", "samples", r6(F.col("loss")).alias("loss"),
                    r6(F.col("best_value")).alias("best_value"), "best_step")


@register("stream_run_monitor", sql="""
WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS v FROM events),
g AS (SELECT user_id, date_trunc('day', ts) AS w, list(v ORDER BY event_id) AS xs, count(*) AS samples,
             avg(CASE WHEN isnan(v) THEN NULL ELSE v END) AS mean_value, max(CASE WHEN isnan(v) THEN NULL ELSE v END) AS best_value
      FROM e GROUP BY user_id, date_trunc('day', ts)),
f AS (SELECT *, list_reduce(list_zip(xs, range(0, len(xs))), lambda acc, x: CASE WHEN isnan(x[1])
                    THEN acc + acc / (1 + x[2]) ELSE acc + x[1] END, 0.0::DOUBLE) AS total FROM g)
SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, samples, round(mean_value, 6) AS mean_value,
       round(best_value, 6) AS best_value, round(total / samples, 6) AS filtered_loss
FROM f""")
def stream_run_monitor(spark, sf):
    """X4 over every window, open ones included: the same monitor in update
    mode, the last version of each run and day read back."""
    ev = st.table_stream(spark, sf, "events").withColumn(
        "v", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    out = st.scratch_dir(spark, "x4")
    st.run_versions(st.run_monitor_stream(ev, "ts", "user_id", "v", step="event_id"), out + "/data", out + "/ckpt")
    r = st.latest(spark.read.parquet(out + "/data").drop("epoch"), ["user_id", "window_start"])
    return r.select("user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "samples",
                    *[r6(F.col(c)).alias(c) for c in ("mean_value", "best_value", "filtered_loss")])


@register("stream_batches", sql="""
WITH i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
SELECT doc_id, i // 21 AS "group", (i // 7) % 3 AS shard FROM i WHERE i < n // 21 * 21""")
def stream_batches(spark, sf):
    """Q8: a stream dealt to 3 workers in batches of 7; only the short last
    group of the whole stream is dropped."""
    d = st.table_stream(spark, sf, "documents").select("doc_id")
    out = st.scratch_dir(spark, "q8")
    st.dealt_stream(d, ["doc_id"], 3, 7, out + "/data", out + "/ckpt")
    return spark.read.parquet(out + "/data").select("doc_id", "group", F.col("shard").cast("long").alias("shard"))


@register("stream_chunks", sql=f"""
WITH c AS (SELECT doc_id, i AS seq, substring(text, i * {CHUNK} + 1, {CHUNK}) AS t
           FROM documents, LATERAL (SELECT unnest(range(0, CAST(ceil(length(text) / {CHUNK}.0) AS BIGINT))) AS i)),
g AS (SELECT doc_id, list(t ORDER BY seq) AS ts FROM c GROUP BY doc_id),
k AS (SELECT doc_id, ts, list_position(list_transform(ts, lambda x: contains(x, chr(10))), true) AS k FROM g)
SELECT doc_id AS request_id, CASE WHEN k IS NULL THEN array_to_string(ts, '')
                    ELSE array_to_string(ts[1:k - 1], '') || split_part(ts[k], chr(10), 1) END AS text
FROM k""")
def stream_chunks(spark, sf):
    """Generation chunks (40 characters of each document) assembled in
    streaming state until the stop string; equals batch I4."""
    d = st.table_stream(spark, sf, "documents")
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    chunks = (d.select("doc_id", pieces.alias("ts")).select("doc_id", F.size("ts").alias("n"), F.posexplode("ts").alias("seq", "t"))
              .withColumn("last", F.col("seq") == F.col("n") - 1))
    a = st.chunk_assembly_stream(chunks, STOP, key="doc_id", seq="seq", text="t", last="last")
    out = st.scratch_dir(spark, "x5")
    st.run_available_now(a, out + "/data", out + "/ckpt")
    return st.assembled(spark.read.parquet(out + "/data")).select("request_id", "text")
