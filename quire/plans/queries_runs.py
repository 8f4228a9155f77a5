"""Registered queries: reward metrics (A3-A7, A11, J5, J7, I1, I2), run-log
analytics (A8-A10, A12, A13, W2-W5, F12) and generation surface (I3, I4,
E9-E13, section 2.12 transcript HTML)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import arrays as ar
from quire.functions import text as tx
from quire.operators import infer as inf
from quire.operators import prep as pp
from quire.operators import reward as rw
from quire.operators import runs as rn
from quire.plans import sqlkit as S
from quire.plans.catalog import r6, register
from quire.plans.queries_more import _pairs
from quire.plans.standins import preference_pairs, table
from quire.session import cut_lineage
from quire.sources import sinks as sk
from quire.streaming.streams import scratch_dir

NL = chr(10)


def _prefs(spark, sf):
    return preference_pairs(table(spark, sf, "documents"), table(spark, sf, "labels"))


# ---------------------------------------------------------------- reward ---

@register("reward_metrics", sql=f"""
WITH {S.PREFERENCE_PAIRS},
a AS (SELECT avg((score_chosen - score_rejected) ^ 2) AS mse, avg(abs(score_chosen - score_rejected)) AS mae,
             avg(greatest(0.0, -(score_chosen - score_rejected) + 1.0)) AS margin_loss,
             avg((score_chosen - score_rejected) ^ 2) AS contrastive, count(*) AS n_pairs FROM preference_pairs)
SELECT round(mse, 6) AS mse, round(mae, 6) AS mae, round(margin_loss, 6) AS margin_loss,
       round(contrastive, 6) AS contrastive, round(0.3 * margin_loss + 0.7 * contrastive, 6) AS loss,
       round(exp(0.3 * margin_loss + 0.7 * contrastive), 6) AS perplexity, n_pairs FROM a""")
def reward_metrics(spark, sf):
    """Mse, mae, margin ranking loss, contrastive term, mixed loss,
    perplexity over the preference pairs' scores."""
    p = _prefs(spark, sf).select(F.col("score_chosen").alias("chosen"), F.col("score_rejected").alias("rejected"))
    m = rw.reward_metrics(p)
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns if c != "n_pairs"], "n_pairs")


@register("reward_pair_join", sql=f"""
WITH {S.PREFERENCE_PAIRS},
l AS (SELECT pair_id, 'chosen' AS side, score_chosen AS score FROM preference_pairs
      UNION ALL SELECT pair_id, 'rejected', score_rejected FROM preference_pairs)
SELECT pair_id, round(max(CASE WHEN side = 'chosen' THEN score END), 6) AS chosen,
       round(max(CASE WHEN side = 'rejected' THEN score END), 6) AS rejected FROM l GROUP BY pair_id""")
def reward_pair_join(spark, sf):
    """Long (pair, side, score) -> chosen and rejected side by side."""
    p = _prefs(spark, sf)
    long = p.select("pair_id", F.lit("chosen").alias("side"), F.col("score_chosen").alias("score")).unionByName(
        p.select("pair_id", F.lit("rejected").alias("side"), F.col("score_rejected").alias("score")))
    j = rw.pair_scores(long)
    return j.select("pair_id", r6(F.col("chosen")).alias("chosen"), r6(F.col("rejected")).alias("rejected"))


@register("preference_from_predictions", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
pr AS (SELECT conv_id, turn, query, answer,
         coalesce(lag(answer) OVER (PARTITION BY conv_id ORDER BY turn), '') AS predict FROM instruction_pairs)
SELECT conv_id, turn, query AS question, answer AS response_chosen, predict AS response_rejected FROM pr""")
def preference_from_predictions(spark, sf):
    """(question, gold answer = chosen, model answer = rejected); the
    stand-in model answer is the previous answer of the conversation."""
    p = _pairs(spark, sf)
    w = Window.partitionBy("conv_id").orderBy("turn")
    preds = p.select("conv_id", "turn", F.col("query").alias("question"), F.col("answer").alias("label"),
                     F.coalesce(F.lag("answer").over(w), F.lit("")).alias("predict"))
    out = rw.preference_from_predictions(preds.withColumn("row_id", F.struct("conv_id", "turn")), "row_id")
    return out.select(F.col("row_id.conv_id").alias("conv_id"), F.col("row_id.turn").alias("turn"),
                      "question", "response_chosen", "response_rejected")


def _length_scorer():
    """Stand-in reward model: a linear function of the text length."""
    def score(texts: pd.Series) -> pd.Series:
        return texts.str.len() * 0.001 - 1.0
    return score


@register("score_pairs_linear", sql=f"""
WITH {S.PREFERENCE_PAIRS}
SELECT pair_id, round(length(response_chosen) * 0.001 - 1.0, 6) AS chosen,
       round(length(response_rejected) * 0.001 - 1.0, 6) AS rejected FROM preference_pairs""")
def score_pairs_linear(spark, sf):
    """I2 (+I1 surface): each side scored once by a pluggable model inside
    mapInPandas, pairs re-joined (J7)."""
    p = _prefs(spark, sf).select("pair_id", F.col("response_chosen").alias("text_chosen"),
                                 F.col("response_rejected").alias("text_rejected"))
    s = inf.score_pairs(p, _length_scorer)
    return s.select("pair_id", r6(F.col("chosen")).alias("chosen"), r6(F.col("rejected")).alias("rejected"))


def _lse_sql(e: str) -> str:
    return f"(list_max({e}) + ln(list_sum(list_transform({e}, lambda x: exp(x - list_max({e}))))))"


@register("quality_softmax", sql=f"""
SELECT vec_id, round(exp(CAST(embedding[2] AS DOUBLE) - {_lse_sql('CAST(embedding AS DOUBLE[])')}), 6) AS quality
FROM embeddings""")
def quality_softmax(spark, sf):
    """quality = softmax(logits)[1] with the logits in the embedding."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", r6(inf.quality(F.col("embedding"))).alias("quality"))


@register("reward_weighted_logprob", sql=f"""
WITH e AS (SELECT CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
t AS (SELECT list_avg(list_transform(v, lambda x: x - {_lse_sql('v')})) * label AS term FROM e)
SELECT round(-0.1 * avg(term), 6) AS weighted_logprob, count(*) AS n FROM t""")
def reward_weighted_logprob(spark, sf):
    """A11 (D1 fixed: each row's score weights its own log-probabilities):
    -0.1 * mean(mean(log_softmax(logits)) * score), score = label."""
    e = table(spark, sf, "embeddings")
    term = ar.mean(ar.log_softmax(F.col("embedding"))) * F.col("label")
    return e.agg(r6(F.lit(-0.1) * F.avg(term)).alias("weighted_logprob"), F.count(F.lit(1)).alias("n"))


@register("vector_contrastive", sql="""
WITH a AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT x.vec_id, list_sum(list_transform(list_zip(x.v, y.v), lambda t: (t[1] - t[2]) ^ 2)) AS d2
      FROM a x JOIN a y ON y.vec_id = x.vec_id + 1 WHERE x.vec_id % 2 = 0)
SELECT round(avg(d2), 6) AS contrastive, round(avg(sqrt(d2)), 6) AS mean_distance, count(*) AS n_pairs FROM p""")
def vector_contrastive(spark, sf):
    """A5 vector form + L2 norm: squared distance of paired vectors
    (vec 2k vs 2k+1), element-wise via zip_with + aggregate."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    x = e.where(F.col("vec_id") % 2 == 0).select(F.col("vec_id").alias("k"), F.col("embedding").alias("c"))
    y = e.select((F.col("vec_id") - 1).alias("k"), F.col("embedding").alias("r"))
    j = x.join(y, "k").select(rw.vector_contrastive(F.col("c").cast("array<double>"),
                                                     F.col("r").cast("array<double>")).alias("d2"))
    return j.agg(r6(F.avg("d2")).alias("contrastive"), r6(F.avg(F.sqrt("d2"))).alias("mean_distance"),
                 F.count(F.lit(1)).alias("n_pairs"))


# ---------------------------------------------------------------- runs ---

@register("eval_loss_mean", sql="""
SELECT user_id, round(sum(value * ((event_id % 4) + 1)) / sum((event_id % 4) + 1), 6) AS eval_loss
FROM events GROUP BY user_id""")
def eval_loss_mean(spark, sf):
    """Batch losses (value) weighted by their real rows (1-4)."""
    ev = table(spark, sf, "events").withColumn("rows", (F.col("event_id") % 4) + 1)
    m = rn.row_weighted_mean(ev, "value", "rows", ["user_id"])
    return m.select("user_id", r6(F.col("eval_loss")).alias("eval_loss"))


@register("eval_by_dataset", sql="""
WITH a AS (SELECT source, avg(n_chars) AS mean_chars, count(*) AS examples FROM documents GROUP BY source)
SELECT 'eval_' || source || '_mean_chars' AS name, round(mean_chars, 6) AS value FROM a
UNION ALL SELECT 'eval_' || source || '_examples', CAST(examples AS DOUBLE) FROM a""")
def eval_by_dataset(spark, sf):
    """A9 + F12: metrics per named dataset (source) as prefixed rows."""
    d = table(spark, sf, "documents")
    a = d.groupBy("source").agg(F.avg("n_chars").alias("mean_chars"), F.count(F.lit(1)).alias("examples"))
    long = rn.prefixed_metrics(a, "source", ["mean_chars", "examples"])
    return long.select("name", r6(F.col("value")).alias("value"))


@register("metrics_prefix", sql="""
SELECT user_id, 'test_' || k AS metric, round(v, 6) AS value FROM (
  SELECT user_id, 'mean' AS k, avg(value) AS v FROM events GROUP BY user_id
  UNION ALL SELECT user_id, 'max', max(value) FROM events GROUP BY user_id)""")
def metrics_prefix(spark, sf):
    """F12 map form: a metrics map per user with every key prefixed
    (transform_keys), exploded to rows."""
    ev = table(spark, sf, "events").groupBy("user_id").agg(
        F.create_map(F.lit("mean"), F.avg("value"), F.lit("max"), F.max("value")).alias("m"))
    pref = ev.select("user_id", rn.metrics_map_prefix(F.col("m"), "test").alias("m"))
    return pref.select("user_id", F.explode("m").alias("metric", "value")).select(
        "user_id", "metric", r6(F.col("value")).alias("value"))


@register("count_examples", sql="""
SELECT 'documents' AS dataset, least(count(*), 500) AS n FROM documents
UNION ALL SELECT 'conversations', least(count(*), 500) FROM conversations
UNION ALL SELECT 'events', least(count(*), 500) FROM events""")
def count_examples(spark, sf):
    """A10: observed counts capped by max_samples = 500."""
    parts = [table(spark, sf, t).agg(rn.capped_count(None, 500).alias("n")).select(F.lit(t).alias("dataset"), "n")
             for t in ("documents", "conversations", "events")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("throughput", sql="""
WITH a AS (SELECT user_id, count(*) AS samples,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS runtime FROM events GROUP BY user_id)
SELECT user_id, samples, round(runtime, 6) AS runtime, CAST(ceil(samples / 8.0) AS BIGINT) AS steps,
       round(CASE WHEN runtime > 0 THEN samples / runtime END, 6) AS samples_per_second,
       round(CASE WHEN runtime > 0 THEN ceil(samples / 8.0) / runtime END, 6) AS steps_per_second
FROM a""")
def throughput(spark, sf):
    """Samples, runtime, steps (batch 8) and rates per run (user)."""
    t = rn.throughput(table(spark, sf, "events"), "user_id", "ts", 8)
    return t.select("user_id", "samples", r6(F.col("runtime")).alias("runtime"), F.col("steps").cast("long"),
                    r6(F.col("samples_per_second")).alias("samples_per_second"),
                    r6(F.col("steps_per_second")).alias("steps_per_second"))


@register("best_trial", sql="""
WITH t AS (SELECT user_id, avg(value) AS objective FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT arg_min(user_id, (objective, user_id)) AS best_trial, round(min(objective), 6) AS best_objective FROM t""")
def best_trial(spark, sf):
    """Best (lowest) objective over trials, ties to the lower id."""
    t = table(spark, sf, "events").where(F.col("event_type") == "purchase").groupBy("user_id") \
        .agg(F.avg("value").alias("objective"))
    b = rn.best_trial(t, "user_id", "objective", "minimize")
    return b.select("best_trial", r6(F.col("best_objective")).alias("best_objective"))


@register("clear_segments", sql="""
SELECT event_id, user_id,
       sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS segment
FROM events WHERE NOT (value < 1.0)""")
def clear_segments(spark, sf):
    """W2: 'error' events act as the clear command, values below 1 as
    empty inputs (skipped); segment = clears so far per user."""
    ev = table(spark, sf, "events")
    s = rn.clear_segments(ev, "user_id", "event_id", F.col("event_type") == "error", F.col("value") < 1.0)
    return s.select("event_id", "user_id", F.col("segment").cast("long"))


def _steps_sql():
    return "SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM events"


def _steps(spark, sf):
    from quire.operators.order import with_row_index
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return with_row_index(ev, ["event_id"], ["user_id"], name="step").withColumn("step", (F.col("step") + 1).cast("int"))


@register("interval_loss", sql=f"""
WITH s AS ({_steps_sql()})
SELECT user_id, CAST(ceil(step / 10.0) AS BIGINT) AS interval, {S.r4('avg(value)')} AS loss, max(step) AS step,
       count(*) AS steps
FROM s GROUP BY user_id, CAST(ceil(step / 10.0) AS BIGINT)""")
def interval_loss(spark, sf):
    """Per run (user) mean loss of every 10-step logging interval."""
    return rn.interval_loss(_steps(spark, sf), "user_id", "step", "value", 10)


@register("nan_interval", sql=f"""
WITH s AS ({_steps_sql()}),
g AS (SELECT user_id, CAST(ceil(step / 10.0) AS BIGINT) AS interval,
        list(CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END ORDER BY step) AS xs
      FROM s GROUP BY user_id, CAST(ceil(step / 10.0) AS BIGINT)),
f AS (SELECT user_id, interval, len(xs) AS steps,
        list_reduce(list_zip(xs, range(0, len(xs))), lambda acc, x: CASE WHEN isnan(x[1]) OR isinf(x[1])
                    THEN acc + acc / (1 + x[2]) ELSE acc + x[1] END, 0.0::DOUBLE) AS running_sum FROM g)
SELECT user_id, interval, round(running_sum, 6) AS running_sum, steps, {S.r4('running_sum / steps')} AS loss FROM f""")
def nan_interval(spark, sf):
    """NaN/inf steps ('error' events) add running_sum / (1 + steps
    since the last log) instead of their loss."""
    s = _steps(spark, sf).withColumn(
        "loss", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    out = rn.nan_filtered_interval(s, "user_id", "step", "loss", 10)
    return out.select("user_id", "interval", r6(F.col("running_sum")).alias("running_sum"),
                      F.col("steps").cast("long"), "loss")


@register("best_so_far", sql=f"""
WITH s AS (SELECT user_id, step, CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS m
           FROM ({_steps_sql()})),
f AS (SELECT *, first_value(isnan(m)) OVER (PARTITION BY user_id ORDER BY step) AS first_nan,
        max(CASE WHEN isnan(m) THEN NULL ELSE m END) OVER (PARTITION BY user_id ORDER BY step
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM s),
n AS (SELECT *, CASE WHEN first_nan THEN step = 1
                     ELSE NOT isnan(m) AND (prev IS NULL OR m > prev) END AS nb FROM f)
SELECT user_id, step,
       max(CASE WHEN nb THEN step END) OVER (PARTITION BY user_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_step
FROM n""")
def best_so_far(spark, sf):
    """Running best (greater is better), strict, first wins ties; the
    metric of 'error' events is NaN."""
    s = _steps(spark, sf).withColumn(
        "m", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    b = rn.best_so_far(s, "user_id", "step", "m", True)
    return b.select("user_id", F.col("step").cast("long"), F.col("best_step").cast("long"))


# --------------------------------------------------- generation surface ---

@register("html_transcript", sql=f"""
WITH l AS (SELECT conv_id, turn, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM conversations),
f AS (SELECT conv_id, turn, ls,
        list_transform(range(1, len(ls) + 1), lambda i: len(list_filter(ls[1:i], lambda x: contains(x, '```')))) AS cnt
      FROM l),
r AS (SELECT conv_id, turn, list_transform(range(1, len(ls) + 1), lambda i:
        CASE WHEN contains(ls[i], '```') THEN
               CASE WHEN cnt[i] % 2 = 1 THEN '<pre><code class="language-' || string_split(ls[i], '`')[-1] || '">'
                    ELSE '<br></code></pre>' END
             WHEN i > 1 THEN '<br>' || CASE WHEN cnt[i] % 2 = 1 THEN
               replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(ls[i],
               '`', '\\`'), '<', '&lt;'), '>', '&gt;'), ' ', '&nbsp;'), '*', '&ast;'), '_', '&lowbar;'), '-', '&#45;'),
               '.', '&#46;'), '!', '&#33;'), '(', '&#40;'), ')', '&#41;'), '$', '&#36;') ELSE ls[i] END
             ELSE ls[i] END) AS out FROM f)
SELECT conv_id, turn, array_to_string(out, '') AS html FROM r""")
def html_transcript(spark, sf):
    """Section 2.12 render_transcript_html over every turn."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.render_transcript_html(F.col("text")).alias("html"))


CHUNK, STOP = 40, NL


@register("chunk_assembly", sql=f"""
WITH c AS (SELECT doc_id, i AS seq, substring(text, i * {CHUNK} + 1, {CHUNK}) AS t
           FROM documents, LATERAL (SELECT unnest(range(0, CAST(ceil(length(text) / {CHUNK}.0) AS BIGINT))) AS i)),
g AS (SELECT doc_id, list(t ORDER BY seq) AS ts FROM c GROUP BY doc_id),
k AS (SELECT doc_id, ts, list_position(list_transform(ts, lambda x: contains(x, chr(10))), true) AS k FROM g)
SELECT doc_id, CASE WHEN k IS NULL THEN array_to_string(ts, '')
                    ELSE array_to_string(ts[1:k - 1], '') || split_part(ts[k], chr(10), 1) END AS text
FROM k""")
def chunk_assembly(spark, sf):
    """I4: documents streamed as 40-character chunks; assembled up to the
    first chunk holding the stop string (newline), cut there."""
    d = table(spark, sf, "documents")
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    chunks = d.select("doc_id", F.posexplode(pieces).alias("seq", "t"))
    return inf.assemble_chunks(chunks, "doc_id", "seq", "t", STOP)


def _echo():
    def gen(prompts: pd.Series) -> pd.Series:
        return prompts
    return gen


@register("generate_echo", sql=f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
p AS (SELECT conv_id, turn, 'SYSTEM{NL}' || 'USER: ' || text || '{NL}' || 'ASSISTANT:' AS prompt FROM u)
SELECT conv_id, turn, prompt AS "Input",
       regexp_replace(split_part(prompt, 'ASSISTANT', 1), {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g') AS "Output"
FROM p""")
def generate_echo(spark, sf):
    """I3 + E13: every user turn rendered with a chat template (system,
    roles, separator), sent to a pluggable generator (an echo model here),
    cut at the stop string and stripped -> {Input, Output}."""
    u = table(spark, sf, "conversations").where(F.col("role") == "user")
    msgs = F.array(F.struct(F.col("text").alias("q"), F.lit("").alias("a")))
    p = u.select("conv_id", "turn",
                 pp.render_chat(msgs, "SYSTEM", ("USER", "ASSISTANT"), NL).alias("prompt"))
    return inf.generate(p, ["conv_id", "turn"], "prompt", _echo, stop="ASSISTANT")


@register("generate_resumed", sql=f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')
SELECT conv_id, turn, text AS "Input",
       regexp_replace(split_part(text, '?', 1), {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g') AS "Output"
FROM u""")
def generate_resumed(spark, sf):
    """I3 with committed slices: a first job generates the turns below the
    fifth, a second one with the same folder goes on with all user turns and
    generates only what is not there."""
    u = table(spark, sf, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
    out = scratch_dir(spark, "i3")
    inf.generate_resumable(u.where("turn < 5"), ["conv_id", "turn"], "text", _echo, out, slices=4, stop="?")
    return inf.generate_resumable(u, ["conv_id", "turn"], "text", _echo, out, slices=4, stop="?")


@register("metrics_written", sql="""
WITH m AS (SELECT source, avg(n_chars) AS mean_chars, count(*) AS examples FROM documents GROUP BY source)
SELECT 'run-' || run AS run, split, split || '_' || source || '_' || k AS metric, round(v, 6) AS value
FROM (SELECT source, 'mean_chars' AS k, mean_chars AS v FROM m UNION ALL SELECT source, 'examples', examples FROM m),
     (SELECT unnest(['1', '2']) AS run), (SELECT unnest(['eval', 'test']) AS split)""")
def metrics_written(spark, sf):
    """metrics of two runs and two splits written one after the other,
    one of them twice, and read back: every row once."""
    d = table(spark, sf, "documents").groupBy("source").agg(
        F.avg("n_chars").alias("mean_chars"), F.count(F.lit(1)).cast("double").alias("examples"))
    rows = d.select(F.explode(F.array(*[
        F.struct(F.concat_ws("_", "source", F.lit(c)).alias("metric"), F.col(c).alias("value"))
        for c in ("mean_chars", "examples")])).alias("m")).select("m.*")
    rows, out = cut_lineage(rows), scratch_dir(spark, "f12")
    for run, split in [("run-1", "eval"), ("run-1", "test"), ("run-2", "eval"), ("run-2", "test"), ("run-1", "eval")]:
        sk.write_metrics(rows, out, run, split)
    return sk.read_metrics(spark, out).withColumn("value", r6(F.col("value")))


@register("token_layout", sql="""
WITH a AS (SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: length(w)) AS ids FROM conversations),
b AS (SELECT conv_id, turn, ids,
        CASE WHEN len(ids) > 20 THEN ids[len(ids) - 20 + 1:] ELSE ids END AS last20,
        ids[4:] AS gen_wo_prompt,
        list_transform(ids, lambda x: CASE WHEN x % 5 = 0 THEN -100 ELSE x END) AS masked FROM a)
SELECT conv_id, turn, array_to_string(last20, ' ') AS last_tokens,
       array_to_string(list_concat(gen_wo_prompt, list_transform(range(greatest(300 - len(gen_wo_prompt), 0)), lambda k: 0)), ' ') AS stripped,
       array_to_string(list_transform(masked, lambda x: CASE WHEN x = -100 THEN 0 ELSE x END), ' ') AS unmasked
FROM b""")
def token_layout(spark, sf):
    """E11 keep-last-k, E12 strip the prompt ids then pad, E9 -100 -> pad,
    on integer arrays derived from every turn (word lengths as ids)."""
    c = table(spark, sf, "conversations")
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    a = c.select("conv_id", "turn", ids.alias("ids"))
    masked = F.transform("ids", lambda x: F.when(x % 5 == 0, F.lit(-100)).otherwise(x))
    return a.select("conv_id", "turn",
                    F.array_join(pp.keep_last(F.col("ids"), 20), " ").alias("last_tokens"),
                    F.array_join(pp.strip_prompt(F.col("ids"), 3, 300, 0), " ").alias("stripped"),
                    F.array_join(pp.mask_to_pad(masked, 0), " ").alias("unmasked"))
