"""Registered queries beyond the flagship (see catalog.py for the contract).

Naming: each query is named after the operator(s) of SURVEY section 2 it
exercises. Spark side first, DuckDB oracle in the decorator.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import bleu as bl
from quire.operators import order as od
from quire.operators import prep as pp
from quire.operators import rouge as rg
from quire.operators import vocab as vc
from quire.plans import sqlkit as S
from quire.plans.catalog import r6, register
from quire.plans.standins import instruction_pairs, preference_pairs, table

NL = chr(10)


def _round_all(df, keep):
    return df.select(*keep, *[r6(F.col(c)).alias(c) for c in df.columns if c not in keep])


# ============================================================ scoring (R) ===

def _rouge_sql_counts(h, r, metrics, exclusive=True):
    """SQL select-list items (name, hyp, ref, overlap) per metric."""
    out = []
    for m in metrics:
        if m == "rouge-l":
            out.append(("rouge_l", f"len({h})", f"len({r})", S.lcs(h, r)))
            continue
        n = int(m.split("-")[1])
        gh, gr = S.ngrams(h, n), S.ngrams(r, n)
        if exclusive:
            out.append((f"rouge_{n}", f"len(list_distinct({gh}))", f"len(list_distinct({gr}))", S.set_overlap(gh, gr)))
        else:
            out.append((f"rouge_{n}", f"len({gh})", f"len({gr})", S.multiset_overlap(gh, gr)))
    return out


def _rouge_sql(metrics, stats=("r", "p", "f"), exclusive=True, raw=False, lengths=False):
    items = _rouge_sql_counts("hw", "rw", metrics, exclusive)
    cnt = ", ".join(f"{h} AS {n}_h, {r} AS {n}_r, {o} AS {n}_o" for n, h, r, o in items)
    sel = []
    for n, *_ in items:
        if raw:
            sel += [f"{n}_h AS {n}_hyp", f"{n}_r AS {n}_ref", f"{n}_o AS {n}_overlap"]
        else:
            d = S.prf(f"{n}_h", f"{n}_r", f"{n}_o")
            sel += [f"round({d[s]}, 6) AS {n}_{s}" for s in stats]
    if lengths:
        sel += [f"{S.word_count('answer')} AS len_hyp", f"{S.word_count('query')} AS len_ref"]
    return f"""
WITH {S.INSTRUCTION_PAIRS},
w AS (SELECT conv_id, turn, answer, query, {S.words('answer')} AS hw, {S.words('query')} AS rw FROM instruction_pairs),
c AS (SELECT conv_id, turn, answer, query, {cnt} FROM w)
SELECT conv_id, turn, {', '.join(sel)} FROM c"""


def _pairs(spark, sf):
    return instruction_pairs(table(spark, sf, "conversations"))


@register("rouge_pairs", sql=_rouge_sql(["rouge-1", "rouge-2", "rouge-l"], lengths=True))
def rouge_pairs(spark, sf):
    """Per-pair ROUGE-1/2/L r, p, f and word counts."""
    p = _pairs(spark, sf).select("conv_id", "turn", "answer", "query")
    s = rg.score(p, "answer", "query", return_lengths=True)
    return _round_all(s.drop("answer", "query"), ["conv_id", "turn", "len_hyp", "len_ref"])


@register("rouge_multiset", sql=_rouge_sql(["rouge-1", "rouge-2", "rouge-3"], exclusive=False))
def rouge_multiset(spark, sf):
    """exclusive=False (multiset n-grams)."""
    p = _pairs(spark, sf).select("conv_id", "turn", "answer", "query")
    s = rg.score(p, "answer", "query", metrics=["rouge-1", "rouge-2", "rouge-3"], exclusive=False)
    return _round_all(s.drop("answer", "query"), ["conv_id", "turn"])


@register("rouge_raw", sql=_rouge_sql(["rouge-1", "rouge-2", "rouge-3", "rouge-4", "rouge-5", "rouge-l"], raw=True))
def rouge_raw(spark, sf):
    """Raw {hyp, ref, overlap} counts for ROUGE-1..5 and L."""
    p = _pairs(spark, sf).select("conv_id", "turn", "answer", "query")
    s = rg.score(p, "answer", "query", metrics=["rouge-1", "rouge-2", "rouge-3", "rouge-4", "rouge-5", "rouge-l"],
                 raw_results=True)
    return s.drop("answer", "query")


_avg_src = _rouge_sql(["rouge-1", "rouge-2", "rouge-l"], lengths=True)


@register("rouge_avg", sql=f"""
WITH s AS ({_avg_src})
SELECT metric, round(avg(r), 6) AS r, round(avg(p), 6) AS p, round(avg(f), 6) AS f FROM (
  SELECT 'rouge-1' AS metric, rouge_1_r AS r, rouge_1_p AS p, rouge_1_f AS f FROM s
  UNION ALL SELECT 'rouge-2', rouge_2_r, rouge_2_p, rouge_2_f FROM s
  UNION ALL SELECT 'rouge-l', rouge_l_r, rouge_l_p, rouge_l_f FROM s
  UNION ALL SELECT 'lengths', len_hyp, len_ref, NULL FROM s) t
GROUP BY metric""")
def rouge_avg(spark, sf):
    """A2 (+D6 fix): averages of every stat of every metric, plus the mean
    word counts (row 'lengths': r = hyp, p = ref)."""
    p = _pairs(spark, sf).select("conv_id", "turn", "answer", "query")
    s = rg.score(p, "answer", "query", return_lengths=True)
    long = rg.long_form(s, [], ["rouge-1", "rouge-2", "rouge-l"])
    lens = s.select(F.lit("lengths").alias("metric"), F.col("len_hyp").cast("double").alias("r"),
                    F.col("len_ref").cast("double").alias("p"), F.lit(None).cast("double").alias("f"))
    mean = rg.average(long.unionByName(lens), ["r", "p", "f"], ["metric"])
    return mean.select("metric", *[r6(F.col(c)).alias(c) for c in ("r", "p", "f")])


@register("bleu_pairs", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
c AS (SELECT conv_id, turn, answer, query, {S.bleu_counts('answer', 'query')} AS nd FROM instruction_pairs)
SELECT conv_id, turn, round({S.r4(S.bleu_from_counts('nd', 'answer', 'query') + ' * 100')}, 6) AS bleu_4 FROM c""")
def bleu_pairs(spark, sf):
    """Per-pair character BLEU-4 x100, rounded to 4 digits."""
    p = _pairs(spark, sf)
    return p.select("conv_id", "turn", r6(F.bround(bl.bleu4(F.col("answer"), F.col("query")) * 100, 4)).alias("bleu_4"))


@register("sentence_split", sql=f"""
SELECT doc_id, idx - 1 AS idx, s AS sentence FROM (
  SELECT doc_id, unnest({S.sentences('text')}) AS s, generate_subscripts({S.sentences('text')}, 1) AS idx
  FROM documents)""")
def sentence_split(spark, sf):
    """Sentence split of every document (one row per sentence)."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(tx.split_sentences(F.col("text"))).alias("idx", "sentence")) \
        .select("doc_id", F.col("idx").cast("long").alias("idx"), "sentence")


@register("segment_words", sql=f"""
SELECT conv_id, turn, {S.segment('text')} AS seg, {S.word_count(S.segment('text'))} AS n_words,
       len({S.norm_sentences('text')}) AS n_sentences
FROM conversations""")
def segment_words(spark, sf):
    """R12 + R2 + R10: default segmentation, sentence count, word count."""
    c = table(spark, sf, "conversations")
    seg = tx.segment(F.col("text"))
    return c.select("conv_id", "turn", seg.alias("seg"), tx.word_count(seg).alias("n_words"),
                    F.size(tx.normalise_sentences(tx.split_sentences(F.col("text")))).alias("n_sentences"))


# Benchmark passages against documents sharing an 8-gram
CONTAM_N = 8


@register("overlap_candidates", sql=f"""
WITH bw AS (SELECT item_id, {S.words('text')} AS w FROM benchmark),
dw AS (SELECT doc_id, {S.words('text')} AS w FROM documents),
bg AS (SELECT DISTINCT item_id, unnest({S.ngrams('w', CONTAM_N)}) AS g FROM bw),
dg AS (SELECT DISTINCT doc_id, unnest({S.ngrams('w', CONTAM_N)}) AS g FROM dw),
cand AS (SELECT DISTINCT item_id, doc_id FROM bg JOIN dg USING (g)),
sc AS (SELECT c.item_id, c.doc_id,
         len(list_distinct({S.ngrams('bw.w', 2)})) AS h, len(list_distinct({S.ngrams('dw.w', 2)})) AS r,
         {S.set_overlap(S.ngrams('bw.w', 2), S.ngrams('dw.w', 2))} AS o
       FROM cand c JOIN bw ON c.item_id = bw.item_id JOIN dw ON c.doc_id = dw.doc_id)
SELECT item_id, doc_id, round({S.prf('h', 'r', 'o')['r']}, 6) AS r, round({S.prf('h', 'r', 'o')['p']}, 6) AS p,
       round({S.prf('h', 'r', 'o')['f']}, 6) AS f
FROM sc""")
def overlap_candidates(spark, sf):
    """J4 -> J2: candidate pairs are found by an equi-join on the hashes of
    shared 8-grams (broadcast under a measured bound, hot grams split by salt
    beyond it; no cross product) and checked, then scored with ROUGE-2."""
    from quire.session import broadcast_if_small, cut_lineage
    b = table(spark, sf, "benchmark")
    d = table(spark, sf, "documents")
    cand = cut_lineage(rg.ngram_candidates(d, b, CONTAM_N, "doc_id", "item_id"))  # feeds three consumers
    # score only the candidate documents: n-grams of the rest are never built
    # (candidate ids are counted first: broadcast them so the document side
    # is filtered in place instead of being shuffled by doc_id)
    d = d.join(broadcast_if_small(cand.select("doc_id").distinct(), 10_000_000), "doc_id", "left_semi")
    seqs = (b.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("seq_id"), "text")
            .unionByName(d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("seq_id"), "text")))
    pairs = cand.select("item_id", "doc_id", F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("hyp_id"),
                        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("ref_id"))
    s = rg.pair_index_scores(seqs, pairs, n=2)
    return s.select("item_id", "doc_id", r6(F.col("r")).alias("r"), r6(F.col("p")).alias("p"), r6(F.col("f")).alias("f"))


# ======================================================= preparation (E/P) ===

def _hist_sql():
    blk = f"printf('[Round %d]{NL}问：%s{NL}答：%s{NL}', pair_idx, query, answer)"
    prev = ("list(struct_pack(t := turn, b := " + blk + ")) OVER (PARTITION BY conv_id ORDER BY turn "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return f"""
WITH {S.INSTRUCTION_PAIRS},
h AS (SELECT conv_id, turn, query, answer, pair_idx, {prev} AS hist FROM instruction_pairs),
p AS (SELECT conv_id, turn, query, pair_idx,
        coalesce(array_to_string(list_transform(list_sort(hist), lambda x: x.b), ''), '')
        || printf('[Round %d]{NL}问：%s{NL}答：', pair_idx, query) AS rendered FROM h)"""


@register("history_prompts", sql=_hist_sql() + """
SELECT conv_id, turn, 'Q: ' || rendered AS prompt_train,
       'Q: ' || CASE WHEN pair_idx = 0 THEN query ELSE rendered END AS prompt_eval
FROM p""")
def history_prompts(spark, sf):
    """W1 + E1 + E2 + P12: history-so-far window, rendered rounds, the
    train/eval difference, and a source prefix."""
    p = _pairs(spark, sf)
    return p.select("conv_id", "turn",
                    pp.build_prompt(F.col("query"), F.col("history"), "train", "Q: ").alias("prompt_train"),
                    pp.build_prompt(F.col("query"), F.col("history"), "eval", "Q: ").alias("prompt_eval"))


# Word-level stand-in tokenizer: fixed special ids, then the most frequent
# words of the conversation table.
SPECIALS = ["<pad>", "<unk>", "<mask>", "<bos>", "<eos>"]
PAD, UNK, MASK, BOS, EOS = range(5)
VOCAB_K = 3000


def conv_vocab(spark, sf, k=VOCAB_K):
    c = table(spark, sf, "conversations")
    top = vc.top_words(vc.word_freq(c, "text"), k)
    return vc.vocab_from_words(top, [F.desc("freq"), F.col("word")], SPECIALS)


def _ws_sql(t):
    st = f"regexp_replace({t}, {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g')"
    return f"(CASE WHEN length({st}) = 0 THEN []::VARCHAR[] ELSE regexp_split_to_array({st}, {S.lit(S.WS + '+')}) END)"


VOCAB_SQL = f"""
wf AS (SELECT w AS word, count(*) AS freq FROM (SELECT unnest({_ws_sql('text')}) AS w FROM conversations) GROUP BY w),
vocab AS (SELECT word AS piece, rk + {len(SPECIALS)} AS id FROM (
            SELECT word, row_number() OVER (ORDER BY freq DESC, word) - 1 AS rk FROM wf) WHERE rk < {VOCAB_K})"""


def _encode_sql(name, src, key, text):
    """CTE ``name``(key..., ids) encoding ``text`` of ``src`` by ``vocab``."""
    keys = ", ".join(key)
    return f"""
{name}_tok AS (SELECT {keys}, unnest({_ws_sql(text)}) AS piece, generate_subscripts({_ws_sql(text)}, 1) AS pos FROM {src}),
{name}_g AS (SELECT {', '.join('t.' + k for k in key)}, list(coalesce(v.id, {UNK}) ORDER BY t.pos) AS ids
             FROM {name}_tok t LEFT JOIN vocab v ON t.piece = v.piece GROUP BY {', '.join('t.' + k for k in key)}),
{name} AS (SELECT s.*, coalesce(g.ids, []::BIGINT[]) AS ids FROM {src} s LEFT JOIN {name}_g g USING ({keys}))"""


SRC_LEN, TGT_LEN = 48, 96


@register("train_examples", sql=_hist_sql() + f""",
pa AS (SELECT p.conv_id, p.turn, p.rendered AS prompt, ip.answer FROM p JOIN instruction_pairs ip USING (conv_id, turn)),
{VOCAB_SQL},
{_encode_sql('ea', 'pa', ['conv_id', 'turn'], 'prompt')},
{_encode_sql('eb', 'pa', ['conv_id', 'turn'], 'answer')},
lay AS (SELECT ea.conv_id, ea.turn,
          list_concat(ea.ids[1:{SRC_LEN - 1}], [{MASK}, {BOS}], eb.ids[1:{TGT_LEN - 2}], [{EOS}]) AS ids,
          len(ea.ids[1:{SRC_LEN - 1}]) + 1 AS ctx
        FROM ea JOIN eb USING (conv_id, turn)),
pad AS (SELECT conv_id, turn, ctx,
          list_concat(ids, list_transform(range({SRC_LEN + TGT_LEN} - len(ids)), lambda x: {PAD})) AS input_ids,
          list_transform(list_concat(list_transform(range(ctx), lambda x: -100), ids[ctx + 1:],
                         list_transform(range({SRC_LEN + TGT_LEN} - len(ids)), lambda x: {PAD})),
                         lambda l: CASE WHEN l = {PAD} THEN -100 ELSE l END) AS labels
        FROM lay)
SELECT conv_id, turn, ctx AS context_length, array_to_string(input_ids, ' ') AS input_ids,
       array_to_string(labels, ' ') AS labels FROM pad""")
def train_examples(spark, sf):
    """E3-E5 with J6/A14/T1: word vocabulary, encode, truncate, special
    layout, labels, right padding to S+T with label pads -> -100."""
    p = _pairs(spark, sf)
    p = p.select("conv_id", "turn", pp.build_prompt(F.col("query"), F.col("history"), "train").alias("prompt"), "answer")
    v = conv_vocab(spark, sf)
    ea = vc.encode(p, ["conv_id", "turn"], vc.ws_tokens("prompt"), v, UNK, "a_ids")
    eb = vc.encode(ea, ["conv_id", "turn"], vc.ws_tokens("answer"), v, UNK, "b_ids")
    ex = pp.build_example(F.col("a_ids"), F.col("b_ids"), SRC_LEN, TGT_LEN, MASK, BOS, EOS, PAD)
    return eb.select("conv_id", "turn", ex.alias("e")).select(
        "conv_id", "turn", F.col("e.context_length").alias("context_length"),
        F.array_join("e.input_ids", " ").alias("input_ids"), F.array_join("e.labels", " ").alias("labels"))


EVAL_BATCH = 8


@register("eval_examples", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
pa AS (SELECT conv_id, turn, query, answer,
              row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM instruction_pairs),
{VOCAB_SQL},
{_encode_sql('ea', 'pa', ['conv_id', 'turn'], 'query')},
{_encode_sql('eb', 'pa', ['conv_id', 'turn'], 'answer')},
x AS (SELECT ea.conv_id, ea.turn, ea.idx // {EVAL_BATCH} AS batch,
        list_concat(ea.ids[1:{SRC_LEN - 2}], [{MASK}, {BOS}]) AS p,
        list_transform(eb.ids[1:{TGT_LEN}], lambda l: CASE WHEN l = {PAD} THEN -100 ELSE l END) AS labels
      FROM ea JOIN eb USING (conv_id, turn)),
y AS (SELECT *, max(len(p)) OVER (PARTITION BY batch) AS width FROM x)
SELECT conv_id, turn, batch,
       array_to_string(list_concat(list_transform(range(width - len(p)), lambda k: {PAD}), p), ' ') AS input_ids,
       array_to_string(labels, ' ') AS labels, width - len(p) AS n_pad
FROM y""")
def eval_examples(spark, sf):
    """E6 (+E2 eval prompt = bare query on the first round): prompt
    truncated with specials, left-padded to the longest prompt of its batch
    (batch = dense index div 8, Q2/Q3); answer labels truncated, pad -> -100."""
    p = _pairs(spark, sf).select("conv_id", "turn", "query", "answer")
    p = od.with_row_index(p, ["conv_id", "turn"], name="idx").withColumn("batch", od.assign_batches("idx", EVAL_BATCH))
    v = conv_vocab(spark, sf)
    ea = vc.encode(p, ["conv_id", "turn"], vc.ws_tokens("query"), v, UNK, "a_ids")
    eb = vc.encode(ea, ["conv_id", "turn"], vc.ws_tokens("answer"), v, UNK, "b_ids")
    e = pp.eval_examples(eb, "a_ids", "b_ids", "batch", SRC_LEN, TGT_LEN, MASK, BOS, PAD)
    return e.select("conv_id", "turn", "batch", F.array_join("input_ids", " ").alias("input_ids"),
                    F.array_join("labels", " ").alias("labels"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + 1 - x).alias("n_pad"))


@register("reward_examples", sql=f"""
WITH {S.PREFERENCE_PAIRS},
{VOCAB_SQL},
t AS (SELECT pair_id, 'Question: ' || question || '{NL}{NL}Answer: ' || response_chosen AS tc,
             'Question: ' || question || '{NL}{NL}Answer: ' || response_rejected AS tr FROM preference_pairs),
{_encode_sql('ec', 't', ['pair_id'], 'tc')},
{_encode_sql('er', 't', ['pair_id'], 'tr')},
x AS (SELECT ec.pair_id, ec.ids[1:512] AS c, er.ids[1:512] AS r FROM ec JOIN er USING (pair_id)),
f AS (SELECT *, row_number() OVER (ORDER BY pair_id) - 1 AS idx FROM x
      WHERE len(c) > 0 AND len(c) <= 512 AND len(r) > 0 AND len(r) <= 512),
w AS (SELECT *, idx // 4 AS batch,
        CAST(ceil(max(len(c)) OVER (PARTITION BY idx // 4) / 8.0) * 8 AS BIGINT) AS wc,
        CAST(ceil(max(len(r)) OVER (PARTITION BY idx // 4) / 8.0) * 8 AS BIGINT) AS wr FROM f)
SELECT pair_id, batch, len(c) AS n_chosen, len(r) AS n_rejected, wc AS width_chosen, wr AS width_rejected,
       array_to_string(list_concat(c, list_transform(range(wc - len(c)), lambda k: {PAD})), ' ') AS input_ids_chosen,
       CAST(list_sum(list_concat(list_transform(c, lambda k: 1), list_transform(range(wc - len(c)), lambda k: 0))) AS BIGINT) AS mask_chosen,
       array_to_string(list_concat(r, list_transform(range(wr - len(r)), lambda k: {PAD})), ' ') AS input_ids_rejected
FROM w""")
def reward_examples(spark, sf):
    """P11 -> E7 -> P5 -> E8: 'Question/Answer' texts, encoded, cut to 512,
    masks of ones, length filter, then batch-max padding rounded up to a
    multiple of 8 (batches of 4 by dense index)."""
    pr = preference_pairs(table(spark, sf, "documents"), table(spark, sf, "labels"))
    t = pr.select("pair_id", pp.reward_text(F.col("question"), F.col("response_chosen")).alias("tc"),
                  pp.reward_text(F.col("question"), F.col("response_rejected")).alias("tr"))
    v = conv_vocab(spark, sf)
    e = vc.encode(t, ["pair_id"], vc.ws_tokens("tc"), v, UNK, "c")
    e = vc.encode(e, ["pair_id"], vc.ws_tokens("tr"), v, UNK, "r")
    x = e.select("pair_id", *pp.reward_example("q", "c", "r"))
    x = pp.filter_length(x, ["input_ids_chosen", "input_ids_rejected"], pp.REWARD_MAX_LEN)
    x = od.with_row_index(x, ["pair_id"], name="idx").withColumn("batch", od.assign_batches("idx", 4))
    x = x.withColumn("n_chosen", F.size("input_ids_chosen")).withColumn("n_rejected", F.size("input_ids_rejected"))
    col = pp.reward_collate(x, PAD, batch_col="batch", multiple_of=8)
    return col.select("pair_id", "batch", "n_chosen", "n_rejected",
                      F.size("input_ids_chosen").alias("width_chosen"), F.size("input_ids_rejected").alias("width_rejected"),
                      F.array_join("input_ids_chosen", " ").alias("input_ids_chosen"),
                      F.aggregate("attention_mask_chosen", F.lit(0), lambda a, m: a + m).cast("long").alias("mask_chosen"),
                      F.array_join("input_ids_rejected", " ").alias("input_ids_rejected"))


@register("alpaca_sharegpt", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
a AS (SELECT conv_id, turn, query AS instruction, answer AS output,
        CASE pair_idx % 3 WHEN 0 THEN '' WHEN 1 THEN ' x ' ELSE ' ' || string_split(answer, ' ')[1] || ' ' END AS inp
      FROM instruction_pairs)
SELECT conv_id, turn, 'human' AS from_0,
       CASE WHEN length(regexp_replace(inp, {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g')) > 1
            THEN instruction || '{NL}{NL}' || inp ELSE instruction END AS value_0,
       'gpt' AS from_1, output AS value_1
FROM a""")
def alpaca_sharegpt(spark, sf):
    """P10 (+P3 rename, P2 keep-only): alpaca (instruction, input, output)
    records -> ShareGPT conversations."""
    p = _pairs(spark, sf)
    inp = F.when(F.col("pair_idx") % 3 == 0, F.lit("")).when(F.col("pair_idx") % 3 == 1, F.lit(" x ")) \
        .otherwise(F.concat(F.lit(" "), F.split("answer", " ")[0], F.lit(" ")))
    a = p.select("conv_id", "turn", F.col("query").alias("instruction"), inp.alias("input"),
                 F.col("answer").alias("output"))
    conv = a.select("conv_id", "turn", pp.alpaca_to_sharegpt(F.col("instruction"), F.col("input"),
                                                            F.col("output")).alias("items"))
    conv = pp.rename_if_present(conv, "items", "conversations")
    return conv.select("conv_id", "turn", F.col("conversations")[0]["from"].alias("from_0"),
                       F.col("conversations")[0]["value"].alias("value_0"),
                       F.col("conversations")[1]["from"].alias("from_1"),
                       F.col("conversations")[1]["value"].alias("value_1"))


@register("complete_filter", sql="""
WITH t AS (
  SELECT conv_id, turn, role, text AS content,
         CASE WHEN lead(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'assistant'
              THEN lead(text) OVER (PARTITION BY conv_id ORDER BY turn) END AS summary
  FROM conversations WHERE role <> 'system')
SELECT conv_id, turn FROM t
WHERE role = 'user' AND content IS NOT NULL AND content <> '' AND summary IS NOT NULL AND summary <> ''""")
def complete_filter(spark, sf):
    """User turns with their answer or NULL; incomplete rows dropped."""
    from pyspark.sql import Window
    c = table(spark, sf, "conversations").where(F.col("role") != "system")
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = c.select("conv_id", "turn", "role", F.col("text").alias("content"),
                 F.when(F.lead("role").over(w) == "assistant", F.lead("text").over(w)).alias("summary"))
    return pp.filter_complete(t.where(F.col("role") == "user"), "content", "summary").select("conv_id", "turn")


@register("predictions", sql=f"""
WITH {S.INSTRUCTION_PAIRS}
SELECT regexp_replace(answer, {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g') AS labels,
       regexp_replace(query, {S.lit('^' + S.WS + '+|' + S.WS + '+$')}, '', 'g') AS predict
FROM instruction_pairs""")
def predictions(spark, sf):
    """{labels, predict} rows, both stripped."""
    from quire.operators.infer import predictions as pred
    return pred(_pairs(spark, sf), "answer", "query")
