"""Registered queries: file readers over files written from the test tables
(F2, F4-F7), column and length filters whose bounds bite (P2, P5, P6), set
and multiset unions (U3), padding to the fixed width (E8), the join of
predictions with their prompts (J5) and the default objective (A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import order as od
from quire.operators import prep as pp
from quire.operators import reward as rw
from quire.operators import runs as rn
from quire.operators import vocab as vc
from quire.plans import sqlkit as S
from quire.plans.catalog import r6, register
from quire.plans.queries_more import _ws_sql
from quire.plans.standins import table
from quire.session import cut_lineage
from quire.sources import files as fs
from quire.sources import sinks as sk
from quire.streaming.streams import scratch_dir


@register("read_splits", sql="""
SELECT conv_id, turn, text, CASE conv_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split
FROM conversations""")
def read_splits(spark, sf):
    """three splits written as JSON lines, CSV and Parquet, read back
    with the format of each file's own extension."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    out, kind = scratch_dir(spark, "f2"), "conv_id long, turn long, text string"
    sk.write_jsonl(c.where("conv_id % 3 = 0"), out + "/train.json")
    c.where("conv_id % 3 = 1").write.option("header", True).option("escape", '"').option("quoteAll", True) \
        .csv(out + "/validation.csv")
    c.where("conv_id % 3 = 2").write.parquet(out + "/test.parquet")
    return fs.read_splits(spark, {"train": out + "/train.json", "validation": out + "/validation.csv",
                                  "test": out + "/test.parquet", "none": None}, kind)


@register("read_named", sql="SELECT lang, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY lang")
def read_named(spark, sf):
    """a named dataset with a configuration, from the session catalog."""
    table(spark, sf, "documents").createOrReplaceTempView("quire_corpus_docs")
    d = fs.read_named(spark, "quire_corpus", "docs")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).alias("chars"))


ALL_WORDS_SQL = f"w AS (SELECT w AS word, count(*) AS freq FROM (SELECT unnest({_ws_sql('text')}) AS w FROM documents) GROUP BY w)"


@register("read_vocab_words", sql=f"WITH {ALL_WORDS_SQL} SELECT word FROM w")
def read_vocab_words(spark, sf):
    """F5 over a vocabulary file of every word of every document (repeated
    lines, further tokens)."""
    out = scratch_dir(spark, "f5")
    line = F.concat_ws(" ", "word", F.col("freq").cast("string"), F.lit("x"))
    vc.word_freq(table(spark, sf, "documents"), "text").select(F.explode(F.array(line, line)).alias("value")).write.text(out)
    return fs.read_vocab_words(spark, out)


@register("read_word_freq", sql=f"""
WITH {ALL_WORDS_SQL} SELECT word, CASE WHEN freq % 5 = 0 THEN NULL ELSE freq END AS freq FROM w""")
def read_word_freq(spark, sf):
    """F6 over a frequency file of every word of every document; each line
    whose frequency is a multiple of 5 is written with a broken number and
    comes back as rejected."""
    out = scratch_dir(spark, "f6")
    freq = F.when(F.col("freq") % 5 == 0, F.lit("many")).otherwise(F.col("freq").cast("string"))
    vc.word_freq(table(spark, sf, "documents"), "text").select(F.concat_ws(" ", "word", freq)).write.text(out)
    good, bad = fs.read_word_freq(spark, out)
    return good.select("word", "freq").unionByName(
        bad.select(F.split("raw", " ")[0].alias("word"), F.lit(None).cast("long").alias("freq")))


@register("read_aligned", sql="""
SELECT conv_id, turn, length(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS hyp_chars, length(role) AS ref_chars
FROM conversations""")
def read_aligned(spark, sf):
    """two folders of part files whose lines belong together, paired by
    their places among all lines."""
    out = scratch_dir(spark, "f7")
    flat = F.translate("text", "\r\n", "  ")
    rows = cut_lineage(table(spark, sf, "conversations").select("conv_id", "turn", flat.alias("t"), "role")
                       .repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn"))
    rows.select(F.concat_ws("\t", "conv_id", "turn", "t")).write.text(out + "/hyp")
    rows.select("role").write.text(out + "/ref")
    pairs = fs.read_aligned(spark, out + "/hyp", out + "/ref")
    part = F.split("hyp", "\t", 3)
    return pairs.select(part[0].cast("long").alias("conv_id"), part[1].cast("long").alias("turn"),
                        F.length(part[2]).alias("hyp_chars"), F.length("ref").alias("ref_chars"))


@register("keep_only", sql="SELECT 'human' AS from_0, text AS value_0 FROM conversations")
def keep_only(spark, sf):
    """Every column but the conversations goes."""
    c = table(spark, sf, "conversations").withColumn("conversations", F.array(
        F.struct(F.lit("human").alias("from"), F.col("text").alias("value"))))
    k = pp.keep_only(c)
    assert k.columns == ["conversations"]
    return k.select(F.col("conversations")[0]["from"].alias("from_0"), F.col("conversations")[0]["value"].alias("value_0"))


@register("filter_length_bounds", sql="""
WITH t AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda w: length(w) > 3) AS a,
                  string_split(text, ' ') AS b FROM conversations)
SELECT conv_id, turn, len(a) AS n_a, len(b) AS n_b FROM t WHERE len(a) BETWEEN 1 AND 60 AND len(b) BETWEEN 1 AND 60""")
def filter_length_bounds(spark, sf):
    """P5 with a bound that bites on both sides: 0 < size <= 60 of two
    token arrays."""
    b = F.split("text", " ")
    t = table(spark, sf, "conversations").select("conv_id", "turn", F.filter(b, lambda w: F.length(w) > 3).alias("a"), b.alias("b"))
    return pp.filter_length(t, ["a", "b"], 60).select("conv_id", "turn", F.size("a").alias("n_a"), F.size("b").alias("n_b"))


@register("ignore_empty", sql="""
WITH p AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS hyp,
                  CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS ref FROM documents)
SELECT doc_id FROM p WHERE length(hyp) > 0 AND length(ref) > 0""")
def ignore_empty(spark, sf):
    """Pairs with an empty hypothesis or reference go."""
    p = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("text")).alias("hyp"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("lang")).alias("ref"))
    return pp.ignore_empty(p, "hyp", "ref").select("doc_id")


@register("set_unions", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
w AS (SELECT conv_id, turn, string_split(query, ' ') AS a, string_split(answer, ' ') AS b FROM instruction_pairs)
SELECT conv_id, turn, len(list_distinct(list_concat(a, b))) AS set_union,
       md5(array_to_string(list_sort(list_concat(a, b)), ' ')) AS multiset_union_md5 FROM w""")
def set_unions(spark, sf):
    """Set union (its size) and multiset union (all words of both sides,
    digested in sorted order) of the words of question and answer."""
    from quire.operators.rouge import multiset_union, set_union
    from quire.plans.queries_more import _pairs
    w = _pairs(spark, sf).select("conv_id", "turn", F.split("query", " ").alias("a"), F.split("answer", " ").alias("b"))
    return w.select("conv_id", "turn", F.size(set_union("a", "b")).alias("set_union"),
                    F.md5(F.array_join(F.array_sort(multiset_union("a", "b")), " ")).alias("multiset_union_md5"))


SRC, TGT, PAD_ID = 24, 40, 0


@register("reward_fixed_width", sql=f"""
WITH t AS (SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: length(w)) AS ids FROM conversations),
f AS (SELECT conv_id, turn, ids AS c, ids[1:len(ids) // 2 + 1] AS r FROM t WHERE len(ids) BETWEEN 1 AND {SRC + TGT})
SELECT conv_id, turn, array_to_string(list_concat(c, list_transform(range({SRC + TGT} - len(c)), lambda k: {PAD_ID})), ' ') AS ids_chosen,
       len(r) AS mask_rejected, {SRC + TGT} AS width FROM f""")
def reward_fixed_width(spark, sf):
    """P5 with the bound S + T, then E8 to the fixed width S + T."""
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    t = table(spark, sf, "conversations").select("conv_id", "turn", ids.alias("c")) \
        .withColumn("r", F.slice("c", 1, F.floor(F.size("c") / 2).cast("int") + 1))
    t = pp.filter_length(t, ["c", "r"], SRC + TGT)
    x = t.select("conv_id", "turn", F.col("c").alias("input_ids_chosen"), F.transform("c", lambda _: F.lit(1)).alias("attention_mask_chosen"),
                 F.col("r").alias("input_ids_rejected"), F.transform("r", lambda _: F.lit(1)).alias("attention_mask_rejected"))
    x = pp.reward_collate(x, PAD_ID, max_length=SRC + TGT)
    return x.select("conv_id", "turn", F.array_join("input_ids_chosen", " ").alias("ids_chosen"),
                    F.aggregate("attention_mask_rejected", F.lit(0), lambda a, b: a + b).alias("mask_rejected"),
                    F.size("attention_mask_rejected").alias("width"))


@register("preference_join", sql="""
SELECT doc_id AS row_id, lang AS question, text AS response_chosen, upper(source) AS response_rejected
FROM documents WHERE doc_id % 4 <> 1""")
def preference_join(spark, sf):
    """Prompts with gold answers joined with model predictions on the
    row id; prompts without a prediction go."""
    d = table(spark, sf, "documents").withColumnRenamed("doc_id", "row_id")
    prompts = d.select("row_id", F.col("lang").alias("question"), F.col("text").alias("label"))
    preds = d.where("row_id % 4 <> 1").select("row_id", F.upper("source").alias("predict"))
    return rw.preference_from_predictions(preds, prompts=prompts)


@register("default_objective", sql="""
SELECT user_id, round(CASE WHEN user_id % 2 = 0 THEN max(value) + min(value) ELSE avg(value) END, 6) AS objective
FROM events GROUP BY user_id""")
def default_objective(spark, sf):
    """Per run the sum of its metrics, or the evaluation loss where that
    is all there is beside epoch and speed figures."""
    g = table(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("l"), F.max("value").alias("x"), F.min("value").alias("n"))
    base = F.create_map(F.lit("eval_loss"), F.col("l"), F.lit("epoch"), F.lit(3.0), F.lit("eval_runtime"), F.lit(9.0),
                        F.lit("eval_samples_per_second"), F.lit(7.0))
    more = F.create_map(F.lit("eval_max"), F.col("x"), F.lit("eval_min"), F.col("n"))
    m = F.when(F.col("user_id") % 2 == 0, F.map_concat(base, more)).otherwise(base)
    return g.select("user_id", r6(rn.default_objective(m)).alias("objective"))


@register("row_index_nulls", sql="""
SELECT o_orderkey, row_number() OVER (PARTITION BY g ORDER BY k NULLS FIRST, o_orderkey) - 1 AS row_idx
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS g,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE md5(CAST(o_orderkey % 1000 AS VARCHAR)) END AS k FROM orders)""")
def row_index_nulls(spark, sf):
    """Q2 with NULL groups, NULL keys and a text key."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("g"),
        F.when(F.col("o_orderkey") % 7 != 0, F.md5((F.col("o_orderkey") % 1000).cast("string"))).alias("k"))
    return od.with_row_index(o, ["k", "o_orderkey"], ["g"]).select("o_orderkey", "row_idx")


@register("vector_norms", sql="""
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm,
       round(list_sum(list_transform(list_zip(embedding, list_reverse(embedding)), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)), 5) AS product
FROM embeddings""")
def vector_norms(spark, sf):
    """L2 norm of every vector and its product with its own reverse."""
    from quire.functions import arrays as ar
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.round(ar.l2norm("embedding"), 5).alias("norm"),
                    F.round(ar.dot("embedding", F.reverse("embedding")), 5).alias("product"))


@register("preference_unmatched", sql="""
WITH n AS (SELECT lang, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY lang, quality)
SELECT lang, coalesce(max(CASE WHEN quality = 1 THEN n END), 0) AS good, coalesce(max(CASE WHEN quality = 0 THEN n END), 0) AS bad,
       abs(coalesce(max(CASE WHEN quality = 1 THEN n END), 0) - coalesce(max(CASE WHEN quality = 0 THEN n END), 0)) AS unmatched
FROM n GROUP BY lang""")
def preference_unmatched(spark, sf):
    """The rows that the stand-in preference pairs leave out: the surplus of
    the larger quality class of every language."""
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    count = lambda q: F.count(F.when(F.col("quality") == q, 1))
    return d.groupBy("lang").agg(count(1).alias("good"), count(0).alias("bad")) \
        .withColumn("unmatched", F.abs(F.col("good") - F.col("bad")))
