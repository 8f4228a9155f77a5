"""Registered queries: column pruning / split selection (P1, P2, P6, P14),
positional pairing (J1), batch-function and metric surfaces (I5, I6),
union-LCS (R7) and file round trips (F1, F3, F8, U5)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.lcs import union_lcs_carried
from quire.operators import infer as inf
from quire.operators import order as od
from quire.operators import partials as pt
from quire.operators import prep as pp
from quire.plans import sqlkit as S
from quire.plans.catalog import r6, register
from quire.plans.queries_more import _pairs
from quire.plans.standins import table
from quire.sources import files as fs
from quire.sources import sinks as sk
from quire.streaming.streams import scratch_dir


@register("select_mode_prune", sql="""
WITH n AS (SELECT count(*) AS n FROM documents),
s AS (SELECT doc_id, lang, text, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < round_even(5 * n / 100.0, 0)
                   THEN 'validation' ELSE 'train' END AS split FROM documents, n)
SELECT doc_id, lang, split FROM s WHERE split IN ('validation') AND length(text) > 0 AND length(lang) > 0""")
def select_mode_prune(spark, sf):
    """P14 + P6 + P1/P2: keep the requested split, drop pairs with an empty
    side, keep only the wanted columns (dataset order)."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    s = pp.select_mode(od.head_percent_split(d, 5, ["doc_id"]), ["validation"])
    s = pp.ignore_empty(s, "text", "lang")
    pruned, _ignored = pp.prune_columns(s, ["doc_id", "lang", "split"])
    return pruned


@register("zip_join", sql="""
WITH h AS (SELECT text AS hyp, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM conversations),
r AS (SELECT text AS ref, row_number() OVER (ORDER BY md5('5:' || conv_id || ':' || turn),
                                             conv_id || ':' || turn) - 1 AS i FROM conversations)
SELECT h.i AS line, length(hyp) AS hyp_chars, length(ref) AS ref_chars FROM h JOIN r USING (i)""")
def zip_join(spark, sf):
    """Positional pairing of two equally long tables (turns in order
    against turns in a seeded order) by dense index; counts checked first."""
    c = table(spark, sf, "conversations").withColumn("rid", F.concat_ws(":", "conv_id", "turn"))
    left, right = c.select("conv_id", "turn", "text"), c.select("rid", "text")
    n, m = left.count(), right.count()  # of the sources: nothing is numbered for it
    if n != m:
        raise ValueError(f"row counts differ: {n} vs {m}")
    h = od.with_row_index(left, ["conv_id", "turn"], name="line").select("line", F.col("text").alias("hyp"))
    r = od.shuffled_index(right, "rid", 5, "line").select("line", F.col("text").alias("ref"))
    return h.join(r, "line").select("line", F.length("hyp").alias("hyp_chars"), F.length("ref").alias("ref_chars"))


@register("batch_function", sql="""
SELECT conv_id, turn, len(string_split(text, ' ')) AS n_words FROM conversations""")
def batch_function(spark, sf):
    """A user batch function over pandas batches (columns replaced)."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"],
                             "n_words": pdf["text"].str.split(" ").str.len().astype("int64")})
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return inf.transform_batches(c, fn, "conv_id long, turn long, n_words long")


@register("metric_surface", sql="""
SELECT role, round(avg(length(text)), 6) AS mean_chars, count(*) AS examples,
       round(avg(CASE WHEN length(text) > 500 THEN 1.0 ELSE 0.0 END), 6) AS long_share
FROM conversations GROUP BY role""")
def metric_surface(spark, sf):
    """Registered column-expression metrics evaluated per group in one
    aggregate."""
    c = table(spark, sf, "conversations")
    return inf.metric_columns(c, {
        "mean_chars": r6(F.avg(F.length("text"))),
        "examples": F.count(F.lit(1)),
        "long_share": r6(F.avg(F.when(F.length("text") > 500, 1.0).otherwise(0.0))),
    }, ["role"])


@register("metric_mergeable", sql="""
WITH c AS (SELECT role, length(text) AS n FROM conversations)
SELECT role, round(sqrt(avg(CAST(n AS DOUBLE) * n)), 6) AS rms_chars FROM c GROUP BY role
UNION ALL SELECT 'all', round(sqrt(avg(CAST(n AS DOUBLE) * n)), 6) FROM c""")
def metric_mergeable(spark, sf):
    """I6 with a user metric of init, update, merge and finish: per role, and
    over one group of all rows that every task folds its share of."""
    c = table(spark, sf, "conversations").select("role", F.length("text").alias("n"))
    rms = {"rms_chars": pt.root_mean_square("n")}
    whole = pt.merge_metrics(c, rms).select(F.lit("all").alias("role"), "rms_chars")
    return pt.merge_metrics(c, rms, "role").unionByName(whole).withColumn("rms_chars", r6(F.col("rms_chars")))


@register("metric_macro_f1", sql="""
WITH p AS (SELECT d.source, l.quality AS y, CASE WHEN d.n_chars > 400 THEN 1 ELSE 0 END AS g
           FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL AND d.n_chars IS NOT NULL),
k AS (SELECT source, c, 2.0 * count(*) FILTER (y = c AND g = c) / (count(*) FILTER (y = c) + count(*) FILTER (g = c)) AS f1
      FROM p, (SELECT unnest([0, 1]) AS c) GROUP BY source, c
      HAVING count(*) FILTER (y = c) + count(*) FILTER (g = c) > 0)
SELECT source, round(avg(f1), 6) AS macro_f1 FROM k GROUP BY source""")
def metric_macro_f1(spark, sf):
    """Mean F1 over the classes, a metric that no sum over rows gives,
    for a rule that calls long documents good."""
    d = table(spark, sf, "documents").select("doc_id", "source", (F.col("n_chars") > 400).cast("int").alias("g"))
    p = d.join(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("int").alias("y")), "doc_id")
    return pt.merge_metrics(p, {"macro_f1": pt.macro_f1("y", "g")}, "source").withColumn("macro_f1", r6(F.col("macro_f1")))


@register("union_lcs")
def union_lcs(spark, sf):
    """For every question sentence in turn its union-LCS against every
    answer sentence, the union carried from sentence to sentence (iterative
    backtrace; checked in pytest)."""
    p = _pairs(spark, sf)

    def sentences(c):
        return F.transform(tx.normalise_sentences(tx.split_sentences(F.col(c))), lambda s: F.split(s, " "))
    u = p.select("conv_id", "turn", union_lcs_carried()(sentences("query"), sentences("answer")).alias("u"))
    return u.select("conv_id", "turn", F.array_join(F.transform("u.new_counts", lambda x: x.cast("string")), " ").alias("new_counts"),
                    F.size("u.union").alias("union_size"))


@register("json_roundtrip", sql="SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(spark, sf):
    """F8 -> F1/U5: conversations written as sharded JSON lines (non-ASCII
    unescaped), read back recursively with per-file sniffing."""
    out = scratch_dir(spark, "f8")
    sk.write_jsonl(table(spark, sf, "conversations"), out + "/conv")
    df = fs.read_json_dir(spark, out, "conv_id long, turn long, role string, text string")
    return df.drop("source_file")


@register("lines_roundtrip", sql=f"""
SELECT row_number() OVER (ORDER BY doc_id, k) - 1 AS row, {S.lit('')} || trim(l, {S.lit(tx.WS_CHARS)}) AS text
FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS k
      FROM (SELECT doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM documents))""")
def lines_roundtrip(spark, sf):
    """document texts written as a text corpus of part files in the order
    of their ids, read back as stripped lines with their places in it."""
    out = scratch_dir(spark, "f3")
    (table(spark, sf, "documents").select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .select("text").write.text(out))
    return fs.read_lines(spark, out).select("row", "text")
