"""Registered queries: one per SURVEY section-2 operator (or a tight group
of them), each as a Spark callable ``(spark, sf_dir) -> DataFrame`` plus,
where SQL can state it, the DuckDB oracle over the same tables.

Every query reads the whole test tables. Doubles are rounded to 6 digits in
both forms so the value hash is stable across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import bleu as bl
from quire.operators import rouge as rg
from quire.plans import sqlkit as S
from quire.plans.standins import instruction_pairs, preference_pairs, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c, 6)


# --------------------------------------------------------------------------
# A1 generation metrics (flagship): instruction pairs -> segment (R12) ->
# ROUGE-1/2/L F and char BLEU-4, each x100 rounded to 4 digits per row,
# averaged over rows. hyp = the answer, ref = its question.

def _generation_scored(spark, sf):
    pairs = instruction_pairs(table(spark, sf, "conversations"))
    seg = pairs.select("conv_id", "turn", "query", "answer",
                       tx.segment(F.col("answer")).alias("hyp"), tx.segment(F.col("query")).alias("ref"))
    scored = rg.score(seg, "hyp", "ref", metrics=["rouge-1", "rouge-2", "rouge-l"], stats=["f"])
    return scored.withColumn("bleu", bl.bleu4(F.col("answer"), F.col("query")))


@register("generation_metrics", sql=f"""
WITH {S.INSTRUCTION_PAIRS},
seg AS (SELECT answer, query, {S.words(S.segment('answer'))} AS hw, {S.words(S.segment('query'))} AS rw
        FROM instruction_pairs),
cnt AS (
  SELECT answer, query,
         len(list_distinct(hw)) AS h1, len(list_distinct(rw)) AS r1, {S.set_overlap('hw', 'rw')} AS o1,
         len(list_distinct({S.ngrams('hw', 2)})) AS h2, len(list_distinct({S.ngrams('rw', 2)})) AS r2,
         {S.set_overlap(S.ngrams('hw', 2), S.ngrams('rw', 2))} AS o2,
         len(hw) AS hl, len(rw) AS rl, {S.lcs('hw', 'rw')} AS ol,
         {S.bleu_counts('answer', 'query')} AS nd
  FROM seg)
SELECT round(avg({S.r4(S.prf('h1', 'r1', 'o1')['f'] + ' * 100')}), 6) AS rouge_1,
       round(avg({S.r4(S.prf('h2', 'r2', 'o2')['f'] + ' * 100')}), 6) AS rouge_2,
       round(avg({S.r4(S.prf('hl', 'rl', 'ol')['f'] + ' * 100')}), 6) AS rouge_l,
       round(avg({S.r4(S.bleu_from_counts('nd', 'answer', 'query') + ' * 100')}), 6) AS bleu_4,
       count(*) AS n_pairs
FROM cnt""")
def generation_metrics(spark, sf):
    s = _generation_scored(spark, sf)
    return s.agg(
        r6(F.avg(F.bround(F.col("rouge_1_f") * 100, 4))).alias("rouge_1"),
        r6(F.avg(F.bround(F.col("rouge_2_f") * 100, 4))).alias("rouge_2"),
        r6(F.avg(F.bround(F.col("rouge_l_f") * 100, 4))).alias("rouge_l"),
        r6(F.avg(F.bround(F.col("bleu") * 100, 4))).alias("bleu_4"),
        F.count(F.lit(1)).alias("n_pairs"))


def _load_all():
    # import for side effects: every module registers its queries
    from quire.plans import queries_files, queries_io, queries_more, queries_order, queries_runs, queries_streams  # noqa: F401


def normalise_types(df: DataFrame) -> DataFrame:
    """Integers leave as bigint and floats as double, so the schema matches
    the SQL oracle's BIGINT / DOUBLE."""
    from pyspark.sql import types as T
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _wrapped(fn):
    def run(spark, sf):
        from quire.session import ensure_checkpoint_dir, ship_package
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return normalise_types(fn(spark, sf))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    _load_all()
    return {k: _wrapped(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict:
    _load_all()
    return dict(ORACLES)
