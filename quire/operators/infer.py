"""Batch inference surface (I1-I6, F9): pluggable scorers and generators
run inside ``mapInPandas`` on Arrow batches. A model is built once per Python
worker process and query; keys travel through the batch function, so scored
rows are never joined back to their input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quire.functions import arrays as ar
from quire.functions import text as tx
from quire.operators.reward import pair_scores

# Models of this worker process by the id that the query gave them. A worker
# serves many tasks; a closure is unpickled anew for each of them, this
# module is not.
_MODELS: dict[str, object] = {}
_MODELS_KEPT = 4


def worker_model(name: str, factory: Callable[[], object]):
    """The model ``name`` of this process, built on first use."""
    if name not in _MODELS:
        while len(_MODELS) >= _MODELS_KEPT:
            _MODELS.pop(next(iter(_MODELS)))
        _MODELS[name] = factory()
    return _MODELS[name]


def quality(logits) -> Column:
    """quality = softmax(logits)[1] (D5: needs at least two logits)."""
    return ar.softmax_at(logits, 1)


def _schema(df: DataFrame, columns) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in columns)


def score_texts(df: DataFrame, key, text: str, scorer_factory: Callable[[], Callable[[pd.Series], pd.Series]],
                out: str = "score") -> DataFrame:
    """Scores from a user model; ``scorer_factory`` is called once
    per worker process, the scorer maps a Series of texts to a Series of
    floats. ``key``: one or more columns that stay beside the score."""
    keys = [key] if isinstance(key, str) else list(key)
    name = uuid.uuid4().hex

    def run(it):
        score = worker_model(name, scorer_factory)
        for pdf in it:
            yield pdf[keys].assign(**{out: score(pdf[text]).astype("float64")})
    read = list(dict.fromkeys([*keys, text]))
    return df.select(*read).mapInPandas(run, f"{_schema(df, keys)}, `{out}` double")


def score_pairs(pairs: DataFrame, scorer_factory, pair_col: str = "pair_id",
                chosen_text: str = "text_chosen", rejected_text: str = "text_rejected") -> DataFrame:
    """One scalar reward for chosen and rejected: explode the sides,
    score every text once (I1), bring the pair together again (J7)."""
    sides = pairs.select(pair_col, F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col(chosen_text).alias("text")),
        F.struct(F.lit("rejected").alias("side"), F.col(rejected_text).alias("text")))).alias("s"))
    flat = sides.select(pair_col, F.col("s.side").alias("side"), F.col("s.text").alias("text"))
    return pair_scores(score_texts(flat, [pair_col, "side"], "text", scorer_factory), pair_col, "side", "score")


def keep_last_words(prompt: Column, limit: int) -> Column:
    """The last ``limit`` white-space tokens of a prompt that has more."""
    words = F.split(prompt, tx.WS_CLASS + "+")
    return F.when(F.size(words) > limit, F.array_join(F.slice(words, -limit, limit), " ")).otherwise(prompt) \
        if limit > 0 else F.lit("")


def generate(df: DataFrame, key, prompt: str, generator_factory, stop: str | None = None,
             out: str = "Output", context: int | None = None, max_new: int = 0, reserve: int = 8) -> DataFrame:
    """Prompts -> the last context - max_new - reserve tokens (with
    ``context``) -> generator -> cut at the stop string -> strip. The
    generator maps a Series of prompts to a Series of texts; a NULL prompt is
    an empty one, and a NULL output stays NULL. ``Input`` is the prompt as
    given; ``key`` as in ``score_texts``."""
    keys = [key] if isinstance(key, str) else list(key)
    name = uuid.uuid4().hex

    def cut(t):
        if t is None or t is pd.NA or t != t:
            return None
        return (t.split(stop, 1)[0] if stop else t).strip()

    def run(it):
        model = worker_model(name, generator_factory)
        for pdf in it:
            texts = [cut(t) for t in model(pdf["__asked"])]
            yield pdf[keys].assign(Input=pdf[prompt], **{out: pd.Series(texts, index=pdf.index, dtype="object")})
    asked = F.coalesce(F.col(prompt), F.lit(""))
    if context is not None:
        asked = keep_last_words(asked, context - max_new - reserve)
    read = list(dict.fromkeys([*keys, prompt]))
    return df.select(*read, asked.alias("__asked")).mapInPandas(run, f"{_schema(df, keys)}, Input string, `{out}` string")


def generate_resumable(df: DataFrame, key, prompt: str, generator_factory, path: str, slices: int = 16,
                       **options) -> DataFrame:
    """I3 that survives a failed job: the rows are dealt to ``slices`` by a
    hash of their key, each slice is one job whose output is committed under
    ``path`` as it ends. A restart with the same path and slices skips every
    key that stands there (an anti-join within the slice), so a committed row
    is not generated again, whether its slice was finished or not. Keys must
    be unique and not NULL; a changed prompt under a known key is not seen.
    Returns all rows of ``path`` whose key is in ``df``."""
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    if {"quire_slice", "Input", options.get("out", "Output")} & set(keys):
        raise ValueError("a key is named like a column of the output")
    schema = df.select(*keys).schema
    if any(f.dataType.typeName() in ("float", "double", "map") for f in schema):
        raise TypeError("keys that hash alike on every run are needed")
    for name in ("Input", options.get("out", "Output")):
        schema = schema.add(name, "string")
    sliced = df.withColumn("quire_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))

    def committed():
        # the first job makes the folder; files carry no schema to rely on
        try:
            return spark.read.schema(StructType([*schema.fields, StructField("quire_slice", IntegerType())])).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
    for k in range(slices):
        todo, done = sliced.where(F.col("quire_slice") == k).drop("quire_slice"), committed()
        if done is not None:
            todo = todo.join(done.where(F.col("quire_slice") == k).select(*keys), keys, "left_anti")
        made = generate(todo, keys, prompt, generator_factory, **options)
        made.withColumn("quire_slice", F.lit(k)).write.mode("append").partitionBy("quire_slice").parquet(path)
    return committed().drop("quire_slice").join(df.select(*keys), keys, "left_semi")


def assemble_chunks(chunks: DataFrame, key: str, seq: str, text: str, stop: str,
                    across: bool = False) -> DataFrame:
    """I4: concatenate chunks in order up to the first chunk holding the
    stop string, cut there. By default (as the reference) a stop string
    split over two chunks is not found; ``across=True`` searches the joined
    text instead. Chunk lists per request are bounded by the generation
    length (max new tokens)."""
    g = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"),
                                                                      F.col(text).alias("t")))).alias("__c"))
    if across:
        joined = F.array_join(F.transform("__c", lambda c: c["t"]), "")
        pos = F.instr(joined, stop)
        res = F.when(pos > 0, F.substring(joined, 1, pos - 1)).otherwise(joined)
    else:
        # first chunk holding the stop string, then one join of the chunks
        # before it plus the head of that chunk: linear in the text length
        def cut(cs):
            texts = F.transform(cs, lambda c: c["t"])
            k = F.array_position(F.transform(texts, lambda t: F.instr(t, stop) > 0), True).cast("int")
            head = F.array_join(F.slice(texts, 1, F.greatest(k - 1, F.lit(0))), "")
            tk = F.element_at(texts, F.greatest(k, F.lit(1)))
            return F.when(k == 0, F.array_join(texts, "")).otherwise(
                F.concat(head, F.substring(tk, 1, F.instr(tk, stop) - 1)))
        res = ar.let(F.col("__c"), cut)
    return g.select(key, res.alias("text"))


def predictions(df: DataFrame, label: str, predict: str) -> DataFrame:
    """{labels, predict}, both stripped."""
    return df.select(tx.strip_py(F.col(label)).alias("labels"), tx.strip_py(F.col(predict)).alias("predict"))


def transform_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                      remove_columns: bool = True) -> DataFrame:
    """Batched map (columnar pandas batches in parallel tasks). With
    ``remove_columns`` the function's columns replace the input's; without,
    they stand beside them (one output row per input row; a column of the
    same name is replaced)."""
    made = df.sparkSession.createDataFrame([], schema).columns
    kept = [] if remove_columns else [c for c in df.columns if c not in made]

    def run(it):
        for pdf in it:
            got = fn(pdf)
            if kept and len(got) != len(pdf):
                raise ValueError(f"{len(got)} rows made from {len(pdf)}: input columns cannot stay")
            yield got[made] if not kept else pd.concat(
                [pdf[kept].reset_index(drop=True), got[made].reset_index(drop=True)], axis=1)
    return df.mapInPandas(run, f"{_schema(df, kept)}, {schema}" if kept else schema)


def metric_columns(df: DataFrame, metrics: dict[str, Column], group_cols=(),
                   preprocess: Callable[[DataFrame], DataFrame] | None = None,
                   include_inputs: tuple[str, ...] = ()) -> DataFrame:
    """Registered metrics evaluated in one aggregate. ``preprocess``
    changes the predictions first; ``include_inputs`` keeps a sample-free
    summary of inputs (count of non-NULL values per column) beside them. A
    metric may also be a grouped Arrow aggregate (a pandas UDF column)."""
    df = preprocess(df) if preprocess is not None else df
    aggs = [c.alias(n) for n, c in metrics.items()] + [F.count(c).alias(f"n_{c}") for c in include_inputs]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
