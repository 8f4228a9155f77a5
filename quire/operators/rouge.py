"""ROUGE-N / ROUGE-L over a table of (hypothesis, reference) pairs.

The unit of work is a DataFrame of pairs; every scorer adds columns. N-gram
overlap is a per-row Catalyst expression (hash-set intersection for the set
form, a sort + single fold for the multiset form), so scoring is a narrow
projection: no shuffle, partitioned like the input. LCS is the only Arrow
stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.lcs import lcs_len_udf
from quire.operators.joins import split_join
from quire.session import cut_lineage

# Metric names and stats the scorer accepts, and the
# defaults used when the caller names none.
AVAILABLE_METRICS = ["rouge-1", "rouge-2", "rouge-3", "rouge-4", "rouge-5", "rouge-l"]
AVAILABLE_STATS = ["r", "p", "f"]
DEFAULT_METRICS = ["rouge-1", "rouge-2", "rouge-l"]
DEFAULT_STATS = ["r", "p", "f"]
F_EPS = 1e-8


def multiset_overlap(a: Column, b: Column) -> Column:
    """Sum over distinct items g of min(count_a(g), count_b(g)).

    Tags items with their side, sorts once, and folds over the runs of equal
    items: O((n+m) log(n+m)) in the JVM, no explode, no shuffle."""
    tagged = F.array_sort(F.concat(
        F.transform(a, lambda g: F.struct(g.alias("g"), F.lit(0).alias("s"))),
        F.transform(b, lambda g: F.struct(g.alias("g"), F.lit(1).alias("s")))))
    zero = F.struct(F.lit(None).cast("string").alias("p"), F.lit(0).alias("a"),
                    F.lit(0).alias("b"), F.lit(0).alias("t"))

    def step(acc, x):
        same = acc["p"].eqNullSafe(x["g"])
        return F.when(same, F.struct(acc["p"].alias("p"), (acc["a"] + 1 - x["s"]).alias("a"),
                                     (acc["b"] + x["s"]).alias("b"), acc["t"].alias("t"))) \
            .otherwise(F.struct(x["g"].alias("p"), (1 - x["s"]).alias("a"), x["s"].alias("b"),
                                (acc["t"] + F.least(acc["a"], acc["b"])).alias("t")))

    return F.aggregate(tagged, zero, step, lambda acc: acc["t"] + F.least(acc["a"], acc["b"]))


def set_overlap(a: Column, b: Column) -> Column:
    """Size of the set intersection (array_intersect de-duplicates)."""
    return F.size(F.array_intersect(a, b))


def set_union(a, b) -> Column:
    """The distinct items of both arrays."""
    return F.array_union(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def multiset_union(a, b) -> Column:
    """All items of both arrays, repeats included."""
    return F.concat(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def ngram_counts(hyp_words: Column, ref_words: Column, n: int, exclusive: bool = True) -> Column:
    """struct(hyp, ref, overlap) n-gram counts."""
    gh, gr = tx.ngrams(hyp_words, n), tx.ngrams(ref_words, n)
    if exclusive:
        gh, gr = F.array_distinct(gh), F.array_distinct(gr)
        ov = set_overlap(gh, gr)
    else:
        ov = multiset_overlap(gh, gr)
    return F.struct(F.size(gh).alias("hyp"), F.size(gr).alias("ref"), ov.alias("overlap"))


def lcs_counts(hyp_words: Column, ref_words: Column) -> Column:
    """struct(hyp, ref, overlap) with overlap = LCS length over all words."""
    return F.struct(F.size(hyp_words).alias("hyp"), F.size(ref_words).alias("ref"),
                    lcs_len_udf(ref_words, hyp_words).alias("overlap"))


def prf(counts: Column) -> Column:
    """p = overlap/hyp, r = overlap/ref (0 when empty), f = 2pr/(p+r+1e-8)."""
    h, r, o = counts["hyp"].cast("double"), counts["ref"].cast("double"), counts["overlap"].cast("double")
    p = F.when(h == 0, F.lit(0.0)).otherwise(o / h)
    rc = F.when(r == 0, F.lit(0.0)).otherwise(o / r)
    f = F.lit(2.0) * ((p * rc) / (p + rc + F.lit(F_EPS)))
    return F.struct(rc.alias("r"), p.alias("p"), f.alias("f"))


def metric_col(metric: str) -> str:
    return metric.replace("-", "_")


def _check(metrics, stats):
    metrics = [m.lower() for m in (metrics or DEFAULT_METRICS)]
    for m in metrics:
        if m not in AVAILABLE_METRICS:
            raise ValueError(f"Unknown metric '{m}'")
    stats = [s.lower() for s in (stats or DEFAULT_STATS)]
    for s in stats:
        if s not in AVAILABLE_STATS:
            raise ValueError(f"Unknown stat '{s}'")
    return metrics, stats


def score(df: DataFrame, hyp: str, ref: str, metrics=None, stats=None, exclusive: bool = True,
          raw_results: bool = False, return_lengths: bool = False, ignore_empty: bool = False,
          prefix: str = "") -> DataFrame:
    """Add one column per (metric, stat), e.g. ``rouge_1_f``.

    ``raw_results`` gives ``<metric>_hyp/_ref/_overlap`` counts instead.
    ``ignore_empty`` (P6) drops pairs with an empty side first. A side with
    no sentence at all yields NULL scores (the reference raises there)."""
    metrics, stats = _check(metrics, stats)
    if ignore_empty:
        df = df.where((F.length(hyp) > 0) & (F.length(ref) > 0))
    hw, rw = "__hyp_words", "__ref_words"
    out = (df.withColumn("__hs", tx.normalise_sentences(tx.split_sentences(F.col(hyp))))
             .withColumn("__rs", tx.normalise_sentences(tx.split_sentences(F.col(ref))))
             .withColumn(hw, F.when(F.size("__hs") > 0, tx.words(F.col("__hs"))))
             .withColumn(rw, F.when(F.size("__rs") > 0, tx.words(F.col("__rs")))))
    cols = []
    for m in metrics:
        if m == "rouge-l":
            counts = lcs_counts(F.col(hw), F.col(rw))
        else:
            counts = ngram_counts(F.col(hw), F.col(rw), int(m.split("-")[1]), exclusive)
        name = prefix + metric_col(m)
        cc = f"__{name}_counts"
        out = out.withColumn(cc, counts)
        if raw_results:
            for s in ("hyp", "ref", "overlap"):
                cols.append(F.col(cc)[s].alias(f"{name}_{s}"))
        else:
            sc = prf(F.col(cc))
            for s in stats:
                cols.append(sc[s].alias(f"{name}_{s}"))
    if return_lengths:
        cols.append(tx.word_count(F.col(hyp)).alias(prefix + "len_hyp"))
        cols.append(tx.word_count(F.col(ref)).alias(prefix + "len_ref"))
    return out.select(*df.columns, *cols)


def average(scored: DataFrame, value_cols, group_cols=()) -> DataFrame:
    """A2: mean of every stat of every metric (optionally per group)."""
    aggs = [F.avg(c).alias(c) for c in value_cols]
    return scored.groupBy(*group_cols).agg(*aggs) if group_cols else scored.agg(*aggs)


def long_form(scored: DataFrame, key_cols, metrics=None, stats=None) -> DataFrame:
    """Scores as rows (key..., metric, r, p, f) via ``stack`` (no shuffle)."""
    metrics, stats = _check(metrics, stats)
    parts = ", ".join(
        f"'{m}', " + ", ".join(f"`{metric_col(m)}_{s}`" for s in stats) for m in metrics)
    expr = f"stack({len(metrics)}, {parts}) as (metric, {', '.join(stats)})"
    return scored.select(*key_cols, F.expr(expr))


def pair_index_scores(seqs: DataFrame, pairs: DataFrame, n: int = 2, exclusive: bool = True,
                      id_col: str = "seq_id", text_col: str = "text",
                      hyp_id: str = "hyp_id", ref_id: str = "ref_id") -> DataFrame:
    """Score pairs (hyp_id, ref_id) over shared sequences; the n-grams of
    every sequence are built once (one projection of ``seqs``) and joined to
    the pairs twice. Missing ids raise (left-anti check first)."""
    w = seqs.select(F.col(id_col).alias("__id"), tx.rouge_words(F.col(text_col)).alias("__w"))
    g = tx.ngrams(F.col("__w"), n)
    grams = w.select("__id", (F.array_distinct(g) if exclusive else g).alias("__g"))
    ids = pairs.select(F.col(hyp_id).alias("__id")).union(pairs.select(F.col(ref_id).alias("__id"))).distinct()
    missing = ids.join(grams.select("__id"), "__id", "left_anti").limit(1).collect()
    if missing:
        raise KeyError(f"sequence id {missing[0]['__id']} not in sequences")
    h = grams.withColumnRenamed("__id", hyp_id).withColumnRenamed("__g", "__gh")
    r = grams.withColumnRenamed("__id", ref_id).withColumnRenamed("__g", "__gr")
    j = pairs.join(h, hyp_id).join(r, ref_id)
    ov = set_overlap(F.col("__gh"), F.col("__gr")) if exclusive else multiset_overlap(F.col("__gh"), F.col("__gr"))
    counts = F.struct(F.size("__gh").alias("hyp"), F.size("__gr").alias("ref"), ov.alias("overlap"))
    sc = prf(counts)
    return j.select(*pairs.columns, sc["r"].alias("r"), sc["p"].alias("p"), sc["f"].alias("f"))


def ngram_candidates(left: DataFrame, right: DataFrame, n: int, left_id: str, right_id: str, text_col: str = "text",
                     **split) -> DataFrame:
    """The pairs (left_id, right_id) of texts that share a word n-gram.

    Both sides send 64-bit hashes of their distinct n-grams; ``left`` is the
    larger side, whose hot grams are split by salt if the other one is too
    large to broadcast (``split_join``). The pairs are then checked on the
    n-grams themselves, so a collision of hashes adds none."""
    def grams(df, ident):
        w = df.select(ident, tx.rouge_words(F.col(text_col)).alias("w"))
        return w.select(ident, F.explode(F.array_distinct(tx.ngrams(F.col("w"), n))).alias("g")).select(ident, F.xxhash64("g").alias("g"))

    met = split_join(grams(left, left_id), grams(right, right_id), "g", **split)
    pairs = cut_lineage(met.select(left_id, right_id).distinct())

    def whole(df, ident, name):
        w = df.select(ident, tx.rouge_words(F.col(text_col)).alias("w"))
        return w.select(ident, tx.ngrams(F.col("w"), n).alias(name))
    # only the texts that are in a pair are looked at again
    own = whole(split_join(left.select(left_id, text_col), pairs.select(left_id).distinct(), left_id, "left_semi", **split),
                left_id, "__a")
    both = split_join(split_join(pairs, cut_lineage(whole(right, right_id, "__b")), right_id, **split),
                      cut_lineage(own), left_id, **split)
    return both.where(F.arrays_overlap("__a", "__b")).select(left_id, right_id)
