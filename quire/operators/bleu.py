"""Sentence BLEU-4 on characters, one reference, uniform weights,
smoothing method 3 (Chen & Cherry 2014: the k-th zero numerator becomes
1 / (2^k * denominator)). The clipped counts come from an Arrow batch
function by default, or (``engine`` of the JVM) from Catalyst as multiset
overlaps of character n-grams (substrings of length n, which are already
unique keys), so the whole score is one projection.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.rouge import multiset_overlap

MAX_N = 4


def char_ngrams(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n,
                  F.transform(F.sequence(F.lit(1), F.length(text) - n + 1),
                              lambda i: F.substring(text, i, n))
                  ).otherwise(F.array().cast("array<string>"))


_ND_TYPE = T.ArrayType(T.StructType([T.StructField("num", T.DoubleType()), T.StructField("den", T.DoubleType())]))


@F.pandas_udf(_ND_TYPE)
def _clipped_counts(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """[(clipped numerator, denominator)] for n = 1..4 per pair (Counter
    intersections in C; one Arrow batch at a time)."""
    out = []
    for h, r in zip(hyp, ref):
        if h is None or r is None:
            out.append(None)
            continue
        row = []
        for n in range(1, MAX_N + 1):
            ch = Counter(h[i:i + n] for i in range(len(h) - n + 1))
            cr = Counter(r[i:i + n] for i in range(len(r) - n + 1))
            row.append({"num": float(sum((ch & cr).values())), "den": float(max(1, len(h) - n + 1))})
        out.append(row)
    return pd.Series(out)


def clipped_counts(hyp: Column, ref: Column, engine: str = "arrow") -> Column:
    """The four (clipped numerator, denominator) pairs. ``engine='catalyst'``
    computes them with JVM higher-order functions (sort + fold per order);
    ``'arrow'`` (default) with a vectorised UDF, several times faster on
    long texts because interpreted folds allocate a struct per element."""
    if engine == "arrow":
        return _clipped_counts(hyp, ref)
    return F.array(*[
        F.struct(multiset_overlap(char_ngrams(hyp, n), char_ngrams(ref, n)).cast("double").alias("num"),
                 F.greatest(F.lit(1), F.size(char_ngrams(hyp, n))).cast("double").alias("den"))
        for n in range(1, MAX_N + 1)])


def bleu4(hyp: Column, ref: Column, engine: str = "arrow") -> Column:
    """BLEU-4 in [0, 1] of ``hyp`` against the single reference ``ref``.

    The four (clipped numerator, denominator) pairs are built once into an
    array and folded in a single ``aggregate`` (smoothing counter, log sum,
    no-unigram-match flag), so no n-gram count is evaluated twice."""
    nd = clipped_counts(hyp, ref, engine)
    init = F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("s"), F.lit(0).alias("i"),
                    F.lit(False).alias("z1"))

    def step(acc, e):
        zero = e["num"] == 0
        k = acc["k"] + F.when(zero, 1).otherwise(0)
        p = F.when(zero, F.lit(1.0) / (F.pow(F.lit(2.0), k) * e["den"])).otherwise(e["num"] / e["den"])
        return F.struct(k.alias("k"), (acc["s"] + F.log(p) / F.lit(float(MAX_N))).alias("s"),
                        (acc["i"] + 1).alias("i"), (acc["z1"] | ((acc["i"] == 0) & zero)).alias("z1"))

    h, r = F.length(hyp).cast("double"), F.length(ref).cast("double")
    bp = F.when(h > r, F.lit(1.0)).when(h == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / h))
    return F.aggregate(nd, init, step,
                       lambda acc: F.when(acc["z1"], F.lit(0.0)).otherwise(bp * F.exp(acc["s"])))
