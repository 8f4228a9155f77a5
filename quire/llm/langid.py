"""Languages of a text as a mixture inferred by expectation-maximisation.

A text is its byte trigrams (UTF-8, lower case, ASCII letters and bytes beyond
ASCII; everything else is space, runs of space hold no trigram). A learned
language is a smoothed distribution over trigram buckets. In a text each trigram
is drawn from a mixture of languages with unknown proportions.

Inference, for all texts of a batch side by side, adds languages one by one:

1. Start with the single language of the highest likelihood.
2. For each language outside the set, the derivative of the log-likelihood
   towards it is N * (mean of P_new / P_mixture - 1). The log-likelihood is
   concave in the proportions, so this also bounds what any addition can gain;
   where no bound exceeds the penalty, the set is final.
3. Otherwise the language with the largest derivative joins; expectation-
   maximisation gives the proportions. It stays if the log-likelihood rises by
   more than the penalty, ``PENALTY`` * log(N) per language (trigrams overlap,
   so the log-likelihood counts a third of each); then step 2 again.

The predicted language has the largest proportion; the score is that proportion
with one trigram more for every learned language, so short texts score lower.

Learning uses at most about ``SAMPLE_ROWS`` texts of a language, chosen by a hash
of id and text among all allowed rows, and the ``LANGUAGES`` most frequent values
of the language column (both bound the model, which every task holds). Inference
covers every row and whole texts: a long one is counted stretch by stretch.

Defined results: NULL texts and texts without any letter are ``und`` with score 0
and no languages, as is every text when nothing was learned; texts of letters
that no language knows go to the language whose smoothing makes them likeliest
(ties: the first by name). Rows with a NULL id are predicted but never learned
from; repeated rows get equal results; an empty table gives no rows; other
columns ride along in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import hash_share, packed, small_batches

SAMPLE_ROWS = 2_000
LANGUAGES = 256
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.05   # counts added to every bucket
PENALTY = 2.0
OVERLAP = 3.0      # trigrams that hold the same byte
STEPS, CLOSE = 30, 1e-4
STRETCH = 1 << 20  # bytes whose trigrams are counted at once
UNKNOWN = "und"
FOUND = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("languages", T.ArrayType(T.StringType())),
                      T.StructField("shares", T.ArrayType(T.DoubleType()))])

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _bytes(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(_PLAIN) + b" "


def _buckets(raw: bytes) -> np.ndarray:
    """The buckets of all trigrams, in order."""
    b = np.frombuffer(raw, np.uint8)
    space = b == 32
    one, two, three = b[:-2].astype(np.uint32), b[1:-1].astype(np.uint32), b[2:].astype(np.uint32)
    code = (one << 16 | two << 8 | three) * np.uint32(2_654_435_761)
    double = space[:-1] & space[1:]
    return (code >> np.uint32(32 - BUCKET_BITS))[~(double[:-1] | double[1:])]


def counted(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, starts, buckets, counts) of runs of texts whose bytes
    fit into a stretch, a longer text alone."""
    raws, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = _bytes(text)
        if raws and size + len(raw) > STRETCH:
            yield (first, *_counts(raws))
            raws, size, first = [], 0, i
        raws.append(raw)
        size += len(raw)
    if raws:
        yield (first, *_counts(raws))


def _counts(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(raws) == 1:  # of any length
        total = np.zeros(BUCKETS, np.int64)
        for at in range(0, max(1, len(raws[0]) - 2), STRETCH):
            total += np.bincount(_buckets(raws[0][at:at + STRETCH + 2]), minlength=BUCKETS)
        bucket = np.flatnonzero(total)
        return np.zeros(1, np.int64), bucket, total[bucket]
    found = [_buckets(r) for r in raws]
    text = np.repeat(np.arange(len(raws), dtype=np.int64), [len(f) for f in found])
    key, n = np.unique(text << BUCKET_BITS | np.concatenate(found).astype(np.int64), return_counts=True)
    return np.searchsorted(key, np.arange(len(raws), dtype=np.int64) << BUCKET_BITS), key & (BUCKETS - 1), n


@dataclass
class Model:
    names: list[str]
    logs: np.ndarray  # (BUCKETS, languages), of the smoothed probabilities

    @property
    def table(self) -> np.ndarray:
        return np.exp(self.logs)


def held_out(ident: Column) -> Column:
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = SAMPLE_ROWS, languages: int = LANGUAGES) -> Model:
    allowed = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    seen = allowed.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in seen)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)))
    picked = F.lit(False)
    for r in seen:  # a language of few texts gives all of them
        picked = picked | ((F.col("lang") == r["lang"]) & hash_share(rows / r["count"], "id", "text"))
    small_batches(df.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                _, bucket, n = _counts([_bytes(text)])
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))[bucket] += n
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    found = (allowed.where(picked).select("lang", "text").mapInPandas(count, "lang string, bucket long, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    n = np.full((BUCKETS, len(names)), SMOOTHING)
    place = {name: k for k, name in enumerate(names)}
    np.add.at(n, (found["bucket"].to_numpy(dtype=np.int64), found["lang"].map(place).to_numpy(dtype=np.int64)),
              found["n"].to_numpy(dtype=float))
    return Model(names, np.log(n / n.sum(axis=0)))


def _within(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=0)


def proportions(starts: np.ndarray, bucket: np.ndarray, n: np.ndarray, logs: np.ndarray,
                table: np.ndarray) -> np.ndarray:
    """(texts, languages): the proportions of each text's selected set, by the
    counts of its buckets (``starts`` of each text; none is empty)."""
    texts, k = len(starts), logs.shape[1]
    weight = n / OVERLAP
    total = _within(weight, starts)
    single = _within(logs[bucket] * weight[:, None], starts)
    share = np.zeros((texts, k))
    share[np.arange(texts), single.argmax(axis=1)] = 1.0
    likelihood = single.max(axis=1)
    penalty = PENALTY * np.log(total * OVERLAP + 1.0)
    live = np.arange(texts)
    ends = np.append(starts[1:], len(bucket))
    for _ in range(k - 1):
        # the trigrams of the texts whose set may still grow
        sizes = ends[live] - starts[live]
        own = np.repeat(np.arange(len(live)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - starts[live], sizes)
        first = np.cumsum(sizes) - sizes
        p, w = table[bucket[at]], weight[at]
        mixed = np.einsum("gk,gk->g", p, share[live][own])
        gain = _within(p * (w / mixed)[:, None], first) - total[live][:, None]
        gain[share[live] > 0] = -np.inf
        add = gain.max(axis=1) > penalty[live]
        if not add.any():
            break
        keep = add[own]
        own = (np.cumsum(add) - 1)[own[keep]]
        p, w, new = p[keep], w[keep], gain[add].argmax(axis=1)
        live = live[add]
        first = np.searchsorted(own, np.arange(len(live)))
        pi = share[live].copy()
        members = (pi > 0).sum(axis=1)
        pi *= (members / (members + 1))[:, None]
        pi[np.arange(len(live)), new] = 1 / (members + 1)
        for _ in range(STEPS):
            part = p * pi[own]
            old, pi = pi, _within(part * (w / part.sum(axis=1))[:, None], first) / total[live][:, None]
            if np.abs(pi - old).max() < CLOSE:
                break
        better = _within(np.log(np.einsum("gk,gk->g", p, pi[own])) * w, first)
        stay = better - likelihood[live] > penalty[live]
        live = live[stay]
        share[live], likelihood[live] = pi[stay], better[stay]
        if not len(live):
            break
    return share


def annotate(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the input row) and ``found`` (lang, score, languages by
    falling share, shares)."""
    small_batches(df.sparkSession)
    names, logs = model.names, model.logs

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = np.exp(logs)
        for texts in batches:
            out = [(UNKNOWN, 0.0, [], [])] * len(texts)
            known = [i for i, t in enumerate(texts) if names and t is not None and any(map(str.isalpha, t))]
            chosen = [texts.iloc[i] for i in known]
            for first, starts, bucket, n in counted(chosen):
                share = proportions(starts, bucket, n, logs, table)
                size = np.add.reduceat(n, starts)
                for j, pi in enumerate(share):
                    order = [k for k in np.argsort(-pi, kind="stable") if pi[k] > 0]
                    out[known[first + j]] = (names[order[0]], (size[j] * pi[order[0]] + 1) / (size[j] + len(names)),
                                             [names[k] for k in order], pi[order].tolist())
            yield pd.DataFrame(out, columns=FOUND.names)

    return packed(df).withColumn("found", run(F.col("row")[text_col]))
