"""Mixing sources to target weights with soft memberships.

1. A softmax classifier over hashed text features, fitted on a bounded sample
   of the labelled table, predicts for every document the posterior
   probability p_k of each domain.
2. Nonnegative document rates r bring the expected domain token totals
   s_k = sum of tokens * r * p_k  to the targets T_k: they minimise
   (s - T)' M (s - T) + ``PULL`` * sum of tokens * (r - r0)^2, where M is the
   inverse of G = sum of tokens * p p' and r0 the equal rate; the small pull
   makes the rates unique (those nearest to equal ones).
   Projected gradient, scaled by the inverse Hessian over the rows that are not
   at zero (two-metric projection), r <- max(0, r - step): from equal rates on,
   rates keep the form max(0, r0 - p.y), so an iteration is one distributed sum
   of K + K^2 numbers over plain columns, only y is carried along, and nothing
   per document leaves the executors. A step that does not lower the gradient is
   halved. It ends when the gradient has fallen to ``CLOSE``; ``Rates`` says
   whether it has, and which totals were aimed at and reached.
3. A rate becomes copies: its whole part, and one more when a hash of the id
   falls below the rest.

Every statistic (G, totals, residuals) covers all rows. Defined results:
NULL and empty texts have no tokens, a posterior by their bins, and a rate
like others; rows with a NULL id share one hash; a domain that no labelled
row has gets posterior zero and its target is out of reach (the others are
met as far as the pull allows); without any labels all domains are equally likely; an empty table
gives no rows; repeated rows get the same rate; other columns ride along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import hashing
from quire.llm.common import materialise, packed, small_batches

SAMPLE_ROWS = 6_000
RIDGE, FIT_STEPS, FIT_RATE = 1e-5, 200, 1.0
RIDGE_GRAM = 1e-9
LEAST_STEP = 1e-6
STEPS = 60      # far more than any run has needed; beyond that ``converged`` is false
CLOSE = 1e-9
PULL = 1e-5
DOMAINS = ("clean", "toxic", "junk")
TARGETS = {"clean": 0.92, "toxic": 0.02, "junk": 0.06}
GROWTH = 1.1  # expected tokens after mixing, as a share of those before
MEMBER = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))])


def domains_of(labels: DataFrame, id_col: str = "doc_id", domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """(id, domain number) of the label table: toxic, junk (quality 0), clean;
    rows of other domains than those named are left out."""
    name = (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "clean"))
    number = F.lit(None)
    for k, d in enumerate(domains):
        number = F.when(name == d, k).otherwise(number)
    return labels.select(F.col(id_col), number.cast("int").alias("domain")).where("domain IS NOT NULL")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: hashing.Sparse, k: int) -> np.ndarray:
    """Weights (SIZE, k) of a softmax regression; -inf-like for domains that
    have no row."""
    if not rows.rows:
        return np.zeros((hashing.SIZE, k))
    truth = np.eye(k)[rows.label]

    def gradient(p):
        w = p.reshape(hashing.SIZE, k)
        scores = np.column_stack([rows.times(w[:, j]) for j in range(k)])
        d = (_softmax(scores) - truth) / rows.rows
        return (np.column_stack([rows.back(d[:, j]) for j in range(k)]) + RIDGE * w).ravel()

    w = hashing.descend(np.zeros(hashing.SIZE * k), gradient, FIT_STEPS, FIT_RATE).reshape(hashing.SIZE, k)
    empty = truth.sum(axis=0) == 0
    w[hashing.WORDS + hashing.SHAPES:, empty] = -50.0
    return w


def learn(df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          domains: int = len(DOMAINS), rows: int = SAMPLE_ROWS) -> np.ndarray:
    return fit(hashing.training_rows(hashing.sample(df, labelled, id_col, text_col, rows)), domains)


def _posteriors(texts: pd.Series, weights: np.ndarray) -> tuple[list[int], np.ndarray]:
    tokens, scores = [], np.zeros((len(texts), weights.shape[1]))
    for i, text in enumerate(texts):
        index, value, n = hashing.features(text)
        scores[i] = value @ weights[index]
        tokens.append(n)
    return tokens, _softmax(scores)


def members(df: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``member`` (tokens, p)."""
    small_batches(df.sparkSession)
    weights = weights.astype(np.float32)

    @F.pandas_udf(MEMBER)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            tokens, p = _posteriors(texts, weights)
            yield pd.DataFrame({"tokens": tokens, "p": list(p)})

    return packed(df).withColumn("member", run(F.col("row")[text_col]))


@dataclass
class Rates:
    """max(0, start - p.y), and what the iteration has reached."""
    start: float
    y: np.ndarray
    before: np.ndarray   # domain token totals at rate 1
    aim: np.ndarray
    reached: np.ndarray
    steps: int
    converged: bool

    def column(self, p) -> Column:
        shift = F.lit(0.0)
        for k, v in enumerate(self.y):
            shift = shift + p[k] * F.lit(float(v))
        return F.greatest(F.lit(0.0), F.lit(float(self.start)) - shift)


def solve(found: DataFrame, targets: np.ndarray, growth: float = GROWTH, steps: int = STEPS) -> Rates:
    """``found``: (tokens, p array<double>). All sums run over all rows."""
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    flat = found.select(F.col("tokens").cast("double").alias("t"), *[F.col("p")[i].alias(f"p{i}") for i in range(k)])

    def sums(start: float, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals under the rates of y, the Gram matrix of the rows above
        zero, and the sum of tokens * rate^2."""
        rate = Rates(start, y, y, y, y, 0, False).column([F.col(f"p{i}") for i in range(k)])
        own = flat.withColumn("r", rate)
        free = F.when(F.col("r") > 0, F.col("t")).otherwise(0.0)
        got = own.agg(*[F.sum(F.col("t") * F.col("r") * F.col(f"p{i}")) for i in range(k)],
                      *[F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in pairs],
                      F.sum(F.col("t") * F.col("r") * F.col("r"))).first()
        values = np.array([x or 0.0 for x in got])  # an empty table has no sums
        gram = np.zeros((k, k))
        for (i, j), x in zip(pairs, values[k:]):
            gram[i, j] = gram[j, i] = x
        return values[:k], gram, values[-1]

    y = np.zeros(k)
    before, gram, square = sums(1.0, y)
    aim = before.sum() * growth * targets / targets.sum()
    whole = gram + RIDGE_GRAM * (np.trace(gram) + 1.0) * np.eye(k)  # the inverse of M

    def value(y, square):
        return PULL * y @ whole @ y / 2 + square / 2 + aim @ y

    def slope(y, total):
        return PULL * whole @ y - total + aim

    def norm(g):
        return float(np.linalg.norm(np.linalg.solve(whole, g)))

    total, done = before * growth, 0
    now, g = value(y, square * growth ** 2), slope(y, total)
    aimed = max(1.0, norm(aim))
    while norm(g) > CLOSE * aimed and done < steps:
        step = np.linalg.lstsq(PULL * whole + gram, g, rcond=1e-13)[0]  # rows may all be alike
        size = 1.0
        while size > LEAST_STEP:
            done += 1
            new_total, new_gram, square = sums(growth, y - size * step)
            new = value(y - size * step, square)
            if new <= now - 1e-4 * size * g @ step:
                break
            size /= 2
        else:
            break  # rounding is all that is left
        y, total, gram, now = y - size * step, new_total, new_gram, new
        g = slope(y, total)
    return Rates(growth, y, before, aim, total, done, bool(norm(g) <= 1000 * CLOSE * aimed))


def mix(df: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id",
        text_col: str = "text", growth: float = GROWTH) -> tuple[DataFrame, Rates]:
    """(id, tokens, p, rate, copies), one row per input row; what the rates
    aim at and reach."""
    order = list(targets)
    weights = learn(df, labelled, id_col, text_col, len(order))
    found = materialise(members(df, weights, text_col).select(
        F.col("row")[id_col].alias("id"), F.col("member")["tokens"].alias("tokens"), F.col("member")["p"].alias("p")))
    rates = solve(found.select("tokens", "p"), np.array([targets[d] for d in order], dtype=float), growth)
    return (found.withColumn("rate", rates.column(F.col("p"))).withColumn("copies", copies(F.col("rate"), F.col("id"))),
            rates)


def copies(rate, ident):
    spot = F.pmod(F.xxhash64(F.lit("mix"), ident), F.lit(1 << 32)) / float(1 << 32)
    return (F.floor(rate) + F.when(spot < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def repeated(df: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id",
             text_col: str = "text", growth: float = GROWTH) -> DataFrame:
    """The mixed table: each row as many times as its copies say, with the
    input's columns. Texts are not shuffled: posteriors and rates are
    computed where the row is read."""
    order = list(targets)
    weights = learn(df, labelled, id_col, text_col, len(order))
    found = members(df, weights, text_col)
    sums = materialise(found.select(F.col("member")["tokens"].alias("tokens"), F.col("member")["p"].alias("p")))
    rates = solve(sums, np.array([targets[d] for d in order], dtype=float), growth)
    n = copies(rates.column(F.col("member")["p"]), F.col("row")[id_col])
    return (found.select("row", n.alias("n")).where("n > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("n")))).select("row.*"))
