"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features and ordered thresholds
t_1 < ... < t_G: P(grade >= j) = sigmoid(w.x - t_j). All grades share the
weights; the thresholds stay ordered because their gaps are exponentials.
The model gives the expected grade and the tail probability by which rows
are selected. It is fitted on a bounded sample of rated rows
(``SAMPLE_ROWS`` in expectation); every whole text of every row is scored.

Defined results: NULL and empty texts have no words and are scored by their
bins alone; without ratings every tail probability is 1 and every row is
kept; a single grade in the ratings gives that grade; an empty table gives no
rows; repeated rows get the same score; other columns ride along in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import hashing
from quire.llm.common import packed, small_batches

SAMPLE_ROWS = 6_000
RIDGE = 1e-4
RATED = T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("tail", T.DoubleType())])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 1, 2, ...

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return sigmoid(score - self.thresholds)


def _thresholds(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def fit(rows: hashing.Sparse, grades: int) -> Ordinal:
    """``grades``: the highest grade; labels are 0..grades."""
    if not rows.rows:
        return Ordinal(np.zeros(hashing.SIZE), np.full(grades, -40.0))
    y, n = rows.label, rows.rows
    # each observed grade is an interval of the latent score: (t_y, t_{y+1})
    raw = np.concatenate([[0.0], np.zeros(grades - 1), np.zeros(hashing.SIZE)])

    def gradient(p):
        t = _thresholds(p[:grades])
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        eta = rows.times(p[grades:])
        low, high = sigmoid(eta - edges[y]), sigmoid(eta - edges[y + 1])  # P(>= y), P(>= y + 1)
        low[y == 0], high[y == grades] = 1.0, 0.0
        prob = np.maximum(low - high, 1e-9)
        d_low, d_high = low * (1 - low), high * (1 - high)
        g_eta = -(d_low - d_high) / prob / n
        g_t = np.zeros(grades)
        np.add.at(g_t, np.maximum(y - 1, 0), np.where(y > 0, d_low / prob, 0.0) / n)
        np.add.at(g_t, np.minimum(y, grades - 1), np.where(y < grades, -d_high / prob, 0.0) / n)
        tail = np.cumsum(g_t[::-1])[::-1]
        g_raw = np.concatenate([[tail[0]], tail[1:] * np.exp(p[1:grades])])
        return np.concatenate([g_raw + 1e-6 * p[:grades], rows.back(g_eta) + RIDGE * p[grades:]])

    p = hashing.descend(raw, gradient)
    return Ordinal(p[grades:], _thresholds(p[:grades]))


def learn(df: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grades: int = 2,
          rows: int = SAMPLE_ROWS) -> Ordinal:
    """``ratings``: (id, grade 0..grades)."""
    chosen = hashing.sample(df, ratings, id_col, text_col, rows)
    return fit(hashing.training_rows(chosen), grades)


def grades_of(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Graded ratings of a label table: 0 bad, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select(F.col(id_col), grade.cast("int").alias("grade"))


def annotate(df: DataFrame, model: Ordinal, text_col: str = "text", select_grade: int = 1) -> DataFrame:
    """``row`` (the input row), ``rated`` (expected_grade, and as ``tail``
    the probability of ``select_grade`` or more)."""
    small_batches(df.sparkSession)

    @F.pandas_udf(RATED)
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            tails = np.zeros((len(texts), len(model.thresholds)))
            for k, text in enumerate(texts):
                index, value, _ = hashing.features(text)
                tails[k] = model.tails(float(model.weights[index] @ value))
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail": tails[:, select_grade - 1]})

    return packed(df).withColumn("rated", rate(F.col("row")[text_col]))


def select(df: DataFrame, model: Ordinal, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose tail probability is at least ``least``."""
    return annotate(df, model, text_col).where(F.col("rated")["tail"] >= least).select("row.*")
