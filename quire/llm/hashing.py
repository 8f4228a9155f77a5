"""Hashed text features shared by the linear classifiers of this package.

A text is the set of its white-space separated words: each distinct word
gives its hashed lower-case core (presence, L2-normalised) and its hashed
shape (marks at its end, case, digits; as a share of the distinct words);
two one-hot bins tell the share of distinct words and the length. Training
uses a bounded sample of labelled rows; its features are fitted with numpy
on the driver (at most ``rows`` sparse vectors of at most SIZE entries)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import hash_share, small_batches

WORD_BITS, SHAPE_BITS, BINS = 14, 10, 16
WORDS, SHAPES = 1 << WORD_BITS, 1 << SHAPE_BITS
SIZE = WORDS + SHAPES + 2 * BINS
MEMO_WORDS = 1 << 17


PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%$&@-_/\\~`+=^"
PLAIN = [[zlib.crc32(f"plain|{upper}|{size}".encode()) % SHAPES for size in range(4)] for upper in range(2)]


class _Codes(dict):
    """word -> word bucket and shape bucket in one number; forgotten when
    it grows beyond its bound."""

    def __missing__(self, word: str) -> int:
        if word.isalpha():
            core, shape = word.lower(), PLAIN[len(word) > 1 and word.isupper()][min(len(word), 24) // 8]
        else:
            low = word.lower()
            core, bare = low.strip(PUNCTUATION), low.rstrip(PUNCTUATION)
            name = f"{low[len(bare):][:3]}|{word.isupper()}|{core.isalpha()}|{not core}|{min(len(core), 24) // 8}"
            shape = zlib.crc32(name.encode("utf-8", "surrogatepass")) % SHAPES
        code = zlib.crc32(core.encode("utf-8", "surrogatepass")) % WORDS << SHAPE_BITS | shape
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = code
        return code


_CODES = _Codes()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Indices, values and the number of words of one text."""
    words = (text or "").split()
    distinct = set(words)
    n = len(distinct)
    codes = np.sort(np.fromiter(map(_CODES.__getitem__, distinct), np.int64, n))
    bins = [WORDS + SHAPES + min(BINS - 1, int(BINS * n / max(1, len(words)))),
            WORDS + SHAPES + BINS + min(BINS - 1, int(np.log2(len(words) + 1)))]
    index = np.concatenate([codes >> SHAPE_BITS, WORDS + (codes & SHAPES - 1), bins]).astype(np.int32)
    value = np.concatenate([np.full(n, n ** -0.5 if n else 0.0), np.full(n, 1 / n if n else 0.0), [1.0, 1.0]])
    return index, value, len(words)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(df: DataFrame, labelled: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(text, label) of about ``rows`` labelled rows (``labelled``: id, label
    int), chosen by a hash of the id; those held out are left out. The chosen
    ids are broadcast, the texts are not moved."""
    usable = labelled.toDF("label_id", "label").where("label_id IS NOT NULL AND label IS NOT NULL") \
        .where(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("label").alias("label"))
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.where(hash_share(share, "label_id"))
    return (df.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), F.col("text_id") == F.col("label_id")).select("text", "label"))


class Sparse:
    """Rows of features (none is empty), and products with them."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]]):
        self.rows = len(rows)
        self.index = np.concatenate([*(r[0] for r in rows), np.zeros(0, np.int32)]).astype(np.int64)
        self.value = np.concatenate([*(r[1] for r in rows), np.zeros(0, np.float32)], dtype=np.float32)
        self.sizes = np.array([len(r[0]) for r in rows], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.label = np.array([r[2] for r in rows], dtype=np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.value * w[self.index], self.starts)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, self.value * np.repeat(g, self.sizes), SIZE)


def training_rows(chosen: DataFrame) -> Sparse:
    small_batches(chosen.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"index": [g[0].tobytes() for g in got],
                                "value": [g[1].astype(np.float32).tobytes() for g in got],
                                "label": pdf["label"].to_numpy()})

    # in a fixed order: the fit does not depend on the order of tasks
    rows = sorted((r["label"], bytes(r["index"]), bytes(r["value"])) for r in
                  chosen.mapInPandas(run, "index binary, value binary, label int").collect())
    return Sparse([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), label) for label, i, v in rows])


def descend(params: np.ndarray, gradient, steps: int = 120, rate: float = 0.25) -> np.ndarray:
    """Adam over the whole sample, with a falling rate."""
    m, v = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, steps + 1):
        g = gradient(params)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params - rate * (1 - k / (steps + 1)) * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return params
