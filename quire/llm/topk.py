"""Exact top-k search by inner product with a pivot-distance index.

Vectors are made integers by floor(256 x). One further coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, gives all of them the same norm,
and a query gets zero there: then <q, x> = (|q|^2 + M^2 - d(q, x)^2) / 2, so
the largest scores are the nearest neighbours in a metric space.

Index: every vector is keyed by its nearest pivot and its distance to it, and
the table is range-partitioned and sorted by (pivot, distance, id); runs of
``ANNULUS`` rows of one pivot are annuli. The pivots come from a bounded
sample (about ``SAMPLE_ROWS`` vectors, chosen by a hash of the id); every row
is indexed. Splitters include the id, so many copies of one vector spread
over partitions.

Search: the triangle inequality bounds the distance of a query to anything in
an annulus by its distance to the pivot, hence its score from above. A task
takes its annuli for each query in the order of these bounds and stops at the
first one below the k-th best score known: that of the sample to begin with,
that of its own results as they improve. Only rows at least that good leave
the task. Bounds have a slack for rounding, scores are exact (integers in
doubles below 2**53, else in 64-bit integers), so the result is exact.

Queries are searched in blocks of ``QUERY_ROWS``; a block is collected and
broadcast (at most QUERY_ROWS vectors), whatever the size of the table.

Defined results: NULL vectors, and those with NULL or non-finite components,
take no part, nor do rows without id; of rows that repeat an id the smallest
vector stands for it; shorter vectors are filled with zeros; fewer than k
other vectors give fewer ranks; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import hash_share, materialise

SAMPLE_ROWS = 4096
PIVOTS = 64
ANNULUS = 512
PARTITION_ROWS = 8192
QUERY_ROWS = 8192
SCALE = 256


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<long>): one row per id."""
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vector_col, lambda x: F.floor(SCALE * x.cast("double"))).alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def _matrix(vectors, width: int, dtype) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=dtype)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """The vectors with the coordinate that gives all of them norm M."""
    y = x.astype(np.float64)
    return np.column_stack([y, np.sqrt(np.maximum(0.0, norm2 - (y * y).sum(axis=1)))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T))


def choose_pivots(points: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Farthest-first centres, then a few rounds of k-means."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    chosen = [0]
    far = _distances(points, points[:1])[:, 0]
    while len(chosen) < min(count, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(points, points[chosen[-1]:chosen[-1] + 1])[:, 0])
    centres = points[chosen]
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(axis=1)
        centres = np.stack([points[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k]
                            for k in range(len(centres))])
    return centres


def build(vectors: DataFrame, width: int, norm2: float, pivots: np.ndarray, rows: int) -> DataFrame:
    """(pivot, distance, id, v), partitioned and sorted by the first three."""
    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d = _distances(_lifted(_matrix(pdf["v"], width, np.float64), norm2), pivots)
            nearest = d.argmin(axis=1) if len(pdf) else np.zeros(0, int)
            yield pdf.assign(pivot=nearest.astype(np.int32), distance=d[np.arange(len(pdf)), nearest])

    keyed = vectors.mapInPandas(key, "id long, v array<long>, pivot int, distance double")
    return materialise(keyed.repartitionByRange(max(1, -(-rows // PARTITION_ROWS)), "pivot", "distance", "id")
                       .sortWithinPartitions("pivot", "distance", "id"))


class _Best:
    """The k best (score, id) of one query, larger scores and smaller ids
    first; ``floor`` is the score that a row must reach."""

    __slots__ = ("k", "score", "ident", "floor")

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.score, self.ident = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ident: np.ndarray) -> None:
        score, ident = np.concatenate([self.score, score]), np.concatenate([self.ident, ident])
        order = np.lexsort((ident, -score))[:self.k]
        self.score, self.ident = score[order], ident[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


def search(index: DataFrame, queries: list, sample: np.ndarray, sample_ids: np.ndarray, width: int, norm2: float,
           pivots: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score) of one block: the k best of every partition
    that can be among the k best of all."""
    ids = np.array([q[0] for q in queries], dtype=np.int64)
    largest = float(norm2) ** 0.5
    dtype = np.float64 if largest * largest < 2.0 ** 52 else np.int64  # |<q, x>| <= M^2
    vectors = _matrix([q[1] for q in queries], width, dtype)
    block = index.sparkSession.sparkContext.broadcast((ids, vectors, sample.astype(dtype), sample_ids, pivots))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q_ids, q, sample, sample_ids, pivots = block.value
        parts = [(pdf["pivot"].to_numpy(), pdf["distance"].to_numpy(), pdf["id"].to_numpy(),
                  _matrix(pdf["v"], width, dtype)) for pdf in batches if len(pdf)]
        if not parts or not len(q):
            return
        pivot, distance, ident, x = (np.concatenate(c) for c in zip(*parts))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(pivot)) + 1, [len(pivot)]])
        edges = sorted({int(e) for lo, hi in zip(cuts, cuts[1:]) for e in range(lo, hi, ANNULUS)} | {len(pivot)})
        first, last = np.array(edges[:-1]), np.array(edges[1:]) - 1
        own, near, far = pivot[first], distance[first], distance[last]
        norms = (q.astype(np.float64) ** 2).sum(axis=1)
        lifted = np.column_stack([q.astype(np.float64), np.zeros(len(q))])
        out = []
        for at in range(0, len(q), 512):
            here = slice(at, at + 512)
            known = q[here] @ sample.T
            away = _distances(lifted[here], pivots)[:, own]
            least = np.maximum(0.0, np.maximum(away - far, near - away))
            least = np.maximum(0.0, least - 1e-6 * (1.0 + largest))   # slack for rounding
            above = (norms[here, None] + norm2 - least * least) / 2 + 1e-6 * (1.0 + norm2)
            for i, query in enumerate(q[here]):
                others = known[i][sample_ids != q_ids[at + i]]
                floor = int(np.partition(others, -k)[-k]) if len(others) >= k else -(1 << 62)
                best = _Best(k, floor)
                for a in np.argsort(-above[i], kind="stable"):
                    if above[i, a] < best.floor:
                        break  # no later annulus can hold a better row
                    lo, hi = edges[a], edges[a + 1]
                    score = x[lo:hi] @ query
                    good = np.flatnonzero((score >= best.floor) & (ident[lo:hi] != q_ids[at + i]))
                    if len(good):
                        best.add(score[good].astype(np.int64), ident[lo:hi][good])
                out.append((np.full(len(best.score), q_ids[at + i]), best.ident, best.score))
        found = [np.concatenate(c) for c in zip(*out)]
        yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    found = materialise(index.mapInPandas(run, "query_id long, vec_id long, score long"))
    block.destroy()  # the result is in the shared folder
    return found


def top_k(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector whose id fulfils
    ``is_query`` (a function of the id column) the k best others."""
    vectors = materialise(usable(df, id_col, vector_col))
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm2")).first()
    n, width, norm2 = sizes.n, max(1, sizes.width or 1), sizes.norm2 or 0.0
    share = min(1.0, SAMPLE_ROWS / max(1, n))
    chosen = vectors.where(hash_share(share, "id")).collect()  # about SAMPLE_ROWS
    chosen.sort(key=lambda r: r.id)
    sample = _matrix([r.v for r in chosen], width, np.int64)
    sample_ids = np.array([r.id for r in chosen], dtype=np.int64)
    pivots = choose_pivots(_lifted(sample, norm2), PIVOTS)
    index = build(vectors, width, norm2, pivots, n)
    # blocks of queries: ranges of their hash, each of about QUERY_ROWS rows
    asked = vectors.where(is_query(F.col("id")))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks)) == b).collect()
        part = search(index, [(r.id, r.v) for r in rows], sample, sample_ids, width, norm2, pivots, k)
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
