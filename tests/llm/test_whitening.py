"""Whitening against a dense eigendecomposition, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import whitening
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, own string, row int"


def brute(vectors, components=8):
    """Integers, exact deviations, and the dense solution."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = x - sums / n
    cov = centred.T @ centred / n
    values, u = np.linalg.eigh(cov)
    values, u = values[::-1], u[:, ::-1]
    keep = min(components, int((values > 1e-12 * np.trace(cov)).sum()))
    return deviation, centred @ (u[:, :keep] / np.sqrt(values[:keep])), values[:keep] / np.trace(cov)


def compare(rows, ids, vectors, components=8):
    deviation, white, explained = brute(vectors, components)
    at = {i: k for k, i in enumerate(ids)}
    assert len(rows) == len(ids) * white.shape[1]
    got = np.zeros_like(white)
    for r in rows:
        assert r.n == len(ids) and r.deviation == deviation[at[r.vec_id]]
        assert r.identity_error < 1e-10
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.residual < 1e-12
        got[at[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-8


def test_query_equals_dense_solution(spark):
    data = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(QUERIES["op13_whitening"](spark, SF).collect(), [r.vec_id for r in data], [r.embedding for r in data])


@pytest.mark.parametrize("width,rank", [(3, 3), (20, 5), (90, 90)])
def test_shapes(spark, width, rank):
    rng = np.random.default_rng(width)
    v = (rng.standard_normal((400, rank)) * np.arange(1, rank + 1)) @ rng.standard_normal((rank, width))
    if rank < width:  # integers of full precision would not keep the rank
        v = np.hstack([np.round(v[:, :rank] * 64) / 1024, np.zeros((400, width - rank))])
    v = v.astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist(), "o", 1) for i, x in enumerate(v)], SCHEMA).repartition(7)
    got = whitening.whiten(df).select(F.col("row.vec_id").alias("vec_id"), "component", "n", "deviation", "whitened",
                                      "explained", "identity_error", "residual").collect()
    compare(got, list(range(400)), v)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = rng.standard_normal((60, 4)).astype(np.float32)
    rows = [(i, x.tolist(), "o", i) for i, x in enumerate(good)]
    rows += [(100, rows[0][1], None, None), (101, rows[0][1], "o", 1)]                       # repeats
    bad = [(200, None, "o", 1), (201, [1.0, None, 1.0, 1.0], "o", 1), (202, [1.0, float("nan"), 1.0, 1.0], "o", 1),
           (203, [1.0, float("inf"), 1.0, 1.0], "o", 1), (204, [], "o", 1), (205, [1.0, 2.0], "o", 1)]
    got = whitening.whiten(spark.createDataFrame(rows + bad, SCHEMA), components=2)
    assert got.select("row.*").columns == ["vec_id", "embedding", "own", "row"]
    compare(got.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual")
            .collect(), [r[0] for r in rows], [r[1] for r in rows], 2)
    ids = whitening.whiten(spark.createDataFrame([(None, r[1], "", 0) for r in rows], SCHEMA), components=1).collect()
    assert len(ids) == len(rows) and all(r.row.vec_id is None for r in ids)


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == []
    equal = spark.createDataFrame([(i, [0.5, 0.25], "", 0) for i in range(5)], SCHEMA)
    assert whitening.whiten(equal).collect() == []
    one = spark.createDataFrame([(1, [0.5, 0.25], "", 0)], SCHEMA)
    assert whitening.whiten(one).collect() == []


def test_exact_deviation_beyond_a_long():
    x = np.array([[float(1 << 40), 0.0], [0.0, 0.0], [3.0, 1.0]])
    n, sums = 1 << 20, [1 << 42, 7]
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]


def test_large_entries_stay_exact(spark):
    v = [[3.0e6, 1.0], [2.0e6, 2.0], [-1.0e6, 0.5]]
    got = whitening.whiten(spark.createDataFrame([(i, x, "", 0) for i, x in enumerate(v)], SCHEMA)).collect()
    deviation, _, _ = brute(np.array(v, dtype=np.float32))
    assert {r.row.vec_id: r.deviation for r in got} == {
        i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
