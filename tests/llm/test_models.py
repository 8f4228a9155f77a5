"""Quality and mixing: fits, solver against a dense solution, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import hashing, mixing, quality

SCHEMA = "doc_id long, text string, row string, rate double, label int"
ODD = [(9001, None, "r", 1.0, 0), (9002, "", "r", None, 0), (9003, "good word " * 60_000, "r", 1.0, 0),
       (None, "good word", "r", 1.0, 0), (5, "good good", "r", 1.0, 0), (5, "good good", "r", 1.0, 0)]


def graded(n=600):
    words = ["junk rubbish noise", "fair middling passable", "good fine clear"]
    return [(i, f"{words[i % 3]} topic{i % 17} more{i % 29} text here", i % 3) for i in range(n)]


def test_ordinal_fit_orders_the_thresholds():
    rows = hashing.Sparse([(*hashing.features(t)[:2], g) for _, t, g in graded(60)])
    model = quality.fit(rows, 2)
    assert model.thresholds[0] < model.thresholds[1]
    scores = rows.times(model.weights)
    grade = (scores[:, None] > model.thresholds).sum(axis=1)
    assert (grade == rows.label).mean() > 0.95


def test_quality_orders_grades_and_treats_odd_rows(spark):
    data = [(i, t, "r", 0.0, g) for i, t, g in graded()] + ODD
    df = spark.createDataFrame(data, SCHEMA)
    ratings = spark.createDataFrame([(i, g) for i, _, g in graded()] + [(None, 1), (9002, None)], "doc_id long, grade int")
    model = quality.learn(df, ratings)
    got = quality.annotate(df, model).select("row.doc_id", "row.label", "rated.*").collect()
    assert len(got) == len(data) and all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    mean = [np.mean([r.expected_grade for r in got if r.label == g and r.doc_id is not None and r.doc_id < 600 and r.doc_id != 5])
            for g in range(3)]
    assert mean[0] < 0.3 < 0.7 < mean[1] < 1.3 < 1.7 < mean[2]
    kept = quality.select(df, model)
    assert kept.columns == df.columns and kept.where("doc_id < 600 AND label = 0 AND doc_id != 5").count() < 10


def test_empty_tables(spark):
    empty, none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, grade int")
    assert quality.select(empty, quality.learn(empty, none)).collect() == []
    some = spark.createDataFrame(ODD, SCHEMA)
    assert quality.select(some, quality.learn(some, none)).count() == len(ODD)
    assert mixing.mix(empty, none)[0].collect() == [] and mixing.repeated(empty, none).collect() == []
    assert mixing.mix(some, none)[0].count() == len(ODD)


def dense_rates(t, p, targets, growth):
    """The same least squares by a long plain projected gradient over all
    documents (with momentum), in one place."""
    gram = (p * t[:, None]).T @ p
    aim = gram.sum() * growth * targets / targets.sum()
    metric = np.linalg.inv(gram + mixing.RIDGE_GRAM * (np.trace(gram) + 1) * np.eye(len(targets)))
    r = ahead = np.full(len(t), growth)
    for i in range(60_000):
        slope = p @ (metric @ (p.T @ (t * ahead) - aim)) + mixing.PULL * (ahead - growth)
        last, r = r, np.maximum(0.0, ahead - slope / (1 + mixing.PULL))
        if (slope * (r - last)).sum() > 0:
            ahead = r  # start the momentum anew
        else:
            ahead = r + (i % 2000) / (i % 2000 + 3) * (r - last)
    return r, aim


@pytest.mark.parametrize("targets,growth", [([0.5, 0.3, 0.2], 1.0), ([0.9, 0.05, 0.05], mixing.GROWTH),
                                            ([0.92, 0.02, 0.06], mixing.GROWTH), ([0.0, 0.0, 1.0], 2.0)])
def test_rates_equal_dense_least_squares(spark, targets, growth):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.4, 0.3, 0.3], 500)
    t = rng.integers(1, 500, 500)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>").repartition(5)
    got = mixing.solve(df, np.array(targets), growth=growth)
    assert got.converged and got.steps < mixing.STEPS
    want, aim = dense_rates(t, p, np.array(targets), growth)
    rows = df.select("tokens", "p", got.column(F.col("p")).alias("rate")).collect()
    r = {(x.tokens, tuple(x.p)): x.rate for x in rows}
    r = np.array([r[int(a), tuple(b.tolist())] for a, b in zip(t, p)])
    assert (r >= 0).all() and np.allclose(aim, got.aim)
    assert np.allclose((p * (t * r)[:, None]).sum(axis=0), got.reached)
    assert np.abs(r - want).max() < 0.02 * max(1.0, want.max())
    if all(targets):
        assert np.abs(got.reached - got.aim).sum() <= 1e-3 * got.aim.sum()


def test_query_reaches_its_targets(spark):
    from quire.llm.queries import QUERIES
    rows = QUERIES["op9_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.converged for r in rows)
    for k, d in enumerate(mixing.DOMAINS):
        total = sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows)
        assert total == pytest.approx(rows[0][f"reached_{d}"], rel=1e-9)
        assert total == pytest.approx(rows[0][f"aim_{d}"], rel=5e-3)


def test_mixing_treats_odd_rows(spark):
    data = [(i, t, "r", 0.0, g) for i, t, g in graded()] + ODD
    df = spark.createDataFrame(data, SCHEMA)
    labelled = spark.createDataFrame([(i, g) for i, _, g in graded()], "doc_id long, domain int")
    targets = {"bad": 0.1, "fair": 0.2, "good": 0.7}
    mixed = mixing.mix(df, labelled, targets, growth=1.0)[0].cache()
    assert mixed.count() == len(data) and mixed.where("rate IS NULL OR copies IS NULL OR copies < 0").count() == 0
    assert mixed.where("id = 9001").first().tokens == 0
    out = mixing.repeated(df, labelled, targets, growth=1.0)
    assert out.columns == df.columns
    want = {r.id: r.copies for r in mixed.where("id < 600 AND id != 5 AND copies > 0").collect()}
    assert {r.doc_id: r["count"] for r in out.where("doc_id < 600 AND doc_id != 5").groupBy("doc_id").count().collect()} == want


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, quality.grades_of(labels))
    hits = quality.annotate(docs.join(labels, "doc_id").where(hashing.held_out(F.col("doc_id"))), model) \
        .groupBy("row.quality", (F.col("rated.tail") >= 0.5).alias("kept")).count().collect()
    n = {(r.quality, r.kept): r["count"] for r in hits}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n.get((0, True), 0) <= 0.2 * n[0, False]
