"""Resumable generation (I3), mergeable metrics (I6), metrics writer."""

import math
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import infer as inf
from quire.operators import partials as pt
from quire.sources import sinks as sk


def counting(log, bad=None):
    """A generator that notes every prompt it is given and fails at ``bad``."""
    def factory():
        def gen(prompts: pd.Series) -> pd.Series:
            if bad is not None and bad in set(prompts):
                raise RuntimeError("model lost")
            with open(log, "a") as f:
                f.writelines(p + "\n" for p in prompts)
            return prompts + " !cut"
        return gen
    return factory


def test_failed_job_goes_on(spark, scratch):
    log, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    df = spark.createDataFrame([(i, f"p{i}", "x") for i in range(40)] + [(None, None, "x")], "k int, p string, quire_slice string") \
        .where("k IS NOT NULL")
    with pytest.raises(Exception, match="model lost"):
        inf.generate_resumable(df, "k", "p", counting(log, "p17"), out, slices=6, stop="!")
    before = open(log).read().split()
    kept = {r["k"] for r in spark.read.parquet(out).collect()}
    assert 0 < len(kept) < 40 and {f"p{k}" for k in kept} <= set(before)
    rows = inf.generate_resumable(df, "k", "p", counting(log), out, slices=6, stop="!").collect()
    assert sorted((r["k"], r["Input"], r["Output"]) for r in rows) == [(i, f"p{i}", f"p{i}") for i in sorted(range(40))]
    after = open(log).read().split()[len(before):]
    assert not {f"p{k}" for k in kept} & set(after)  # a committed row is not generated again
    more = df.unionByName(spark.createDataFrame([(99, "p99", "x")], df.schema))
    size = len(open(log).read().split())
    assert inf.generate_resumable(more, "k", "p", counting(log), out, slices=6, stop="!").count() == 41
    assert open(log).read().split()[size:] == ["p99"]
    few = inf.generate_resumable(df.where("k < 3"), "k", "p", counting(log), out, slices=6, stop="!")
    assert few.count() == 3  # of a smaller table only its own rows come back
    empty = inf.generate_resumable(df.where("k < 0"), "k", "p", counting(log), out + "0", slices=2)
    assert empty.collect() == [] and empty.columns == ["k", "Input", "Output"]


def test_resumable_keys(spark, scratch):
    with pytest.raises(TypeError):
        inf.generate_resumable(spark.range(2).select(F.col("id").cast("double").alias("k"), F.lit("p").alias("p")),
                               "k", "p", counting("x"), scratch + "/o")
    with pytest.raises(ValueError):
        inf.generate_resumable(spark.range(2).select(F.col("id").alias("Input"), F.lit("p").alias("p")),
                               "Input", "p", counting("x"), scratch + "/o")


@pytest.mark.parametrize("parts", [1, 7])
def test_merged_metrics(spark, parts):
    data = [(("a", "b", None)[i % 3], i % 2 == 0, None if i % 11 == 0 else float(i), i % 4, i * i % 3) for i in range(500)]
    df = spark.createDataFrame(data, "key string, even boolean, v double, m0 int, g int").repartition(parts)
    got = pt.merge_metrics(df, {"rms": pt.root_mean_square("v"), "f1": pt.macro_f1("m0", "g")}, ["key", "even"], slices=3)
    assert got.columns == ["key", "even", "rms", "f1"] and got.count() == 6
    for r in got.collect():
        mine = [x for x in data if x[0] == r["key"] and x[1] == r["even"]]
        vals = [x[2] for x in mine if x[2] is not None]
        assert math.isclose(r["rms"], math.sqrt(sum(v * v for v in vals) / len(vals)), rel_tol=1e-12)
        f1 = []
        for c in sorted({x[3] for x in mine} | {x[4] for x in mine}):
            size = sum(x[3] == c for x in mine) + sum(x[4] == c for x in mine)
            f1.append(2 * sum(x[3] == x[4] == c for x in mine) / size)
        assert math.isclose(r["f1"], sum(f1) / len(f1), rel_tol=1e-12)
    whole = pt.merge_metrics(df, {"rms": pt.root_mean_square("v")}).collect()
    vals = [x[2] for x in data if x[2] is not None]
    assert len(whole) == 1 and math.isclose(whole[0]["rms"], math.sqrt(sum(v * v for v in vals) / len(vals)), rel_tol=1e-12)


def test_group_of_all_rows_is_folded_by_every_task(spark):
    def update(s, pdf):
        return max(s, len(pdf))
    widest = pt.Metric(lambda: 0, update, max, float, ("id",))
    df = spark.range(0, 80_000, numPartitions=8)
    assert pt.merge_metrics(df, {"most": widest}).first()["most"] <= 10_000


def test_metric_edges(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert pt.merge_metrics(df, {"rms": pt.root_mean_square("v")}, "g").collect() == [("a", None)]
    assert pt.merge_metrics(df.where("false"), {"rms": pt.root_mean_square("v")}, "g").collect() == []
    dec = spark.sql("SELECT CAST(1.10 AS DECIMAL(10,2)) AS d, DATE '2020-01-02' AS t, 9007199254740993L AS n, 2.0D AS v")
    r = pt.merge_metrics(dec, {"rms": pt.root_mean_square("v")}, ["d", "t", "n"]).first()
    assert (str(r["d"]), str(r["t"]), r["n"], r["rms"]) == ("1.10", "2020-01-02", 9007199254740993, 2.0)
    with pytest.raises(TypeError):
        pt.merge_metrics(df, {"rms": pt.root_mean_square("v")}, "v")
    with pytest.raises(ValueError):
        pt.merge_metrics(df, {"g": pt.root_mean_square("v")}, "g")


def test_many_groups_are_handed_on(spark):
    df = spark.range(0, 3_000, numPartitions=2).select((F.col("id") % 300).alias("g"), F.lit(2.0).alias("v"))
    rows = pt.merge_metrics(df, {"rms": pt.root_mean_square("v")}, "g", groups_at_once=5).collect()
    assert len(rows) == 300 and {r["rms"] for r in rows} == {2.0}


def test_metrics_are_written_once(spark, scratch):
    path = scratch + "/m"
    rows = spark.createDataFrame([("loss", 1.0), ("acc", 0.5)], "metric string, value double")
    sk.write_metrics(rows, path, "007", "eval")
    sk.write_metrics(rows, path, "007", "test")
    sk.write_metrics(rows.where("metric = 'loss'"), path, "007", "eval")
    got = sorted(map(tuple, sk.read_metrics(spark, path).collect()))
    assert got == [("007", "eval", "eval_loss", 1.0), ("007", "test", "test_acc", 0.5), ("007", "test", "test_loss", 1.0)]


def test_predictions_are_written(spark, scratch):
    df = spark.createDataFrame([(" é ", "b\n"), ("", None)], "labels string, predict string")
    sk.write_predictions(df, scratch + "/p")
    back = spark.read.schema("labels string, predict string").json(scratch + "/p")
    assert sorted(map(tuple, back.collect()), key=str) == [("", None), ("é", "b")]
