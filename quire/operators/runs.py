"""Run-log analytics.

A run log is a table (run, step, loss, ...). Interval statistics group by
(run, interval) — bounded groups; running statistics are windows
partitioned by run. The NaN rule (W4) is a sequential recurrence, folded
per (run, interval) group, whose size is the logging interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_weighted_mean(df: DataFrame, loss: str, rows: str, group_cols=()) -> DataFrame:
    """Batch losses weighted by their real row counts."""
    agg = (F.sum(F.col(loss) * F.col(rows)) / F.sum(rows)).alias("eval_loss")
    return df.groupBy(*group_cols).agg(agg) if group_cols else df.agg(agg)


def prefixed_metrics(df: DataFrame, group_col: str, metric_cols, prefix: str = "eval") -> DataFrame:
    """Per-dataset metrics as rows named ``<prefix>_<group>_<metric>``
    (unpivot by ``stack``; no shuffle beyond the caller's aggregate)."""
    parts = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metric_cols)
    long = df.select(group_col, F.expr(f"stack({len(metric_cols)}, {parts}) as (metric, value)"))
    return long.select(F.concat_ws("_", F.lit(prefix), F.col(group_col), F.col("metric")).alias("name"), "value")


def metrics_map_prefix(m: Column, prefix: str) -> Column:
    """prefix every key of a metrics map (``transform_keys``)."""
    return F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix + "_"), k))


def capped_count(df: DataFrame, max_samples: int | None) -> Column:
    """A10: min(max_samples, len)."""
    n = F.count(F.lit(1))
    return n if max_samples is None else F.least(n, F.lit(max_samples))


def throughput(df: DataFrame, group_col: str, ts: str, total_batch: int) -> DataFrame:
    """Samples and steps per second; steps = ceil(samples / batch)."""
    t = F.col(ts).cast("timestamp")
    secs = (F.unix_micros(F.max(t)) - F.unix_micros(F.min(t))) / F.lit(1e6)
    out = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("samples"), secs.alias("runtime"))
    steps = F.ceil(F.col("samples") / F.lit(total_batch))
    return out.select(group_col, "samples", "runtime", steps.alias("steps"),
                      F.when(F.col("runtime") > 0, F.col("samples") / F.col("runtime")).alias("samples_per_second"),
                      F.when(F.col("runtime") > 0, steps / F.col("runtime")).alias("steps_per_second"))


def best_trial(trials: DataFrame, trial_col: str, objective: str, direction: str = "minimize") -> DataFrame:
    """Best objective over trials, ties to the lowest trial id."""
    key = F.struct(F.col(objective) if direction == "minimize" else -F.col(objective), F.col(trial_col))
    return trials.agg(F.min_by(trial_col, key).alias("best_trial"),
                      (F.min(objective) if direction == "minimize" else F.max(objective)).alias("best_objective"))


def default_objective(metrics: Column) -> Column:
    """A13 default objective of a metrics map: the sum of all metrics but the
    evaluation loss, the epoch and the speed figures; the evaluation loss
    only where nothing else is left."""
    others = F.map_filter(metrics, lambda k, v: ~k.isin("eval_loss", "epoch") & ~k.endswith("_runtime")
                          & ~k.endswith("_per_second"))
    total = F.aggregate(F.map_values(others), F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(others) > 0, total).otherwise(F.try_element_at(metrics, F.lit("eval_loss")).cast("double"))


def clear_segments(df: DataFrame, user: str, order: str, is_clear: Column, is_empty: Column | None = None) -> DataFrame:
    """A clear command starts a new history; empty inputs are skipped.
    segment = number of clears so far per user: a two-pass prefix sum
    (Q2-style buckets), so one very active user is not a single task."""
    from quire.operators.order import running_sum
    out = df if is_empty is None else df.where(~is_empty)
    out = out.withColumn("is_clear", is_clear)
    return running_sum(out, F.when(F.col("is_clear"), 1).otherwise(0), [order], [user], name="segment")


def interval_loss(df: DataFrame, run: str, step: str, loss: str, logging_steps: int,
                  epoch: str | None = None) -> DataFrame:
    """Mean loss since the last log, rounded to 4 digits; with ``epoch``
    (a fraction) also the epoch of the log, rounded to 2."""
    interval = F.ceil(F.col(step) / F.lit(logging_steps)).cast("long")
    more = [] if epoch is None else [F.bround(F.max(epoch), 2).alias("epoch")]
    return df.groupBy(run, interval.alias("interval")).agg(
        F.bround(F.avg(loss), 4).alias("loss"), F.max(step).alias("step"), F.count(F.lit(1)).alias("steps"), *more)


def _nan_fold(xs: Column) -> Column:
    """(sum, steps) of a sorted array<struct<s, l>> by the NaN rule."""
    init = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("k"))

    def step_fn(acc, x):
        bad = F.isnan(x["l"]) | (F.abs(x["l"]) == F.lit(float("inf")))
        add = F.when(bad, acc["sum"] / (F.lit(1) + acc["k"])).otherwise(x["l"])
        return F.struct((acc["sum"] + add).alias("sum"), (acc["k"] + 1).alias("k"))
    return F.aggregate(xs, init, step_fn)


def nan_filtered_sum(xs: Column) -> Column:
    return _nan_fold(xs)["sum"]


def nan_filtered_interval(df: DataFrame, run: str, step: str, loss: str, logging_steps: int) -> DataFrame:
    """Inside one logging interval, a NaN/inf step adds
    running_sum / (1 + steps since the last log) instead of its loss;
    logged value = running sum / steps, rounded to 4 digits."""
    interval = F.ceil(F.col(step) / F.lit(logging_steps)).cast("long")
    g = df.groupBy(run, interval.alias("interval")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(step).alias("s"), F.col(loss).cast("double").alias("l")))).alias("xs"))
    folded = _nan_fold(F.col("xs"))
    return g.select(run, "interval", folded["sum"].alias("running_sum"), folded["k"].alias("steps"),
                    F.bround(folded["sum"] / folded["k"], 4).alias("loss"))


def best_so_far(df: DataFrame, run: str, step: str, metric: str, greater_is_better: bool = True) -> DataFrame:
    """Running best with a strict comparison (first value wins ties).
    A leading NaN compares false against everything, so it stays best.

    One two-pass prefix maximum (``running_agg``) over (value, -step, metric):
    the greatest value so far, of equal ones the earliest, with its metric
    carried along. A very long run is spread over many tasks."""
    from quire.operators.order import running_agg
    sign = 1.0 if greater_is_better else -1.0
    value = F.col(metric) * F.lit(sign)
    cand = F.when(F.col(metric).isNotNull() & ~F.isnan(F.col(metric)),
                  F.struct(value.alias("v"), (-F.col(step)).alias("back"), F.col(metric).alias("m")))
    heads = df.groupBy(F.col(run).alias("__run")).agg(
        F.min(F.struct(F.col(step).alias("s"), F.isnan(F.col(metric)).alias("nan"), F.col(metric).alias("m"))).alias("__head"))
    out = running_agg(df.select(run, step, metric), cand, [step], [run], "max", name="__best")
    out = out.join(heads, F.col(run).eqNullSafe(F.col("__run")))
    stuck = F.col("__head")["nan"]
    return out.select(run, step, metric,
                      F.when(stuck, F.col("__head")["s"]).otherwise(-F.col("__best")["back"]).alias("best_step"),
                      F.when(stuck, F.col("__head")["m"]).otherwise(F.col("__best")["m"]).alias("best_metric"))
