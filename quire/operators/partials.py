"""Mergeable metrics (I6): user metrics as init, update, merge and finish.

A grouped Arrow aggregate brings every row of a group into one task. Here a
task folds its own rows into one small state per group, the states are merged
in two steps (first by group and a slice of the tasks, then by group), each
as a stream over states sorted by group, and only finished values remain: one
group of all rows is read by every task, and no task holds more than one
state beside those that it is folding.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_TYPES = (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.DecimalType)


@dataclass(frozen=True)
class Metric:
    """``update(state, frame)`` folds rows (a pandas frame of the columns),
    ``merge(state, state)`` must be associative and commutative, ``finish``
    gives a float or None. States are pickled."""
    init: Callable[[], object]
    update: Callable[[object, pd.DataFrame], object]
    merge: Callable[[object, object], object]
    finish: Callable[[object], float | None]
    columns: tuple[str, ...]


def _merged(metrics: dict[str, Metric], rows):
    """(key, states) per run of equal keys of (key, pickled states)."""
    last, states = None, None
    for key, data in rows:
        new = pickle.loads(data)
        if states is not None and key == last:
            states = {m: metrics[m].merge(states[m], new[m]) for m in metrics}
            continue
        if states is not None:
            yield last, states
        last, states = key, new
    if states is not None:
        yield last, states


def _frames(rows, size: int = 1_000):
    batch = []
    for r in rows:
        batch.append(r)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def merge_metrics(df: DataFrame, metrics: dict[str, Metric], group_cols=(), slices: int = 64,
                  groups_at_once: int = 10_000) -> DataFrame:
    """One row per group with a double per metric. NULL group values are
    a group. Without group columns there is one group of all rows; of an
    empty table it has no row. Group columns may be text, whole numbers,
    booleans, dates and decimals (they travel as JSON text). ``slices`` is
    how many tasks share the first merging of a group's states. A task that
    has met ``groups_at_once`` groups hands its states on early and begins
    anew, which merging makes good."""
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    fields = [df.schema[c] for c in group_cols]
    for f in fields:
        if not isinstance(f.dataType, KEY_TYPES):
            raise TypeError(f"group column {f.name}: {f.dataType.simpleString()}")
    if set(group_cols) & set(metrics):
        raise ValueError("a metric is named like a group column")
    read = list(dict.fromkeys(c for m in metrics.values() for c in m.columns))
    # positions as names: no clash with the caller's columns
    key = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(group_cols)]),
                    {"ignoreNullFields": "false"}) if group_cols else F.lit("{}")
    rows = df.select(key.alias("key"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(read)])

    def fold(it):
        states: dict = {}

        def handed_on():
            for batch in _frames(states.items()):
                yield pd.DataFrame({"key": [k for k, _ in batch], "state": [pickle.dumps(s) for _, s in batch]})
        for pdf in it:
            for k, rows_ in pdf.groupby("key", sort=False):
                rows_ = rows_.drop(columns="key").set_axis(read, axis=1)
                s = states.get(k)
                if s is None:
                    s = {n: m.init() for n, m in metrics.items()}
                states[k] = {n: m.update(s[n], rows_[list(m.columns)]) for n, m in metrics.items()}
            if len(states) > groups_at_once:
                yield from handed_on()
                states.clear()
        yield from handed_on()

    def merge(it):
        pairs = ((k, s) for pdf in it for k, s in zip(pdf["key"], pdf["state"]))
        for batch in _frames(_merged(metrics, pairs)):
            yield pd.DataFrame({"key": [k for k, _ in batch], "state": [pickle.dumps(s) for _, s in batch]})

    def finish(it):
        pairs = ((k, s) for pdf in it for k, s in zip(pdf["key"], pdf["state"]))
        for batch in _frames(_merged(metrics, pairs)):
            out = pd.DataFrame({"key": [k for k, _ in batch]})
            for i, (n, m) in enumerate(metrics.items()):
                out[f"m{i}"] = pd.Series([m.finish(s[n]) for _, s in batch], dtype="float64")
            yield out
    partials = rows.mapInPandas(fold, "key string, state binary")
    sliced = (partials.withColumn("slice", F.spark_partition_id() % slices)
              .repartition("key", "slice").sortWithinPartitions("key", "slice").select("key", "state"))
    once = sliced.mapInPandas(merge, "key string, state binary")
    values = ", ".join(f"m{i} double" for i in range(len(metrics)))
    done = (once.repartition("key").sortWithinPartitions("key")
            .mapInPandas(finish, f"key string, {values}"))
    schema = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)])
    parsed = F.from_json("key", schema) if fields else None
    out = done.withColumn("g", parsed) if fields else done
    return out.select(*[F.col(f"g.k{i}").alias(c) for i, c in enumerate(group_cols)],
                      *[F.col(f"m{i}").alias(n) for i, n in enumerate(metrics)])


def root_mean_square(column: str) -> Metric:
    """Root of the mean square of the non-NULL values, by merging (count,
    mean of squares), so that no sum of squares overflows; None of none."""
    def fold(s, n, mean):
        if not n:
            return s
        total = s[0] + n
        return (total, s[1] + (mean - s[1]) * n / total)

    def update(s, pdf):
        v = pdf[column].dropna().astype("float64")
        return fold(s, len(v), float((v * v).mean()) if len(v) else 0.0)
    return Metric(lambda: (0, 0.0), update, lambda a, b: fold(a, *b),
                  lambda s: math.sqrt(s[1]) if s[0] else None, (column,))


def macro_f1(label: str, predicted: str) -> Metric:
    """Mean F1 over the classes of either column; the state counts
    (label, predicted) pairs, so it grows with the classes, not the rows."""
    def update(s, pdf):
        n = pdf.dropna().value_counts([label, predicted])
        for (a, b), k in n.items():
            s[a, b] = s.get((a, b), 0) + int(k)
        return s

    def merge(s, t):
        for k, n in t.items():
            s[k] = s.get(k, 0) + n
        return s

    def finish(s):
        classes = {c for k in s for c in k}
        hits = {c: s.get((c, c), 0) for c in classes}
        size = {c: sum(n for (a, b), n in s.items() if a == c) + sum(n for (a, b), n in s.items() if b == c)
                for c in classes}
        return sum(2 * hits[c] / size[c] for c in sorted(classes, key=str)) / len(classes) if classes else None
    return Metric(dict, update, merge, finish, (label, predicted))
