"""Sinks (F8, F9, F11, F12): sharded, distributed writers.

Every writer is a DataFrame write (one file per task, atomic job commit), so
a lost executor only re-runs its own tasks and no data passes the driver.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """F8: JSON lines, non-ASCII written as-is (Spark never escapes it)."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_predictions(df: DataFrame, path: str, label: str = "labels", predict: str = "predict") -> None:
    """``{labels, predict}`` JSON lines, both stripped."""
    from quire.operators.infer import predictions
    write_jsonl(predictions(df, label, predict), path)


def split_manifest(df: DataFrame, text_col: str = "text", split_col: str = "split") -> DataFrame:
    """rows and UTF-8 bytes per split (one aggregate)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("num_examples"),
                                     F.sum(F.octet_length(text_col)).cast("long").alias("num_bytes"))


def warn_identical_splits(df: DataFrame, text_col: str = "text", split_col: str = "split") -> list[tuple[str, str]]:
    """Report pairs of splits with identical content fingerprints
    (row count, byte count and an order-free hash sum); one small
    aggregate reaches the driver."""
    fp = df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("b"),
        F.sum(F.xxhash64(text_col).cast("decimal(38,0)")).alias("h")).collect()
    same = []
    for i, a in enumerate(fp):
        for b in fp[i + 1:]:
            if (a["n"], a["b"], a["h"]) == (b["n"], b["b"], b["h"]):
                same.append((a[split_col], b[split_col]))
                log.warning("splits %s and %s look identical", a[split_col], b[split_col])
    return same


def write_metrics(metrics: DataFrame, path: str, run: str, split: str) -> None:
    """metrics (metric, value) as rows (run, split, metric, value) with
    the ``{split}_`` prefix. A folder per run and split is replaced as a
    whole, so a repeated job leaves its rows once and others alone."""
    out = metrics.select(F.lit(run).alias("run"), F.lit(split).alias("split"),
                         F.concat(F.lit(split + "_"), F.col("metric")).alias("metric"),
                         F.col("value").cast("double").alias("value"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "split").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_metrics``; run and split stay text."""
    return spark.read.schema("metric string, value double, run string, split string").parquet(path) \
        .select("run", "split", "metric", "value")
