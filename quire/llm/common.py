"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import cut_lineage, ensure_checkpoint_dir

# A key is hot when it holds at least this share of the rows (and HOT_ROWS
# rows), so there are never more than 1 / HOT_SHARE hot keys: the bound
# under which tables of hot keys are broadcast.
HOT_SHARE = 1 / 1000
HOT_ROWS = 64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    return ensure_checkpoint_dir(spark)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table that several jobs read."""
    return cut_lineage(df)


BATCH_BYTES = "1m"


def small_batches(spark: SparkSession) -> None:
    """Rows reach Python workers in batches of bounded bytes, so very long
    documents do not add up in a worker's memory. Batches of short rows stay
    as they are; a bound that the session already has stays, too."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def stretches(texts, size: int) -> Iterator[list]:
    """Runs of texts of at most ``size`` characters in all; a longer text
    stands alone."""
    run, chars = [], 0
    for text in texts:
        n = len(text) if text is not None else 0
        if run and chars + n > size:
            yield run
            run, chars = [], 0
        run.append(text)
        chars += n
    if run:
        yield run


def hash_share(share: float, *cols) -> Column:
    """Rows whose 64-bit hash of the columns lies in the lowest ``share`` of
    all hashes: about that share of the rows, however small it is."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(F.lit("share"), *cols) < F.lit(-(1 << 63) + int(max(0.0, share) * (1 << 64)))


def packed(df: DataFrame) -> DataFrame:
    """The whole input row as one struct column ``row``: columns that an
    operator adds beside it cannot clash with those of its input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def hot_limit(rows: int) -> int:
    return max(HOT_ROWS, int(rows * HOT_SHARE) + 1)
