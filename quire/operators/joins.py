"""Joins that do not depend on the sizes of keys: a small side is broadcast
only under a measured bound of rows and bytes, and otherwise keys that hold a
large share of the rows are split by salt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage, fits_broadcast

HOT_SHARE, HOT_ROWS = 1 / 1000, 10_000  # a hot key holds at least this share of the rows, and so many
LOOKUP_ROWS = 2_000_000                 # of a side that is broadcast at most


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS, share: float = HOT_SHARE) -> DataFrame:
    """(keys, __salts): the keys that hold at least ``share`` of the rows (so
    there are at most 1 / share of them) and among how many salts each is
    dealt. One count with map-side combine."""
    counts = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= rows))
    total = df.count() if counts.limit(1).count() else 0
    limit = max(rows, int(total * share))
    return counts.where(F.col("__n") >= limit).withColumn("__salts", F.ceil(F.col("__n") / limit).cast("int")).drop("__n")


def split_join(big: DataFrame, side: DataFrame, keys, how: str = "inner", rows: int = HOT_ROWS,
               share: float = HOT_SHARE, lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``big.join(side, keys, how)`` (inner, left or left_semi) whatever the
    keys: a side that is measured small is broadcast. Otherwise the rows of a hot
    key of ``big`` are dealt to salts by a hash of the whole row, and the side's
    rows of that key are repeated for each salt; all others are joined as they
    are. NULL keys meet nothing."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if fits_broadcast(side, lookup_rows):
        return big.join(F.broadcast(side), keys, how)
    hot = F.broadcast(hot_keys(big, keys, rows, share))  # at most 1 / share rows
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    dealt = big.join(hot, keys, "left").withColumn("__salt", F.coalesce(F.pmod(whole, F.col("__salts")), F.lit(0)).cast("int")) \
        .drop("__salts")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    repeated = side.join(hot, keys, "left").withColumn("__salt", F.explode(salts)).drop("__salts")
    return dealt.join(repeated, [*keys, "__salt"], how).drop("__salt")
