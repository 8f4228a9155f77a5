"""Exact dedup by content sort.

Texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. Rows are range-partitioned by sampled
splitters over the normalised text, sorted (Spark's external sort), and the
window operator compares each row's whole normalised text with its
neighbour's, so equal rows form one run. Of a run the row with the most code
points in its original text stays, then the smallest id.

The splitters are taken over a bounded head of the normalised text followed
by its SHA-256, so that the sampled rows stay small on the driver; the
comparison itself is over whole texts.

Hot groups: one narrow pass counts the rows of each hash with map-side
combine. The rows of a hash that holds at least 1/1000 of all are dealt to salts,
so they are spread over many ranges, sorted and compared there as all others are;
each run of a salt sends one representative with its whole text, and the
representatives of all salts (at most ``SALTS`` runs of equal texts for each of
at most 1000 hot hashes) are compared with each other. So no decision rests on
the hash alone.

Defined results: a NULL text counts as empty; a NULL id sorts after all
others; of repeated identical rows exactly one is kept; an empty table gives
no rows; other columns ride along untouched in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import hot_limit, materialise, packed
from quire.session import broadcast_if_small

WHITE = "\t\n\x0b\x0c\r "
SPLIT_CHARS = 48
ROWS_PER_SALT, SALTS = 256, 1000
CLASS_ROWS = 1_000_000  # of the table of hot runs that is broadcast at most


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for ch in WHITE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def digest(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``: one row per input row."""
    text, ident = F.col("row")[text_col], F.col("row")[id_col]
    keyed = (packed(df)
             .withColumn("norm", normalised(text))
             .select("row", digest(F.col("norm")).alias("sha"),
                     F.substring("norm", 1, SPLIT_CHARS).alias("head"),
                     F.length(F.coalesce(text, F.lit(""))).alias("points")))
    rank = F.struct((-F.col("points")).alias("less"), ident.isNull().alias("unnamed"), ident.alias("id"))
    hot = materialise(keyed.groupBy("sha").agg(F.count(F.lit(1)).alias("hot_n"))
                      .where(F.col("hot_n") >= hot_limit(df.count())))
    salts = F.least(F.lit(SALTS), F.ceil(F.col("hot_n") / ROWS_PER_SALT))
    salt = F.when(F.col("hot_n").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(ident, F.col("points")), salts))
    place = Window.partitionBy("head", "sha", "salt")

    def ranged(rows: DataFrame) -> DataFrame:
        """Sorted by content; ``run`` numbers the different texts of a salt."""
        return (rows.withColumn("salt", salt.cast("int")).repartitionByRange("head", "sha", "salt")
                .withColumn("norm", normalised(text)).withColumn("run", F.dense_rank().over(place.orderBy("norm"))))

    # one representative of each run of a hot hash, compared over all salts
    runs = (ranged(keyed.join(F.broadcast(hot), "sha"))
            .groupBy("head", "sha", "salt", "run").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("best"),
                                                       F.first("norm").alias("norm")))
    same = Window.partitionBy("sha", "norm")
    classes = materialise(runs.select("head", "sha", "salt", "run", F.sum("n").over(same).alias("class_n"),
                                      F.min("best").over(same).alias("class_best")))
    run = Window.partitionBy("head", "sha", "salt", "norm")
    first = run.orderBy(F.col("points").desc(), ident.asc_nulls_last())
    is_hot = F.col("class_n").isNotNull()
    won = (F.col("points") == -F.col("class_best")["less"]) & ident.eqNullSafe(F.col("class_best")["id"])
    return (ranged(keyed.join(F.broadcast(hot), "sha", "left"))
            .withColumn("place", F.row_number().over(first))
            .withColumn("first_id", F.first(ident).over(first))
            .withColumn("n", F.count(F.lit(1)).over(run))
            .join(broadcast_if_small(classes, CLASS_ROWS), ["head", "sha", "salt", "run"], "left")
            .select("row",
                    F.when(is_hot, F.col("class_best")["id"]).otherwise(F.col("first_id")).alias("keep_id"),
                    F.when(is_hot, F.col("class_n")).otherwise(F.col("n")).alias("group_size"),
                    ((F.col("place") == 1) & (~is_hot | won)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the input's columns."""
    return annotate(df, id_col, text_col).where("kept").select("row.*")
