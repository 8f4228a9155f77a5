"""Row identity, ordering, batching and sharding (Q*, P7-P9).

Spark has no row order, so every positional rule of the reference takes an
explicit order key. The dense index (Q2) uses no window over the table: rows
are range-partitioned by all their keys (Spark samples the splitters, so any
key type, NULLs and dominant first keys are spread over the tasks), sorted
inside each partition and numbered there; the partitions' counts, one row
each, give the offsets. NULL keys come first, as in Spark's own sort, and a
NULL group is a group like others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage

# monotonically_increasing_id() holds the partition above this bit and the
# row's place in its partition below it.
_PLACE_BITS = 33


def default_buckets(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ranged(df: DataFrame, partition_cols, order_cols, buckets: int | None) -> DataFrame:
    """The rows range-partitioned and sorted by (group, order), with
    ``__pid`` (partition), ``__pos`` (place in it) and ``__grp`` (the group
    as a struct, which joins NULLs with NULLs); checkpointed, so that the
    places are the same in every later job."""
    keys = [*partition_cols, *order_cols]
    b = default_buckets(df) if buckets is None else max(1, buckets)
    placed = (df.repartitionByRange(b, *keys).sortWithinPartitions(*keys)
              .withColumn("__id", F.monotonically_increasing_id()))
    group = F.struct(*partition_cols) if partition_cols else F.struct(F.lit(0).alias("all"))
    return cut_lineage(placed
                       .withColumn("__pid", F.shiftright("__id", _PLACE_BITS))
                       .withColumn("__pos", F.col("__id").bitwiseAND((1 << _PLACE_BITS) - 1))
                       .withColumn("__grp", group).drop("__id"))


def with_row_index(df: DataFrame, order_cols, partition_cols=(), name: str = "row_idx",
                   buckets: int | None = None) -> DataFrame:
    """Q2: dense 0-based index by ``order_cols`` (ascending, NULLs first; ties
    must be broken by the caller's key), optionally restarting per
    ``partition_cols``."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    partition_cols = list(partition_cols)
    placed = _ranged(df, partition_cols, order_cols, buckets)
    # one row per partition: at most ``buckets`` rows, so both the window and
    # the broadcast are bounded whatever the size of the table
    offsets = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).select(
        "__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    out = placed.join(F.broadcast(offsets), "__pid").withColumn(name, F.col("__off") + F.col("__pos"))
    if partition_cols:
        starts = out.groupBy("__grp").agg(F.min(name).alias("__start"))
        out = out.join(starts, "__grp").withColumn(name, F.col(name) - F.col("__start")).drop("__start")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col(name).cast("long").alias(name))


def running_agg(df: DataFrame, value: Column, order_cols, partition_cols=(), how: str = "sum",
                inclusive: bool = True, name: str = "running", buckets: int | None = None) -> DataFrame:
    """Prefix sum / max of ``value`` by ``order_cols`` per group, as a
    two-pass scan: one aggregate per (group, range partition) on the sorted
    table, offsets by a window over that small table, then the running
    aggregate inside (group, partition). A group holding a large share of the
    rows is spread over many tasks. ``value`` may also be a struct for
    ``max``. ``inclusive=False`` excludes the current row (NULL when nothing
    precedes it for ``max``)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    agg = {"sum": F.sum, "max": F.max}[how]
    placed = _ranged(df.withColumn("__v", value), list(partition_cols), order_cols, buckets)
    per = placed.groupBy("__grp", "__pid").agg(agg("__v").alias("__s"))
    before = Window.partitionBy("__grp").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("__grp", "__pid", agg("__s").over(before).alias("__off"))
    end = 0 if inclusive else -1
    inner = agg("__v").over(Window.partitionBy("__grp", "__pid").orderBy("__pos")
                            .rowsBetween(Window.unboundedPreceding, end))
    if how == "sum":
        combined = F.coalesce(F.col("__off"), F.lit(0)) + F.coalesce(F.col("__in"), F.lit(0))
    else:
        combined = F.greatest(F.col("__off"), F.col("__in"))
    out = placed.withColumn("__in", inner).join(offsets, ["__grp", "__pid"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], combined.alias(name))


def running_sum(df: DataFrame, value: Column, order_cols, partition_cols=(), name: str = "running",
                buckets: int | None = None) -> DataFrame:
    """Inclusive prefix sum per group (see ``running_agg``)."""
    return running_agg(df, value, order_cols, partition_cols, "sum", True, name, buckets)


def take_first(df: DataFrame, n: int, order_cols) -> DataFrame:
    """First min(len, n) rows in order (NULL keys first, for every n).
    Small n -> TakeOrderedAndProject (a per-partition top-n then a merge);
    large n -> dense index filter."""
    if n <= 0:
        raise ValueError("n must be > 0")
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    if n <= 100_000:
        return df.orderBy(*order_cols).limit(n)
    return with_row_index(df, order_cols, name="__i").where(F.col("__i") < n).drop("__i")


def key_at(df: DataFrame, index: int, order_cols):
    """The order key (a Row) of the row at ``index``, or None beyond the end.
    Only the key columns are read and moved."""
    keys = df.select(*order_cols)
    return with_row_index(keys, order_cols, name="__i").where(F.col("__i") == index).drop("__i").first()


def head_percent_split(df: DataFrame, percent: float, order_cols, split_col: str = "split",
                       has_validation: bool = False) -> DataFrame:
    """validation = first p% rows in order (cut = round(p*n/100)), train =
    the rest; with a validation split at hand (``has_validation``) every row
    is train. The cut is a comparison with one boundary key, so the rows
    themselves are neither shuffled nor sorted."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    n = 0 if has_validation else df.count()
    cut = int(round(percent * n / 100.0))
    if cut <= 0:
        return df.withColumn(split_col, F.lit("train"))
    edge = key_at(df, cut, order_cols)
    if edge is None:
        return df.withColumn(split_col, F.lit("validation"))
    fields = {f.name: f.dataType for f in df.select(*order_cols).schema.fields}
    bound = F.struct(*[F.lit(edge[c]).cast(t).alias(c) for c, t in fields.items()])
    head = F.struct(*order_cols) < bound  # structs compare field by field, NULL first
    return df.withColumn(split_col, F.when(head, F.lit("validation")).otherwise(F.lit("train")))


def shuffle_key(row_id: str, seed: int) -> Column:
    """Reproducible permutation key under any partitioning: the hex MD5
    of ``"<seed>:<row id>"`` (a portable, well-mixed hash; ties broken by
    row id)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))


def shuffled_index(df: DataFrame, row_id: str, seed: int, name: str = "perm_idx") -> DataFrame:
    """Position of each row in the seeded permutation."""
    keyed = df.withColumn("__h", shuffle_key(row_id, seed))
    return with_row_index(keyed, ["__h", row_id], name=name).drop("__h")


def assign_batches(idx: str, batch_size: int) -> Column:
    """Q3: batch id = index div batch size."""
    return F.floor(F.col(idx) / F.lit(batch_size)).cast("long")


def drop_last(df: DataFrame, idx: str, batch_size: int, n: int | None = None) -> DataFrame:
    """Q1: remove the short tail batch."""
    n = df.count() if n is None else n
    full = n // batch_size
    return df.where(assign_batches(idx, batch_size) < F.lit(full))


def _wrap(df: DataFrame, idx: str, n: int, total: int, pos: str = "pos") -> DataFrame:
    """Positions idx, idx+n, idx+2n ... below ``total``: the tail is padded
    by wrapping around to the head, as many times as needed."""
    copies = max(1, math.ceil(total / n)) if n else 0
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return (df.withColumn("__k", k)
            .withColumn(pos, F.col(idx) + F.col("__k") * F.lit(n))
            .where(F.col(pos) < F.lit(total)).drop("__k"))


def shard_round_robin(df: DataFrame, row_id: str, world: int, seed: int = 0, epoch: int = 0,
                      drop_tail: bool = False) -> DataFrame:
    """Q4: distributed-sampler shards of a permutation seeded by seed+epoch;
    shard = position mod world, tail wrapped so all shards are equal (or
    dropped with ``drop_tail``). Adds ``pos``, ``shard``."""
    n = df.count()
    perm = shuffled_index(df, row_id, seed + epoch, "__p")
    if drop_tail:
        total = (n // world) * world
        out = perm.where(F.col("__p") < total).withColumn("pos", F.col("__p"))
    else:
        total = math.ceil(n / world) * world
        out = _wrap(perm, "__p", n, total)
    return out.withColumn("shard", (F.col("pos") % world).cast("int")).drop("__p")


def shard_blocks(df: DataFrame, idx: str, world: int, batch_size: int) -> DataFrame:
    """Q5: evaluation shards in batch-sized blocks, padded by wrapping to a
    multiple of batch*world; shard = (pos div b) mod world."""
    n = df.count()
    total = math.ceil(n / (batch_size * world)) * batch_size * world
    out = _wrap(df, idx, n, total)
    return out.withColumn("shard", (F.floor(F.col("pos") / batch_size) % world).cast("int"))


def loop_shards(df: DataFrame, row_id: str, world: int, batch_size: int, seed: int = 0) -> DataFrame:
    """Q6: like Q4 on a seeded permutation but every batch of every shard is
    full: wrap to a multiple of b*world, shard = (pos div b) mod world."""
    n = df.count()
    perm = shuffled_index(df, row_id, seed, "__p")
    total = math.ceil(n / (batch_size * world)) * batch_size * world
    out = _wrap(perm, "__p", n, total)
    return out.withColumn("shard", (F.floor(F.col("pos") / batch_size) % world).cast("int")).drop("__p")


def length_groups(df: DataFrame, row_id: str, length: Column, batch_size: int, seed: int = 0,
                  mega_batch_mult: int | None = None, n: int | None = None) -> DataFrame:
    """Q7: random mega-batches (size mult*b), each sorted by length
    descending (ties keep permutation order); the mega-batch holding the
    longest item is swapped to the front element. Adds ``pos``."""
    n = df.count() if n is None else n
    if mega_batch_mult is None:
        mega_batch_mult = min(n // (batch_size * 4), 50) or 1
    m = mega_batch_mult * batch_size
    perm = shuffled_index(df.withColumn("__len", length), row_id, seed, "__p")
    perm = perm.withColumn("__mega", F.floor(F.col("__p") / m).cast("long"))
    rn = F.row_number().over(Window.partitionBy("__mega").orderBy(F.desc("__len"), F.col("__p")))
    ranked = cut_lineage(perm.withColumn("pos", F.col("__mega") * m + rn - 1))  # read twice below
    # first element of each mega-batch is its maximum; pick the first mega
    # with the overall maximum and swap its head with position 0.
    heads = ranked.where(F.col("pos") == F.col("__mega") * m)
    best = heads.agg(F.min_by(F.col("pos"), F.struct(-F.col("__len"), F.col("__mega"))).alias("p")).first()["p"]
    swapped = F.when(F.col("pos") == 0, F.lit(best)).when(F.col("pos") == F.lit(best), F.lit(0)) \
        .otherwise(F.col("pos"))
    return ranked.withColumn("pos", swapped.cast("long")).drop("__p", "__mega", "__len")


def resume_skip(df: DataFrame, batch_col: str, global_step: int, steps_per_epoch: int,
                grad_accum: int = 1) -> tuple[int, DataFrame]:
    """Q9: epochs already done and the batches of the current epoch to skip,
    so data is not seen twice. Returns (epochs_done, remaining rows)."""
    epochs_done = global_step // steps_per_epoch
    skip = (global_step % steps_per_epoch) * grad_accum
    return epochs_done, df.where(F.col(batch_col) >= F.lit(skip))


def gather_pad(df: DataFrame, arr: str, row_id: str, pad: int = -100) -> DataFrame:
    """Q10: pad every array to the global maximum width with -100 (one
    scalar aggregate), drop wrapped duplicates by row id."""
    width = df.agg(F.max(F.size(arr)).alias("w")).first()["w"] or 0
    dedup = df.dropDuplicates([row_id])
    return dedup.withColumn(arr, F.concat(F.col(arr), F.array_repeat(F.lit(pad), F.lit(width) - F.size(arr))))
