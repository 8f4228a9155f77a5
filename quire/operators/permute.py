"""Keyed permutations of a dense index (P9, Q4, Q6): an epoch's order is a
projection of the index, not a sort.

A generalised Feistel network permutes Z_a x Z_b, the smallest near-square
rectangle that holds the n places; places beyond n are walked on through the
network until one below n is met (cycle walking), which leaves a permutation
of 0..n-1. A rectangle holds fewer than ceil(sqrt(n)) places too many, so the
driver follows those few and knows how many walks suffice for every row: the
result is exact, with no bound that could be missed. Once the index stands
(one ``with_row_index``), any seed or epoch costs no shuffle.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import let
from quire.operators.order import _wrap, assign_batches

PRIME = (1 << 31) - 1  # round values stay below it, their products in a long
ROUNDS = 6             # even, so both halves come back to their places
LARGEST = 1 << 50


def round_keys(seed: int) -> list[tuple[int, int]]:
    """(multiplier, addend) per round from the seed's MD5."""
    def word(k: int, part: str) -> int:
        return int(hashlib.md5(f"{seed}:{k}:{part}".encode()).hexdigest()[:15], 16)
    return [(1 + word(k, "a") % (PRIME - 1), word(k, "b") % PRIME) for k in range(ROUNDS)]


def sides(n: int) -> tuple[int, int]:
    """The rectangle (a, b) of n places: a = ceil(sqrt(n)), b = ceil(n / a)."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-n // a)


def _network(x: np.ndarray, a: int, b: int, keys) -> np.ndarray:
    left, right = x // b, x % b
    for k, (m, c) in enumerate(keys):
        t = (right * m + c) % PRIME
        left, right = right, (left + t * t % PRIME) % (a if k % 2 == 0 else b)
    return left * b + right


def walks(n: int, seed: int) -> int:
    """How often the network is applied at most until every place below
    ``n`` has arrived below ``n``. Only the places beyond ``n`` are followed:
    fewer than sqrt(n) + 1 whole numbers."""
    a, b = sides(n)
    keys = round_keys(seed)
    beyond = np.arange(n, a * b, dtype=np.int64)
    after = _network(beyond, a, b, keys)
    entered = np.setdiff1d(beyond, after)  # reached from a place below n
    steps = 1
    while len(entered):
        steps += 1
        entered = _network(entered, a, b, keys)
        entered = entered[entered >= n]
    return steps


def _network_column(x: Column, a: int, b: int, keys) -> Column:
    rounds = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(c).cast("long").alias("c"),
                                F.lit(a if k % 2 == 0 else b).cast("long").alias("size"))
                       for k, (m, c) in enumerate(keys)])

    def step(s: Column, k: Column) -> Column:
        mixed = let((s["r"] * k["m"] + k["c"]) % PRIME, lambda t: (t * t) % PRIME)
        return F.struct(s["r"].alias("l"), ((s["l"] + mixed) % k["size"]).alias("r"))
    # below 2**53 the quotient of an exact multiple is exact in a double
    start = F.struct(((x - x % F.lit(b)) / F.lit(b)).cast("long").alias("l"),
                     (x % F.lit(b)).cast("long").alias("r"))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * F.lit(b).cast("long") + s["r"])


def keyed_index(idx: str | Column, n: int, seed: int) -> Column:
    """The place of the row at ``idx`` (0..n-1, dense) in the permutation
    of ``seed``; NULL for a NULL index."""
    if n > LARGEST:
        raise ValueError(f"permutations reach {LARGEST} rows, not {n}")
    x = (F.col(idx) if isinstance(idx, str) else idx).cast("long")
    if n <= 1:
        return x
    a, b = sides(n)
    keys = round_keys(seed)
    place = _network_column(x, a, b, keys)
    for _ in range(walks(n, seed) - 1):
        place = let(place, lambda p: F.when(p < n, p).otherwise(_network_column(p, a, b, keys)))
    return place


def epoch_shards(indexed: DataFrame, idx: str, n: int, world: int, seed: int = 0, epoch: int = 0,
                 drop_tail: bool = False) -> DataFrame:
    """Q4 on an indexed table: shard = place mod world in the permutation of
    seed + epoch, the tail wrapped (or dropped). No shuffle per epoch."""
    out = indexed.withColumn("__p", keyed_index(idx, n, seed + epoch))
    if drop_tail:
        out = out.where(F.col("__p") < (n // world) * world).withColumn("pos", F.col("__p"))
    else:
        out = _wrap(out, "__p", n, -(-n // world) * world)
    return out.withColumn("shard", (F.col("pos") % world).cast("int")).drop("__p")


def epoch_loop_shards(indexed: DataFrame, idx: str, n: int, world: int, batch_size: int,
                      seed: int = 0, epoch: int = 0) -> DataFrame:
    """Q6 on an indexed table: every batch of every shard is full, shard =
    (place div batch) mod world. No shuffle per epoch."""
    block = batch_size * world
    out = _wrap(indexed.withColumn("__p", keyed_index(idx, n, seed + epoch)), "__p", n, -(-n // block) * block)
    return out.withColumn("shard", (assign_batches("pos", batch_size) % world).cast("int")).drop("__p")
