"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
three words (repeats included, joined by one space; fewer words: the whole
sequence; none: fingerprint zero). Bit i is 1 if it is set in over half of
the shingles' XXH64 values (UTF-8, seed 42).

Covering masks: with radius r every bit position i gets a vector phi(i) of
r + 1 bits, and every non-zero v of r + 1 bits is one table, keyed by the
fingerprint masked to the positions where <phi(i), v> = 1. At most r
differing positions span at most r dimensions, so some v is orthogonal to
all of them: every pair within the radius collides in some table, without
any chance involved. phi cycles through all vectors, so a mask keeps half of
the positions.

Equal fingerprints are grouped first, so copies cost one node. A bucket of
two needs only its smallest and largest fingerprint, which a map-side
combined aggregate gives. Larger buckets, up to ``BUCKET`` nodes, are
compared in a task and emit a spanning star instead of pairs. A bucket
beyond that is split by covering masks over the positions that its mask
left out (all differences inside the bucket lie there), so nothing is capped:
after three masks only 8 positions are free, at most 256 nodes.

Defined results: a NULL text counts as empty; documents without words have
fingerprint zero and link like any other; a NULL id sorts after all others
(component id NULL only where a whole component has none); an empty table
gives no rows; repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quire.llm.common import hot_limit, materialise, packed, small_batches
from quire.llm.graph import components

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 1024
CHUNK = 1 << 16


# ---------------------------------------------------------------- fingerprint

def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text; shingles are counted in chunks
    so a very long text needs bounded memory beside its words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


# ------------------------------------------------------------- covering masks

def covering_masks(free: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions ``free``: any set of at most ``radius`` of
    them is left out entirely by some mask."""
    size = 1 << (radius + 1)
    phi = {p: k % size for k, p in enumerate(free)}
    return [sum(1 << p for p in free if (phi[p] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _star(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning stars of the link graph of one bucket."""
    fps = np.unique(np.asarray(fps, dtype=np.int64))
    u = fps.view(np.uint64)
    left = np.ones(len(u), dtype=bool)
    out: list[tuple[int, int]] = []
    for root in range(len(u)):
        if not left[root]:
            continue
        left[root] = False
        frontier = [root]
        while frontier:
            at = frontier.pop()
            near = np.flatnonzero(left & (np.bitwise_count(u ^ u[at]) <= radius))
            left[near] = False
            frontier.extend(near.tolist())
            out.extend((int(fps[root]), int(fps[k])) for k in near)
    return out


def _bucket_links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [e for members in pdf["members"] for e in _star(members, radius)]
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``nodes`` (fp long, distinct) -> (a, b): links whose connected
    components are those of all pairs within the radius."""
    parts: list[DataFrame] = []
    bucket = ["path", "mask", "key"]
    rows = _spread(nodes.select(F.lit("").alias("path"), "fp", F.lit(0).cast("long").alias("mask")), 0, radius)
    depth = 0
    while True:
        seen = materialise(rows.groupBy(*bucket).agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
        parts.append(seen.where("n = 2").select("a", "b")
                     .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        some = rows.join(seen.where(f"n > 2 AND n <= {BUCKET}").select(*bucket), bucket)
        parts.append(some.groupBy(*bucket).agg(F.collect_list("fp").alias("members"))  # at most BUCKET
                     .select("members").mapInPandas(_bucket_links(radius), "a long, b long"))
        large = seen.where(f"n > {BUCKET}").select(*bucket)
        if not large.limit(1).count():
            break
        depth += 1
        inside = rows.join(large, bucket).select(
            F.concat_ws("/", "path", F.hex("mask"), F.hex("key")).alias("path"), "fp", "mask")
        rows = _spread(inside, depth, radius)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return materialise(out.distinct())


def _chains(depth: int, radius: int) -> list[int]:
    """All masks that a bucket may have after ``depth`` levels."""
    masks = [0]
    for _ in range(depth):
        masks = sorted({m | x for m in masks
                        for x in covering_masks([p for p in range(BITS) if not m >> p & 1], radius)})
    return masks


def _spread(rows: DataFrame, depth: int, radius: int) -> DataFrame:
    """One row per node and table of its bucket: the masks of the next level
    depend only on the positions that the bucket's mask leaves free."""
    table = {}
    for m in _chains(depth, radius):
        free = [p for p in range(BITS) if not m >> p & 1]
        table[m] = [m | x for x in covering_masks(free, radius)]
    if depth == 0:
        spread = rows.withColumn("masks", F.array(*[F.lit(_signed(x)) for x in table[0]]))
    else:  # at most 15 ** depth rows, depth <= 3
        small = rows.sparkSession.createDataFrame(
            [(_signed(m), [_signed(x) for x in xs]) for m, xs in table.items()], "mask long, masks array<long>")
        spread = rows.join(F.broadcast(small), "mask")
    return (spread.select("path", "fp", F.explode("masks").alias("mask"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))


# ------------------------------------------------------------------- operator

def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (id, fp) -> (fp, n, component_id, root): one row per distinct
    fingerprint; ``root`` is the component's smallest fingerprint, which tells
    components of one id apart."""
    nodes = materialise(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")))
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "n", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    linked = materialise(named.where("linked"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialise(
        named.where("NOT linked").select("fp", "n", F.col("least").alias("component_id"), "root")
        .union(linked.join(least, "root").select("fp", "n", "component_id", "root")))


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, mark, fp, component_id, root), one row per input row; ``mark`` is
    a 64-bit hash of the text, which tells rows of one id apart."""
    small_batches(df.sparkSession)
    prints = materialise(df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"),
                                   fingerprint(F.col(text_col)).alias("fp")))
    found = classes(prints, radius)
    limit = hot_limit(prints.count())
    hot = F.broadcast(found.where(F.col("n") >= limit).drop("n"))  # at most 1000 rows
    rest = found.where(F.col("n") < limit).drop("n")
    return (prints.join(hot, "fp")
            .unionByName(prints.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp"))
            .select("id", "mark", "fp", "component_id", "root"))


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows that stay, with the input's columns: of each component the
    row with the smallest id (then the smallest text hash); rows without id,
    in a component without any, one per fingerprint. The texts are shuffled
    once, by the key of a row."""
    marked = annotate(df, id_col, text_col, radius)
    keep = (marked.where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("root", "id", F.when(F.col("id").isNull(), F.col("fp")).alias("only"))
            .agg(F.min("mark").alias("mark")))
    name = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("mark").cast("string"))
    rows = packed(df).withColumns({"id": F.col("row")[id_col], "mark": F.xxhash64(F.col("row")[text_col])}) \
        .select("row", name.alias("name"))
    kept = rows.join(keep.select(name.alias("name")), "name", "left_semi")
    first = Window.partitionBy("name").orderBy("name")
    return kept.withColumn("place", F.row_number().over(first)).where("place = 1").select("row.*")
