"""Sources (F1-F7, F10): file readers with explicit schemas and a row key.

All readers are distributed scans: Spark lists the files, splits them into
tasks and never routes data through the driver. Where the reference relies
on file position (line numbers, file order) the position is made explicit as
columns (``file``, ``line``) derived by Spark, not by a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx
from quire.session import broadcast_if_small, cut_lineage

BLOCK_ROWS = 1_000_000  # of the table of file blocks that is broadcast at most


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, cols, what: str = "input") -> None:
    """fail before running when a needed column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what} lacks column(s) {missing}; has {df.columns}")


def require_splits(splits: dict, needed) -> None:
    """a requested mode needs its split (train/validation/test)."""
    for s in needed:
        if s not in splits or splits[s] is None:
            raise ValueError(f"no {s} split among {sorted(k for k, v in splits.items() if v is not None)}")


def _first_byte_kind(spark: SparkSession, path: str) -> DataFrame:
    """Per file: the first non-blank character (``[`` = one JSON array).

    A distributed text scan of the JSON files; the per-file result (one row
    per file, like a file listing) is all that reaches the driver."""
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,jsonl}")
             .text(path).withColumn("path", F.input_file_name())
             .withColumn("__m", F.monotonically_increasing_id()))
    stripped = F.regexp_replace(F.col("value"), "^[\\s\\x{feff}]+", "")
    first = (lines.where(F.length(stripped) > 0)
             .groupBy("path").agg(F.min_by(F.substring(stripped, 1, 1), F.col("__m")).alias("c")))
    return first


def read_json_dir(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every ``*.json`` / ``*.jsonl`` below ``path``, recursively.

    A ``.json`` file may hold one JSON array or JSON lines: multiLine=False
    turns an array into NULL rows and multiLine=True keeps only the first
    object of a JSON-lines file, so each file is sniffed (first non-blank
    character) and the two groups are read with the right mode and unioned.
    Non-JSON files are ignored. Adds ``source_file``.
    """
    kinds = _first_byte_kind(spark, path).collect()  # one row per file (file listing, not data)
    arrays = [r["path"] for r in kinds if r["c"] == "["]
    lines = [r["path"] for r in kinds if r["c"] != "["]
    parts = []
    if lines:
        parts.append(spark.read.schema(schema).option("multiLine", "false").json(lines))
    if arrays:
        parts.append(spark.read.schema(schema).option("multiLine", "true").json(arrays))
    if not parts:
        return spark.createDataFrame([], schema).withColumn("source_file", F.lit(None).cast("string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("source_file", F.input_file_name())


def _read_one(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    ext = path.rsplit(".", 1)[-1].lower()
    if ext == "csv":
        r = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
        return (r.schema(schema) if schema else r).csv(path)
    if ext in ("json", "jsonl"):
        if schema is None:
            raise ValueError("a JSON split needs an explicit schema")
        return read_json_dir(spark, path, schema).drop("source_file")
    if ext == "parquet":
        return spark.read.parquet(path)
    if ext == "txt":
        return read_lines(spark, path, numbers=False)
    raise ValueError(f"unsupported file type: {path}")


def read_splits(spark: SparkSession, files: dict, schema: T.StructType | None = None) -> DataFrame:
    """named split files -> one DataFrame with a ``split`` column.

    The format is chosen per file from its own extension (fixes D9, where the
    last file decided for all)."""
    out = None
    for split, path in files.items():
        if path is None:
            continue
        df = _read_one(spark, path, schema).withColumn("split", F.lit(split))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no split files given")
    return out


def read_lines(spark: SparkSession, path, strip: bool = True, numbers: bool = True) -> DataFrame:
    """one row per line with ``file``, the 0-based ``line`` in it and
    ``row``, the place among the lines of all files; without ``numbers`` only
    the text, straight from the scan."""
    out = number_lines(spark, path)[0] if numbers else spark.read.text(path)
    return out.withColumn("text", tx.strip_py(F.col("value")) if strip else F.col("value")).drop("value")


def _file_order() -> list:
    """Files by folder, then by the number of a part file, then by name, so
    that part-100000 stands behind part-99999."""
    name = F.element_at(F.split("file", "/"), -1)
    return [F.expr("left(file, length(file) - length(element_at(split(file, '/'), -1)))"),
            F.coalesce(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), F.lit(-1)), "file"]


def number_lines(spark: SparkSession, path) -> tuple[DataFrame, int]:
    """(value, file, line, row) of every line below ``path`` (one path or a
    list), and the number of lines. Files are cut into blocks and read in
    parallel; lines are never sorted or moved.

    A block is a run of bytes of one file (``_metadata.file_block_start``),
    read by one task in order. A first pass counts the lines of each block; the
    prefix sums of that table (one row per block) and the place of a line in its
    block give its number in the file and among all files. Both passes cut the
    files alike; a line without its block is an error, never a lost row."""
    raw = (spark.read.text(path)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
           .withColumn("at", F.monotonically_increasing_id()))
    counted = raw.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    order = [*_file_order(), "start"]
    # one row per block, like a file listing
    blocks = cut_lineage(counted.select(
        F.col("file").alias("f"), F.col("start").alias("s"), "first", "n",
        (F.sum("n").over(Window.orderBy(*order)) - F.col("n")).alias("above"),
        (F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")).alias("above_here")))
    total = blocks.agg(F.sum("n")).first()[0] or 0
    place = F.coalesce(F.col("at") - F.col("first"), F.raise_error("a block of the file was cut differently").cast("long"))
    out = (raw.join(broadcast_if_small(blocks, BLOCK_ROWS), (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")
           .select("value", "file", (F.col("above_here") + place).alias("line"), (F.col("above") + place).alias("row")))
    return out, total


def read_named(spark: SparkSession, name: str, config: str | None = None) -> DataFrame:
    """a named dataset is a catalog table: ``name``, or ``name.config``
    (database and table) where it exists, else ``name_config``."""
    if config and spark.catalog.tableExists(f"{name}.{config}"):
        return spark.table(f"{name}.{config}")
    return spark.table(f"{name}_{config}" if config else name)


def read_vocab_words(spark: SparkSession, path: str) -> DataFrame:
    """first whitespace token of every non-blank line, distinct."""
    lines = spark.read.text(path)
    first = F.split(tx.strip_py(F.col("value")), tx.WS_CLASS + "+")[0]
    return lines.where(F.length(tx.strip_py(F.col("value"))) > 0).select(first.alias("word")).distinct()


def read_word_freq(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``word freq`` lines -> (good rows, rejected lines). Rows keep the
    file line number so frequency ties resolve in file order (T1)."""
    lines, _ = number_lines(spark, path)
    toks = F.split(tx.strip_py(F.col("value")), tx.WS_CLASS + "+")
    parsed = lines.select("file", "line", "value", toks[0].alias("word"),
                          F.when(F.size(toks) >= 2, toks[1].try_cast("long")).alias("freq"))
    good = parsed.where(F.col("freq").isNotNull()).select("word", "freq", "file", "line")
    bad = parsed.where(F.col("freq").isNull() & (F.length(tx.strip_py(F.col("value"))) > 0)) \
        .select("file", "line", F.col("value").alias("raw"))
    return good, bad


def read_aligned(spark: SparkSession, hyp_path, ref_path) -> DataFrame:
    """Line i of one side paired with line i of the other; each side
    may be any number of files, in the order of their names.

    Equal line counts are checked first (error before any scoring). Only a
    trailing newline is removed from a line (fixes D11)."""
    h, n = number_lines(spark, hyp_path)
    r, m = number_lines(spark, ref_path)
    if n != m:
        raise ValueError(f"line counts differ: {n} vs {m}")
    strip_cr = lambda c: F.regexp_replace(c, "\r\\z", "")
    return (h.select(F.col("row").alias("line"), strip_cr(F.col("value")).alias("hyp"))
            .join(r.select(F.col("row").alias("line"), strip_cr(F.col("value")).alias("ref")), "line"))
