"""Session helpers.

On a cluster the caller owns the SparkSession; these helpers only build a
local session for tests and the bench, and resolve the shared checkpoint
folder from the session (``spark.checkpoint.dir``) instead of inventing one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should have. They are safe at any
# scale: AQE re-plans joins and coalesces/splits partitions from runtime
# statistics, and skew-join splitting handles a hot key holding a large
# share of the rows.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Text scoring is CPU-bound per row: never let AQE fold a small but
    # expensive shuffle output into fewer partitions than there are cores
    # (at scale total/parallelism dominates and this floor is irrelevant).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Text rows are wide; keep Arrow batches moderate so a batch of long
    # documents does not blow a Python worker's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.files.maxPartitionBytes": "64m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quire") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in the Python workers (UDFs pickle by
    module reference). On a cluster pass the package with ``--py-files``;
    here it is zipped once per session and added with ``addPyFile``."""
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="quire-pkg-") if sc.master.startswith("local") \
        else ensure_checkpoint_dir(spark)
    zpath = os.path.join(out_dir, "quire.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_BYTES = 64 << 20


def _row_bytes(df: DataFrame):
    """A bound of a row's size: strings by their bytes, arrays by 16 bytes an
    element, other columns by 8, and a fixed share per row."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    size = F.lit(32)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            size = size + F.coalesce(F.size(c), F.lit(0)) * 16 + 16
        else:
            size = size + 8
    return size


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes,
    measured (the measurement stops after ``max_rows + 1`` rows)."""
    from pyspark.sql import functions as F
    seen = df.limit(max_rows + 1).select(_row_bytes(df).alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    return seen[0] <= max_rows and (seen[1] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int, count: int | None = None,
                       bound: int | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only behind a measured bound of rows and bytes;
    otherwise return it unchanged so the join falls back to a shuffle join
    (where AQE may still pick a broadcast from runtime sizes).

    ``bound`` (or ``count``) is an upper bound of the rows that the caller
    knows (a top-k limit, a fixed table): beyond ``max_rows`` nothing is
    measured. Bytes are measured always."""
    from pyspark.sql import functions as F
    n = bound if bound is not None else count
    if n is not None and n > max_rows:
        return df
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
