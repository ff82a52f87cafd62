"""Spark session settings and the shared folder for written tables.

The library never sets cluster-wide options behind a caller's back: a job that
runs inside an existing session keeps that session's settings.  ``get_session``
is for tests, benchmarks and scripts that own their session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every owned session gets.  Timestamps in the ledger are zone-less
# (TIMESTAMP_NTZ), so the zone only matters for display; it is pinned anyway.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, and turn sort-merge joins into broadcast joins only
    # when the measured shuffle output of one side is below the threshold.
    # The plan-time threshold applies to Spark's size estimate from file
    # statistics; at cluster scale no fact table comes near it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.autoBroadcastJoinThreshold": "8MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Skip capturing a Python call site for every Column call (a JVM round
    # trip each); plans are unchanged.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus) * 2)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def settings_for_input(input_bytes: int, cores: int) -> dict[str, str]:
    """Partitioning settings sized from the bytes a job reads, by one rule at all sizes.

    Shuffle partitions start at about one per 128 MB of input (never fewer
    than two per core) so that, after the first exchange, every reducer's
    share fits comfortably in executor memory and spills rarely; AQE then
    coalesces small partitions toward the 128 MB advisory size and splits
    partitions that are skewed beyond 512 MB.  File splits of 256 MB keep scan
    tasks few but bounded.
    """
    partitions = max(2 * cores, -(-input_bytes // (128 * MB)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
        "spark.sql.files.maxPartitionBytes": "256MB",
    }


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path``: any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder; 0 if there is none."""
    fs, where = file_system(spark, path)
    return int(fs.getContentSummary(where).getLength()) if fs.exists(where) else 0


def path_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of a file or of all files below a folder."""
    fs, where = file_system(spark, path)
    out = []
    if fs.exists(where):
        files = fs.listFiles(where, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(out)


def input_bytes(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = ("lineitem", "orders", "customer", "supplier")) -> int:
    """Total size of the driver tables the ledger is derived from."""
    return sum(path_bytes(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables)


_FALLBACK_CHECKPOINT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    executors and the driver all see).  Only a session on a local master may do
    without the setting: a private folder is then created and registered.
    """
    global _FALLBACK_CHECKPOINT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _FALLBACK_CHECKPOINT is None:
        # Local runs only.  A stable folder per user, so a ledger written by
        # one process (keyed by its source files) is reused by the next.
        _FALLBACK_CHECKPOINT = os.path.join(tempfile.gettempdir(), f"ledgerlens-checkpoint-{os.getuid()}")
        os.makedirs(_FALLBACK_CHECKPOINT, exist_ok=True)
    spark.sparkContext.setCheckpointDir(_FALLBACK_CHECKPOINT)
    return spark.sparkContext.getCheckpointDir().rstrip("/")
