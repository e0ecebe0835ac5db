"""Session construction and lineage cuts.

All operators take and return DataFrames; this module only builds a
session for scripts/tests and provides :func:`cut_lineage`, which writes an
intermediate table under the cluster-provided ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "occuflow") -> SparkSession:
    """Session tuned for the operators in this package.

    AQE is on so that shuffle partition counts coalesce at run time, skewed
    join partitions are split, and small join sides are broadcast only once
    their *measured* shuffle size is under the adaptive threshold.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("OCCUFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, creating a local one only in local mode.

    On a cluster the directory must be a shared folder named by
    ``spark.checkpoint.dir``; a machine-local temporary folder would not
    survive executor loss, so we refuse to invent one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a shared folder before running")
    local_dir = tempfile.mkdtemp(prefix="occuflow-ckpt-")
    sc.setCheckpointDir(local_dir)
    return local_dir


class _Scopes(threading.local):
    """Open stage scopes of a thread: stage paths written since each began (see stage_scope)."""

    def __init__(self):
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


def _write_stage(df: DataFrame, outlive: bool = False) -> str:
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/occuflow-stage-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    scopes = _SCOPES.open[:-1] if outlive else _SCOPES.open
    if scopes:
        scopes[-1].append(path)
    return path


def cut_lineage(df: DataFrame, outlive: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table under ``spark.checkpoint.dir`` and read it back.

    Used between the stages of iterative or multi-reuse plans: a lost
    executor re-reads the table instead of recomputing the whole lineage.
    One job writes it (``DataFrame.checkpoint`` on an unpersisted frame
    computes it twice), and the re-read carries file statistics that AQE
    uses for its join choices.  With ``outlive`` the table belongs to the scope
    around the innermost :func:`stage_scope`, so a result can leave it.
    """
    return df.sparkSession.read.parquet(_write_stage(df, outlive))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


@contextmanager
def stage_scope(spark: SparkSession):
    """Delete the stage tables written inside the block when it ends.

    Frames built inside must not be used after the block, but for what
    ``cut_lineage(..., outlive=True)`` returned.
    """
    _SCOPES.open.append([])
    try:
        yield
    finally:
        for path in _SCOPES.open.pop():
            fs, p = _hadoop_path(spark, path)
            fs.delete(p, True)


# What a broadcast side may hold, checked on its written table: rows and bytes
# of (compressed) Parquet.  Species lists and flagged-cell sets are bounded by
# the number of species / cells, not by record volume.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES, outlive: bool = False) -> DataFrame:
    """Write ``df`` as a stage and mark it for broadcast only if it is small.

    Both the table's bytes and its rows are checked (cheap on the written
    table).  Above either bound the frame is returned unmarked and the join
    falls back to a shuffle join, where AQE splits skewed partitions.
    """
    spark = df.sparkSession
    path = _write_stage(df, outlive)
    df = spark.read.parquet(path)
    fs, p = _hadoop_path(spark, path)
    small = fs.getContentSummary(p).getLength() <= max_bytes and df.count() <= max_rows
    return F.broadcast(df) if small else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``occuflow`` importable by Python workers (once per application).

    Operators whose Python functions run on executors call this; it is the
    programmatic form of ``spark-submit --py-files``: the package is zipped
    on the driver and distributed by Spark's file server.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="occuflow-pkg-"), "occuflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition ``df`` on ``cols`` into ``spark.sql.shuffle.partitions``.

    For joins whose output is far larger than their input (candidate pairs
    of neighbour searches): AQE sizes partitions by input bytes and would
    merge them into a few tasks; an explicit partition count keeps the
    expansion spread, and the join reuses this partitioning.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def keyed_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join of two tables that both grow with the points: shuffled, never sent through the driver.

    Spark would broadcast such a table while its Parquet file is small, which
    collects it on the driver once per join and round.
    """
    return left.join(right.hint("merge"), on, how)


def cluster_conf(input_bytes: int, executor_cores: int = 4, executors: int = 1000,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of occurrence Parquet.

    * scan splits of ``target_partition_bytes`` (Parquet row groups permitting);
    * shuffle partitions sized so the largest shuffle (records keyed by cell
      before the map-side combine, about the scan size) lands near the same
      target, and at least two waves of the cluster's cores;
    * AQE on, with skew splitting for any partition 5x the median and above
      the target size; coalescing keeps small stages from running as
      thousands of empty tasks.

    Returned as plain ``spark-submit --conf`` pairs; nothing here changes
    results.
    """
    cores = executor_cores * executors
    shuffle = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
    }
