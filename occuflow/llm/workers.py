"""What operators with Python tasks need of the session."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

from occuflow.session import ship_package

_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows of an Arrow batch between the JVM and a worker.  Rows are whole texts:
# at the default 10,000 a batch of long documents takes tens of MB on both sides.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the workers and keep Arrow batches small."""
    ship_package(spark)
    if int(spark.conf.get(_ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))


def lean_heap() -> None:
    """Inside a worker: give large arrays back to the system when they are freed.

    glibc raises its threshold for separate mappings up to 32 MB as arrays come
    and go, after which freed ones stay with the process; a fixed 1 MB keeps a
    reused worker small.  Elsewhere this does nothing.  Arrow's own allocator
    keeps what it once held, so its buffers come from the same heap.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):
        pass
