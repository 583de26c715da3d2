"""Session defaults and the shared folder for tables that must outlive an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Results compare dates across engines, so the zone is pinned.  AQE does what a static plan
# cannot: coalesce small shuffles, split skewed join partitions, turn a join into a broadcast
# once the measured size of a side allows it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the defaults this package expects to a session builder."""
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


@lru_cache(maxsize=1)
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="newsrisk-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table.

    This is below ``spark.checkpoint.dir``, the folder every executor of a cluster can reach.
    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that are not needed any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as the session has cores.

    For costly per-row work on a table of few, small files.  A table that already has enough
    partitions, as any large one does, is returned unchanged, so nothing large is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
