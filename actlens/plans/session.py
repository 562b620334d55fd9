"""Session settings for running the analyses.

The library never changes a session it is handed; :func:`build_session` is
for the bench, the tests and scripts that start their own.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

__all__ = ["DEFAULTS", "build_session", "recommended_conf"]

# Settings every run wants: adaptive execution re-plans at runtime (coalesces
# small shuffle partitions, switches joins to broadcast when the measured size
# allows, splits skewed join partitions), and the UI server stays off.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without this, every column expression asks the JVM some six times for the
    # line of Python it stands in; errors then name the expression only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Checkpoints (range-partitioned numbering, materialised profiles) are
    # removed once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def recommended_conf(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Shuffle sizing for a cluster run over ``input_bytes`` of events.

    Start with enough shuffle partitions that each holds about
    ``target_partition_bytes`` (and at least 3 per core, so stragglers
    balance), and let adaptive execution coalesce the small ones and split
    skewed join partitions.  Range-partitioned numbering uses the same
    partition count, which also bounds its summary table (a row per range)."""
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        # broadcast only what AQE has measured to be small
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "actlens", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("ACTLENS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
