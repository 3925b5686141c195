"""Session settings for a cluster run, sized from the data.

``apply_unset`` changes only keys the launch configuration leaves unset, so
a deployment's own choices win.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MB = 1 << 20


def recommended_conf(shuffle_bytes: int, total_cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    * enough shuffle partitions that each holds ``partition_mb`` (AQE then
      coalesces small ones and splits skewed ones at run time);
    * scan splits of the same size, so a task's input fits executor memory;
    * dynamic partition overwrite for the dated stage tables;
    * UTC session time zone (the clock-time rule is zone-free anyway)."""
    parts = max(total_cores * 3, math.ceil(shuffle_bytes / (partition_mb * MB)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_unset(spark: SparkSession, conf: dict[str, str]) -> dict[str, str]:
    """Set each key that the session's launch configuration does not set
    (a deployment's ``--conf`` values win); return what was set."""
    applied = {}
    for k, v in conf.items():
        if not _explicit(spark, k):
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def _explicit(spark: SparkSession, key: str) -> bool:
    try:
        return spark.sparkContext.getConf().contains(key)
    except Exception:  # Spark Connect: no SparkContext; treat as unset
        return False
