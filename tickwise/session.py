"""Session construction for tests and benchmarks, and the shared checkpoint folder.

Library code never builds a session; it receives one.  On a cluster the
checkpoint folder comes from ``spark.checkpoint.dir`` (a shared file system);
only sessions built here for one machine get a folder of their own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours carries.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting handles hot keys.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tickwise", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Local runs have small shuffles: a lower coalescing floor keeps every core
    # busy.  On a cluster the default floor (1 MB) and data-sized partition
    # counts apply.
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "256KB"
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not _configured_dir(spark):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(
            prefix="tickwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return spark


def _context_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001  (no SparkContext under Spark Connect)
        return None


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or _context_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; raises when unset."""
    value = _configured_dir(spark)
    if not value:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return value
