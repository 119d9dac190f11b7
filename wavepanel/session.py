"""Session construction and the few settings the operators read.

Settings are plain Spark conf keys, so a cluster sets them in
``spark-defaults.conf`` or with ``--conf`` like any other option.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows a single task may sort for one key of a window before the key is
# treated as "hot" and split into ordered segments (see operators/segments.py).
ROWS_PER_SEGMENT_KEY = "wavepanel.rowsPerSegment"
DEFAULT_ROWS_PER_SEGMENT = 4_000_000

# Largest row count of a derived side table that is broadcast after an
# explicit count; above it the operators fall back to a shuffled join.
MAX_BROADCAST_ROWS_KEY = "wavepanel.maxBroadcastRows"
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def build_session(master: str | None = None, app: str = "wavepanel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with the options the library is designed for.

    AQE stays on (runtime partition coalescing, skew-join splitting and
    runtime broadcast conversion), the UI is off, and timestamps carry no
    zone conversion.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # no Python call-site capture per Column call (extra JVM round trips
        # on every expression built on the driver)
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 200),
        "spark.driver.memory": os.environ.get("WAVEPANEL_DRIVER_MEMORY", "16g"),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def rows_per_segment(spark: SparkSession) -> int:
    return conf_int(spark, ROWS_PER_SEGMENT_KEY, DEFAULT_ROWS_PER_SEGMENT)


def max_broadcast_rows(spark: SparkSession) -> int:
    return conf_int(spark, MAX_BROADCAST_ROWS_KEY, DEFAULT_MAX_BROADCAST_ROWS)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The folder named by ``spark.checkpoint.dir`` (or set on the context) is
    used as is.  Only a local-mode session without one gets a fresh folder
    under the system temp dir; on a cluster a missing setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="wavepanel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and return
    the read-back table: cuts the lineage, and later scans are columnar and
    column-pruned (unlike an RDD checkpoint of a wide table)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
