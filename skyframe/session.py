"""Session helpers: a tuned builder for local runs and the shared scratch area.

Library functions never create sessions; they take the caller's.  The only
session-level state they touch is the checkpoint directory, which is read
from the session and set here only when it is unset on a local master
(tests, bench).  On a cluster ``spark.checkpoint.dir`` must name a shared
folder; we never fall back to a machine-local one there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "skyframe", extra: dict | None = None) -> SparkSession:
    """Session with the settings the library is tuned for.

    AQE re-plans joins at runtime (coalescing small shuffle partitions,
    splitting skewed ones); the UI stays off (no server, no port).
    """
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # checkpoint files of frames that are gone are deleted by Spark
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set only if missing.

    Order: the SparkContext's checkpoint dir, then the ``spark.checkpoint.dir``
    setting; if both are unset and the master is local, a fresh folder
    under the system temp dir (tests only).  A non-local session without
    a setting is an error: scratch data must live where every executor
    can read it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
    local = tempfile.mkdtemp(prefix="skyframe-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def sf_path(sf_dir: str, table: str) -> str:
    """Path of a test table in a scale-factor folder."""
    return os.path.join(sf_dir, f"{table}.parquet")
