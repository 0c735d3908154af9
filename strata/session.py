"""Session settings every job relies on, and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

# Settings the library assumes. ANSI mode stays at Spark 4's default (on).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs. On a cluster the platform
    builds the session; the library only reads its settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **(extra or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Used for ``DataFrame.checkpoint()`` and for intermediate tables. Where the
    session names none, a fresh local folder is set, but only on a local
    master: on a cluster every executor would write to a disk of its own, so
    there it is an error.
    """
    try:
        sc = spark.sparkContext
    except PySparkAttributeError:  # Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not is_local(sc.master):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all "
                         f"executors share (master {sc.master})")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="strata-ckpt-"))
    return sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Driver and executors are one process (``local``, ``local[4]``), unlike
    ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
