"""Spark session and shared scratch locations.

Library code never picks a machine-local folder on its own: scratch tables go
under the cluster's ``spark.checkpoint.dir``. Only on a local master, when that
setting is unset (local runs, tests), do we set one under the system temp folder;
on any other master an unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "barsmith", advisory_mb: int = 16) -> SparkSession:
    """Session for local runs and tests. On a cluster, use the cluster's session.

    ``advisory_mb`` is AQE's target shuffle-partition size: small enough that
    a few hundred MB still spread over all local cores; a cluster keeps its
    own (larger) setting."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{advisory_mb}m")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEMORY", "8g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a temp one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder that all executors share: a temp folder "
                "of the driver's machine cannot hold staged tables on a cluster")
        current = tempfile.mkdtemp(prefix="barsmith-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if sc is None:
        return current
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    # getCheckpointDir() returns a per-application sub-folder; keep our
    # tables next to Spark's own checkpoint files.
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder for one run's table under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/barsmith-{name}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-repartition a small frame to ``spark.sql.shuffle.partitions``
    before a generator multiplies its rows (date windows, request grids).

    A small aggregate would otherwise be coalesced by AQE into one partition
    and the whole expansion would run in one task. A numbered repartition is
    kept as asked; on a cluster the number is the configured shuffle width.
    """
    return df.repartition(shuffle_width(df.sparkSession), *cols)


def shuffle_width(spark: SparkSession) -> int:
    """``spark.sql.shuffle.partitions`` as a number; platforms that set it to
    a non-number (e.g. ``auto``) get the default parallelism instead."""
    value = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except (TypeError, ValueError):
        try:
            return max(1, spark.sparkContext.defaultParallelism)
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            return 200
