"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared file system). Only when that setting is missing on a ``local``
master, as in tests, do we make a folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidewater",
                  extra: dict | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "4g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(shuffle_partitions: int = 20_000) -> dict[str, str]:
    """Settings for a large cluster (about 100 TB of input, 1000 executors).

    Shuffle partitions start high and AQE coalesces them to ~256 MB each; skewed
    join partitions are split; scans read 512 MB splits; keyed state lives in
    RocksDB. ``spark.checkpoint.dir`` must name a shared folder (it is not set
    here: the cluster provides it).
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints of materialized intermediates are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` of the session (a core setting, never
    set here). When it is unset, a single-process ``local`` session gets a
    folder of its own; any other master must name a shared folder, because a
    machine-local one cannot be read by the other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one folder made by :func:`scratch_path`, on whatever file system it is."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder of files to its place, on whatever file system it is; the folders above the target are made."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path(target).getParent())
    if not fs.rename(jvm_path(source), jvm_path(target)):
        raise OSError(f"cannot move {source} to {target}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    Queries that write intermediates (landed files, sinks, upsert logs) return
    frames that read from here lazily; the caller removes the folder after use.
    """
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a frame that several branches read: a reliable
    ``checkpoint()`` into ``spark.checkpoint.dir`` (survives executor loss,
    unlike a local checkpoint), so the branches do not recompute it."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
