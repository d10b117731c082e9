"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "churnlens") -> SparkSession:
    """A local session configured the way tests and the bench run it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context).  Only a local-mode session without one gets a fresh temporary
    folder of its own; on a cluster an unset value is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="churnlens-ckpt-")
    sc.setCheckpointDir(folder)
    return (sc.getCheckpointDir() or folder).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """(the rows written to a new scratch folder and read back, the folder to drop after use).

    What many jobs read gets the file scan's few partitions and a short lineage; a cached frame
    keeps the shuffle's partitions, and every task of every later job carries its whole plan."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this process wrote, in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
