"""Spark session, the shared checkpoint folder and scratch tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "promoscope", config: dict[str, str] | None = None) -> SparkSession:
    """A session that leaves the cluster's settings alone.

    Master, partition count and memory come from spark-submit (or the
    Spark defaults) unless passed here, as the bench does for its local
    runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` hashed by ``by`` over the session's number of shuffle
    partitions, which AQE does not coalesce.  In a join on ``by`` it keeps
    the other side's partitions as many; give the side with few rows a key."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is set.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session.  Only a local
    master (tests, bench) may fall back to a fresh folder under the
    system temp dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running ordered fills on a cluster")
    folder = tempfile.mkdtemp(prefix="promoscope-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_scratch: list[str] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder, known to ``clear_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in a scratch folder, read back: its
    lineage ends there, and any executor can read it again."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes this process's scratch tables; DataFrames over them end."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
