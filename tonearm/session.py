"""Session, checkpoint and scratch-folder helpers.

On a cluster the checkpoint folder must be shared storage named by the
``spark.checkpoint.dir`` setting; we only invent one (a temp folder) when the
session runs in local mode and the setting is absent, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "tonearm", shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder; set one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tonearm-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Cut lineage by writing a parquet table in the shared checkpoint folder.

    Unlike an RDD checkpoint, the read-back table is a file scan: later readers
    prune columns, push filters and (with ``partition_by``) skip partitions, and
    AQE sees real sizes.  Survives executor loss (the files are on shared storage).
    The files are zstd: smaller than the default by about a third for names and ids.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # The written schema is passed back so partition columns keep their types
    # (directory values alone would make a boolean a string).
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files that nothing reads any more now, not when the driver next collects garbage.

    The driver still refers to the query it ran last, so a tiny one is run first.
    """
    spark.range(1).collect()
    spark._jvm.System.gc()


def drop_scratch(*tables) -> None:
    """Delete the files of :func:`materialize` results that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            df._scratch_path = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tonearm-{name}-{uuid.uuid4().hex}"
