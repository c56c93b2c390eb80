"""Session construction and shared settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed "today" used by fixtures so results are reproducible (GETDATE() in the
# reference scripts is replaced by an explicit as_of everywhere).
AS_OF_DEFAULT = "2001-07-31 12:00:00"

# Settings every job relies on. Timestamps in the driver tables are
# TIMESTAMP_NTZ; zoned literals are interpreted in UTC so the two agree.
# At scale: set spark.sql.shuffle.partitions high on the cluster and let AQE
# coalesce toward the advisory size (not toward maximum parallelism; the size is
# that of compressed rows: narrow ids take over 30 times as much in a task's sort
# or hash table, which at 128 MB is beyond an executor), split
# skewed join partitions, and keep scan splits at 256 MB so every task's
# input fits executor memory.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs depend on to an existing session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return spark.checkpoint.dir; set a scratch one only when unset (tests, local runs).

    On a cluster the shared folder named by ``spark.checkpoint.dir`` is used as is; without one this raises,
    as a folder of one machine is not seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        d = tempfile.mkdtemp(prefix="batchlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once, cut from its lineage, and, unlike
    a checkpoint, read by column and with its filters."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "batchlens") -> SparkSession:
    """Create (or reuse) a session configured for the jobs.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``) when no
    cluster master is supplied by the environment.
    """
    b = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
          .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
          .config("spark.sql.ansi.enabled", "true"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def as_of_literal(as_of: str | None = None) -> Column:
    """The reproducible 'now' as a TIMESTAMP_NTZ literal column."""
    return F.lit(as_of or AS_OF_DEFAULT).cast("timestamp_ntz")
