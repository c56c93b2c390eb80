"""Sinks: versions of a table (SNK-4, SNK-6), graph snapshots (SNK-1), event log append (SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.sources import tables


def table_versions(spark: SparkSession, table_dir: str) -> list[str]:
    """Committed versions of a table, oldest first. What a writer has not committed is no version."""
    return tables.versions(spark, table_dir)


def read_latest(spark: SparkSession, table_dir: str) -> DataFrame:
    return tables.read(spark, tables.version(spark, table_dir))


def write_new_version(df: DataFrame, table_dir: str, base: tables.Version | None = None) -> str:
    """``df`` as the next version of ``table_dir`` (never over the files it
    may have been computed from); the path of its commit record.

    ``base`` is the version that was read to compute ``df`` (by default the
    last one now). Raises ``tables.Conflict`` if another writer has committed
    since: its rows would be lost to readers of this one."""
    return tables.replace(df, base or tables.version(df.sparkSession, table_dir)).record


def write_graph_snapshot(lines: DataFrame, root: str, env: str, snapshot_ts: str) -> None:
    """SNK-1: the ordered DOT lines as the 'latest' copy of ``env`` and as a
    timestamped copy, partitioned by env and snapshot stamp (yyyyMMdd_HHmm).

    Lines are range-sorted: a graph of usual size is one file, a larger one
    several, which make up the document in the order of their names."""
    ordered = lines.orderBy("SectionNBR", "LineTXT").select("LineTXT")
    ordered.write.mode("overwrite").text(f"{root}/latest/env={env}")
    (ordered.withColumn("env", F.lit(env)).withColumn("snapshot_ts", F.lit(snapshot_ts))
     .write.mode("append").partitionBy("env", "snapshot_ts").text(f"{root}/archive"))


def append_event_log(log: DataFrame, path: str, run: tuple[str, int] | None = None) -> tables.Version:
    """SNK-5: append event-log rows (append only; readers order by run and
    sequence). ``run`` = (writer, number) is appended once, however often it is tried."""
    return tables.append(log, path, txn=run)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path)
