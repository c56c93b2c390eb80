"""Snapshot archive: index of graph snapshots (JOB-12), per-day counts
(A-12), expired and orphan files (JOB-15).

Inputs are file listings ``FileNM`` (plus optionally ``ModifiedDTS``); see
``batchlens.sources.files.list_files`` for a listing read by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.session import as_of_literal

RE_STAMP = r"_(\d{8})_(\d{4})\.(gv|svg|html)$"
RE_PREFIX = r"^(.*)_\d{8}_\d{4}\.(?:gv|svg|html)$"


def with_stamp(files: DataFrame, name_col: str = "FileNM") -> DataFrame:
    """F-12: snapshot timestamp, extension and series prefix from a file name."""
    n = F.col(name_col)
    d, t = F.regexp_extract(n, RE_STAMP, 1), F.regexp_extract(n, RE_STAMP, 2)
    return files.withColumns({
        "SeriesNM": F.nullif(F.regexp_extract(n, RE_PREFIX, 1), F.lit("")),
        "ExtensionCD": F.nullif(F.regexp_extract(n, RE_STAMP, 3), F.lit("")),
        "SnapshotDTS": F.try_to_timestamp(F.nullif(F.concat(d, t), F.lit("")), F.lit("yyyyMMddHHmm")),
    })


def snapshot_index(files: DataFrame, name_col: str = "FileNM") -> DataFrame:
    """JOB-12: one entry per .svg snapshot: filename, htmlFile, date, time,
    12-hour time, ISO timestamp; newest first (S-4)."""
    x = with_stamp(files, name_col).filter((F.col("ExtensionCD") == "svg") & F.col("SnapshotDTS").isNotNull())
    ts = F.col("SnapshotDTS")
    return (x.select(
        "SeriesNM", F.col(name_col).alias("filename"),
        F.regexp_replace(F.col(name_col), r"\.svg$", ".html").alias("htmlFile"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"), F.date_format(ts, "HH:mm").alias("time"),
        F.date_format(ts, "h:mm a").alias("timeFormatted"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
        .orderBy(F.desc("timestamp"), "filename"))


def snapshot_stamp(ts=None) -> Column:
    """F-14: the stamp of a snapshot's file names, yyyyMMdd_HHmm, of a time (the as_of time by default)."""
    return F.date_format(as_of_literal() if ts is None else ts, "yyyyMMdd_HHmm")


def snapshot_index_json(index: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """SNK-3: the index of each series as one JSON array (newest first), the
    document that a page embeds. ``series`` (SeriesNM) names the series wanted;
    one without snapshots yields ``[]``."""
    entry = F.struct(F.col("timestamp").alias("_ts"), "filename", "htmlFile", "date", "time",
                     "timeFormatted", "timestamp")
    g = index.groupBy("SeriesNM").agg(F.sort_array(F.collect_list(entry), asc=False).alias("_a"))
    g = g.select("SeriesNM", F.to_json(F.transform("_a", lambda s: s.dropFields("_ts"))).alias("SnapshotsJSON"))
    if series is None:
        return g
    return (series.select("SeriesNM").distinct().join(g, "SeriesNM", "left")
            .select("SeriesNM", F.coalesce("SnapshotsJSON", F.lit("[]")).alias("SnapshotsJSON")))


def snapshots_per_day(index: DataFrame) -> DataFrame:
    """A-12: snapshot count per series and day (the calendar badge)."""
    return index.groupBy("SeriesNM", "date").agg(F.count(F.lit(1)).alias("SnapshotCNT"))


def expired_files(files: DataFrame, as_of: str | None = None, days: int = 90,
                  name_col: str = "FileNM", time_col: str | None = None, graph: str | None = None,
                  environment: str | None = None) -> DataFrame:
    """JOB-15: files older than ``days`` before as_of (by modification time
    when given, else by the name's snapshot stamp), of one ``graph`` and
    ``environment`` if given: names ``<graph>_<environment>...`` with a stamp of
    this century. Returns the list; deleting is left to the caller."""
    if graph is not None or environment is not None:
        name = F.col(name_col)
        files = files.filter(name.startswith(f"{graph}_{environment or ''}") if graph is not None
                             else name.contains(f"_{environment}")).filter(name.contains("_20"))
    x = with_stamp(files, name_col)
    ts = F.col(time_col) if time_col else F.col("SnapshotDTS")
    cutoff = as_of_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return x.filter(ts < cutoff).select(F.col(name_col).alias("FileNM"), ts.alias("FileDTS"))


def orphan_files(files: DataFrame, name_col: str = "FileNM") -> DataFrame:
    """J-11: .html snapshot pages whose .svg is missing (anti join on stem)."""
    x = files.select(F.col(name_col).alias("FileNM"))
    html = x.filter(F.col("FileNM").endswith(".html")).withColumn("stem", F.regexp_replace("FileNM", r"\.html$", ""))
    svg = x.filter(F.col("FileNM").endswith(".svg")).select(F.regexp_replace("FileNM", r"\.svg$", "").alias("stem"))
    return html.join(svg, "stem", "left_anti").select("FileNM")
