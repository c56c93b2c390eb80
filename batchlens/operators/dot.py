"""DOT graph text: render ordered lines (JOB-10) and parse node/edge lines
back into typed rows (JOB-11), over any number of archived snapshot files.

Parsing is a per-line projection of regex extracts (no shuffle); it accepts
the label layouts of several generations of the graph script: no schedule
row, '-->' or '|' between schedule category and pattern, 0-7 fraction digits,
'Unknown' dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.operators.sequence import (FINISHED, IN_PROGRESS, MISSED, MISSED_UNSCHEDULED,
                                          NOT_SCHEDULED)

# DOT header/footer lines of the sequence graph files.
NODE_DEFAULTS = "node [shape=none, margin=0, fontname=Arial, fontsize=8];"
GRAPH_SUBTITLE = "Click on an arrowhead to get more information"

SECTION_HEADER, SECTION_NODES, SECTION_BLANK, SECTION_EDGES, SECTION_FOOTER = 1, 2, 3, 4, 5

# regexes over one DOT line
RE_NODE_KEY = r'^\s*"([^"]+)"\s*\[label='
RE_EDGE = r'^\s*"([^"]+)"\s*->\s*"([^"]+)"'
RE_MART = r"<b>([^<]*)</b>"
RE_BATCH = r"</b></td></tr><tr><td[^>]*>([^<]*)</td>"
RE_DURATION = r"Average Duration-(\d+) min"
RE_SCHEDULE = r"<td>(Schedule[^<]*?) (?:\||-->) ([^<]*)</td>"
RE_FINISHED = r"Finished at ([^<]*)"
RE_LAST_RUN = r"Last Run:? ([^<]*)"
RE_NEXT_RUN = r"Next Run: ([^<]*)"
RE_STYLE = r'style="(\w+)"'
RE_HREF = r'href="([^"]*)"'
RE_TS = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
RE_FILE = r"([^/\\]+)\.gv$"
RE_ENV_FOLDER = r"/env=([^/]+)/"
RE_STAMP_FOLDER = r"/snapshot_ts=(\d{8})_(\d{4})/"
RE_FILE_STAMP = r"_(\d{8})_(\d{4})\.gv$"


def render_dot_lines(nodes: DataFrame, edges: DataFrame, title: str) -> DataFrame:
    """JOB-10: the DOT document as (SectionNBR, LineTXT) rows: header, graph
    attributes, node defaults, one line per distinct node label, a blank
    line, one line per distinct edge, closing brace. Sorting by
    (SectionNBR, LineTXT) gives the file order; empty labels are dropped."""
    spark = nodes.sparkSession
    graph = (f"graph [layout=dot, fontname=Arial, fontsize=10, labelloc=t, label=<<b>{title}</b>"
             f"<br />{GRAPH_SUBTITLE}<br /> >];")
    header = spark.createDataFrame(
        [(SECTION_HEADER, f'digraph "{title}"{{'), (SECTION_HEADER, "\t" + graph),
         (SECTION_HEADER, "\t" + NODE_DEFAULTS), (SECTION_BLANK, ""), (SECTION_FOOTER, "}")],
        "SectionNBR int, LineTXT string")
    n = (nodes.filter(F.col("SegmentLabel").isNotNull() & (F.col("SegmentLabel") != ""))
              .select(F.lit(SECTION_NODES).alias("SectionNBR"), F.concat(F.lit("\t"), "SegmentLabel").alias("LineTXT")))
    e = (edges.filter(F.col("SegmentDisplay").isNotNull() & (F.col("SegmentDisplay") != ""))
              .select(F.lit(SECTION_EDGES).alias("SectionNBR"), F.concat(F.lit("\t"), "SegmentDisplay").alias("LineTXT")))
    return header.unionByName(n.distinct()).unionByName(e.distinct())


def write_dot(lines: DataFrame, path: str) -> None:
    """SNK-1: write one DOT document (a graph file is one text file by nature)."""
    lines.orderBy("SectionNBR", "LineTXT").select("LineTXT").coalesce(1).write.mode("overwrite").text(path)


def _opt(text: Column, pattern: str, idx: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, idx), F.lit(""))


def _ts(text: Column) -> Column:
    return F.try_to_timestamp(F.regexp_extract(text, RE_TS, 1), F.lit("yyyy-MM-dd HH:mm:ss"))


def parse_dot_nodes(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Node rows from DOT lines: key, mart, batch, duration, schedule
    category/pattern, run status, finished / last / next run text and
    timestamp. Extra columns of ``lines`` (file, env, snapshot) are kept."""
    t = F.col(text_col)
    x = lines.withColumn("NodeKey", _opt(t, RE_NODE_KEY)).filter(F.col("NodeKey").isNotNull())
    finished = _opt(t, RE_FINISHED)
    last = _opt(t, RE_LAST_RUN)
    nxt = _opt(t, RE_NEXT_RUN)
    status = (F.when(t.contains("Finished at"), FINISHED)
               .when(t.contains("In Progress"), IN_PROGRESS)
               .when(t.contains("Not Scheduled Today"), NOT_SCHEDULED)
               .when(t.contains("Did not run today") & nxt.isNotNull(), MISSED)
               .when(t.contains("Did not run today"), MISSED_UNSCHEDULED))
    keep = [c for c in lines.columns if c != text_col]
    return x.select(
        *keep, "NodeKey",
        _opt(t, RE_MART).alias("DataMartNM"), _opt(t, RE_BATCH).alias("BatchDefinitionNM"),
        _opt(t, RE_DURATION).try_cast("bigint").alias("AvgDurationNBR"),
        _opt(t, RE_SCHEDULE, 1).alias("ScheduleCategoryCD"), _opt(t, RE_SCHEDULE, 2).alias("SchedulePatternTypeCD"),
        status.alias("RunStatusCD"),
        F.trim(F.coalesce(finished, last)).alias("CompletedTXT"),
        _ts(F.coalesce(finished, last)).alias("CompletedDTS"),
        F.trim(nxt).alias("NextRunTXT"), _ts(nxt).alias("NextRunDTS"),
        t.contains("Broken References").alias("BrokenReferenceFLG"))


def parse_dot_edges(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Edge rows from DOT lines: from/to key, style, link."""
    t = F.col(text_col)
    keep = [c for c in lines.columns if c != text_col]
    x = lines.withColumn("FromNodeKey", _opt(t, RE_EDGE, 1)).filter(F.col("FromNodeKey").isNotNull())
    return x.select(*keep, "FromNodeKey", _opt(t, RE_EDGE, 2).alias("ToNodeKey"),
                    F.coalesce(_opt(t, RE_STYLE), F.lit("solid")).alias("EdgeStyleCD"),
                    _opt(t, RE_HREF).alias("LinkURL"))


def read_dot_archive(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """JOB-11 / SRC-4: nodes and edges of every DOT file under ``path`` (a glob
    is fine), each with the graph, environment and snapshot time it comes from.

    They are columns of the source: from the file name
    ``<name>_<server>_<yyyyMMdd>_<HHmm>.gv`` (NULL snapshot for the 'latest'
    copy without a stamp), or from the folders ``env=<server>`` and
    ``snapshot_ts=<yyyyMMdd>_<HHmm>`` that ``sinks.write_graph_snapshot`` writes.
    Lines are parsed where they are read, so files of any number and size are
    split over tasks."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("FilePath"))
    fname = F.regexp_extract("FilePath", RE_FILE, 1)
    stamp = F.concat(F.regexp_extract("FilePath", RE_FILE_STAMP, 1), F.regexp_extract("FilePath", RE_FILE_STAMP, 2))
    env = F.nullif(F.regexp_extract("FilePath", RE_ENV_FOLDER, 1), F.lit(""))
    folder_stamp = F.concat(F.regexp_extract("FilePath", RE_STAMP_FOLDER, 1), F.regexp_extract("FilePath", RE_STAMP_FOLDER, 2))
    graph = F.nullif(F.regexp_extract(fname, r"^(.*?)(?:_\d{8}_\d{4})?$", 1), F.lit(""))
    raw = raw.select(
        "value", "FilePath", graph.alias("GraphNM"),
        F.coalesce(F.nullif(F.regexp_extract(graph, r"_([^_]+)$", 1), F.lit("")), env).alias("EnvironmentNM"),
        F.try_to_timestamp(F.coalesce(F.nullif(stamp, F.lit("")), F.nullif(folder_stamp, F.lit(""))),
                           F.lit("yyyyMMddHHmm")).alias("SnapshotDTS"))
    return parse_dot_nodes(raw), parse_dot_edges(raw)
