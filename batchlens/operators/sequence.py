"""Declared batch sequence: run statistics, schedule flags, run status,
sequenced nodes (JOB-1) and edges (JOB-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.functions.fixed import (CELL_CLOSE, DID_NOT_RUN, DURATION, EDGE_ACTIVE, EDGE_INACTIVE, LABEL_CLOSE, LABEL_OPEN,
                                       MINUTES, NAME_CLOSE, NOT_SCHEDULED_TODAY, SEQ_BATCH_CELL_BROKEN, SEQ_BATCH_CELL_OK,
                                       SEQ_FINISHED, SEQ_LAST_RUN, SEQ_MART_CELL, SEQ_MART_CELL_BROKEN, SEQ_NEXT_RUN, SEQ_RUNNING)
from batchlens.functions.tsql import amp_to_and, fmt_ts, int_avg_minutes, tsql_concat, tsql_plus
from batchlens.session import as_of_literal

# Run-status codes (PF-8).
FINISHED = "FINISHED"
IN_PROGRESS = "IN_PROGRESS"
MISSED = "MISSED"
NOT_SCHEDULED = "NOT_SCHEDULED"
MISSED_UNSCHEDULED = "MISSED_UNSCHEDULED"


def run_stats(batch_history: DataFrame, as_of: str | None = None, lookback_days: int = 180) -> DataFrame:
    """A-3..A-5 fused into one aggregate per (DataMartID, BatchDefinitionID).

    AvgDurationNBR: integer minutes of successful runs that ended in the last
    ``lookback_days`` (T-SQL integer AVG then ``/60``); LastSuccessDTS: latest
    successful end; SuccessFLG: 1 when that end is on the as_of day.
    One partial (map-side) aggregate, so a hot batch does not skew the shuffle.
    """
    now = as_of_literal(as_of)
    ok = F.col("StatusCD") == "Succeeded"
    recent = ok & (F.col("EndDTS") > now - F.expr(f"INTERVAL {int(lookback_days)} DAYS"))
    g = (batch_history
         .groupBy("DataMartID", "BatchDefinitionID")
         .agg(F.sum(F.when(recent, F.col("DurationSecondsCNT"))).alias("_s"),
              F.count(F.when(recent, F.col("DurationSecondsCNT"))).alias("_c"),
              F.max(F.when(ok, F.col("EndDTS"))).alias("LastSuccessDTS")))
    return g.select(
        "DataMartID", "BatchDefinitionID",
        int_avg_minutes(F.col("_s"), F.col("_c")).alias("AvgDurationNBR"),
        "LastSuccessDTS",
        F.when(F.to_date("LastSuccessDTS") == F.to_date(now), 1).otherwise(0).alias("SuccessFLG"))


def schedule_category(schedule_id: Column, enabled: Column) -> Column:
    """PF-4."""
    return (F.when(schedule_id.isNull(), "Schedule (None)")
             .when(enabled == 1, "Scheduled (Enabled)")
             .when(enabled == 0, "Scheduled (Disabled)")
             .otherwise("Schedule (Other)"))


def scheduled_today(pattern: Column, next_start: Column, as_of: str | None = None) -> Column:
    """PF-5: Y/N, '?' when the pattern exists but the next start is unknown."""
    today = F.to_date(as_of_literal(as_of))
    return (F.when(pattern.isNull(), "N")
             .when(F.to_date(next_start) == today, "Y")
             .when(F.to_date(next_start) != today, "N")
             .otherwise("?"))


def run_status(success_flg: Column, in_progress_flg: Column, pattern: Column, today_flg: Column) -> Column:
    """PF-8: precedence success today > in progress > scheduled and missed >
    not scheduled today > missed without schedule."""
    return (F.when(success_flg == 1, FINISHED)
             .when(in_progress_flg == "Y", IN_PROGRESS)
             .when((pattern != "IDEA") & (today_flg == "Y"), MISSED)
             .when((pattern != "IDEA") & (today_flg == "N"), NOT_SCHEDULED)
             .otherwise(MISSED_UNSCHEDULED))


def schedule_flags(cat, as_of: str | None = None) -> DataFrame:
    """PF-4..PF-7 per batch definition: schedule category, pattern (default
    'IDEA'), scheduled-today flag, in-progress flag (started on the as_of day
    without an end). One row per (definition, schedule, in-progress run)."""
    now = as_of_literal(as_of)
    bd = cat["ETLBatchDefinitionBASE"].select("BatchDefinitionID", "DataMartID")
    bs = cat["ETLBatchScheduleBASE"].select("BatchDefinitionID", "ScheduleID", "EnabledFLG")
    sp = cat["ETLSchedulePatternBASE"].select("ScheduleID", "PatternTypeCD")
    sh = cat["ETLScheduleBASE"].select("ScheduleID", "NextScheduledStartDTS")
    running = (cat["ETLBatchHistoryBASE"]
               .filter((F.to_date("StartDTS") == F.to_date(now)) & F.col("EndDTS").isNull())
               .select("BatchDefinitionID", F.col("StartDTS").alias("RunStartDTS")))
    x = (bd.join(bs, "BatchDefinitionID", "left")
           .join(sp, "ScheduleID", "left")
           .join(sh, "ScheduleID", "left")
           .join(running, "BatchDefinitionID", "left"))
    return x.select(
        "BatchDefinitionID", "DataMartID", "ScheduleID",
        schedule_category(F.col("ScheduleID"), F.col("EnabledFLG")).alias("ScheduleCategoryCD"),
        F.coalesce(F.col("PatternTypeCD"), F.lit("IDEA")).alias("SchedulePatternTypeCD"),
        scheduled_today(F.col("PatternTypeCD"), F.col("NextScheduledStartDTS"), as_of).alias("ScheduledTodayFLG"),
        F.when((F.to_date("RunStartDTS") == F.to_date(now)), "Y").otherwise("N").alias("InProgressFLG"),
        F.coalesce(fmt_ts(F.col("NextScheduledStartDTS")), F.lit("Unknown")).alias("NextScheduledStartDTS"))


def _side(cat, side: str) -> DataFrame:
    esb = cat["ETLSequencedBatches"]
    mart_col, batch_col = (("FromDataMartNM", "FromBatchDefinitionNM") if side == "from"
                           else ("ToDataMartNM", "ToBatchDefinitionNM"))
    return esb.select(F.col(mart_col).alias("DataMartNM"), F.col(batch_col).alias("RawBatchNM"),
                      "IsActiveFLG")


def sequenced_nodes(cat, as_of: str | None = None) -> DataFrame:
    """JOB-1: one row per distinct node of the declared sequence (both edge
    ends) with its statistics, schedule, run status and broken-reference flags,
    plus the rendered DOT label (``SegmentLabel``)."""
    marts = cat["DataMartBASE"].select("DataMartID", "DataMartNM", "DataMartTypeDSC")
    bd = cat["ETLBatchDefinitionBASE"].select("BatchDefinitionID", F.col("DataMartID").alias("BDMart"),
                                              F.col("BatchDefinitionNM").alias("RawBatchNM"))
    ends = _side(cat, "from").unionByName(_side(cat, "to")).select("DataMartNM", "RawBatchNM").distinct()
    x = (ends.join(marts, "DataMartNM", "left")
             .join(bd, (F.col("DataMartID") == F.col("BDMart")) & (ends["RawBatchNM"] == bd["RawBatchNM"]), "left")
             .drop(bd["RawBatchNM"]).drop("BDMart"))
    stats = run_stats(cat["ETLBatchHistoryBASE"], as_of).withColumnRenamed("DataMartID", "SMart")
    flags = schedule_flags(cat, as_of).drop("DataMartID", "ScheduleID")
    x = (x.join(stats, (F.col("DataMartID") == F.col("SMart")) & (x["BatchDefinitionID"] == stats["BatchDefinitionID"]), "left")
          .drop(stats["BatchDefinitionID"]).drop("SMart")
          .join(flags, "BatchDefinitionID", "left"))
    # a node without a definition still gets the defaults of the outer joins
    x = (x.withColumn("ScheduleCategoryCD", F.coalesce("ScheduleCategoryCD", F.lit("Schedule (None)")))
          .withColumn("SchedulePatternTypeCD", F.coalesce("SchedulePatternTypeCD", F.lit("IDEA")))
          .withColumn("ScheduledTodayFLG", F.coalesce("ScheduledTodayFLG", F.lit("N")))
          .withColumn("InProgressFLG", F.coalesce("InProgressFLG", F.lit("N")))
          .withColumn("NextScheduledStartDTS", F.coalesce("NextScheduledStartDTS", F.lit("Unknown")))
          .withColumn("SuccessFLG", F.coalesce("SuccessFLG", F.lit(0))))
    batch_nm = amp_to_and(F.col("RawBatchNM"))
    completed = F.coalesce(fmt_ts(F.col("LastSuccessDTS")), F.lit("Unknown"))
    status = run_status(F.col("SuccessFLG"), F.col("InProgressFLG"), F.col("SchedulePatternTypeCD"),
                        F.col("ScheduledTodayFLG"))
    y = x.select(
        tsql_concat(F.col("DataMartNM"), ".", batch_nm).alias("NodeKey"),
        "DataMartNM", "DataMartID", "DataMartTypeDSC", batch_nm.alias("BatchDefinitionNM"),
        "BatchDefinitionID", "AvgDurationNBR", "SuccessFLG", completed.alias("CompletedDTS"),
        "NextScheduledStartDTS", "ScheduleCategoryCD", "SchedulePatternTypeCD", "ScheduledTodayFLG",
        "InProgressFLG", status.alias("RunStatusCD"),
        (~F.coalesce(F.col("DataMartTypeDSC").isin("Source", "Subject Area"), F.lit(False))).alias("BrokenMartFLG"),
        F.col("BatchDefinitionID").isNull().alias("BrokenBatchFLG"))
    return y.withColumn("SegmentLabel", sequence_label()).distinct()


def sequence_label() -> Column:
    """DOT node line of the sequence graph: mart, batch, duration, schedule, and what the run status shows."""
    kind, status, done = F.col("DataMartTypeDSC"), F.col("RunStatusCD"), F.col("CompletedDTS")
    mart_cell = F.lit(SEQ_MART_CELL_BROKEN)
    for name, cell in SEQ_MART_CELL.items():
        mart_cell = F.when(kind == name, cell).otherwise(mart_cell)
    batch_cell = F.when(F.col("BatchDefinitionID").isNotNull(), SEQ_BATCH_CELL_OK).otherwise(SEQ_BATCH_CELL_BROKEN)
    last_run = tsql_concat(SEQ_LAST_RUN, done, CELL_CLOSE)
    both_runs = F.concat(last_run, tsql_concat(SEQ_NEXT_RUN, F.col("NextScheduledStartDTS"), CELL_CLOSE))
    shown = {FINISHED: tsql_concat(SEQ_FINISHED, done, CELL_CLOSE), IN_PROGRESS: F.lit(SEQ_RUNNING),
             MISSED: F.concat(both_runs, F.lit(DID_NOT_RUN)), NOT_SCHEDULED: F.concat(both_runs, F.lit(NOT_SCHEDULED_TODAY))}
    status_rows = F.concat(last_run, F.lit(DID_NOT_RUN))
    for code, rows in shown.items():
        status_rows = F.when(status == code, rows).otherwise(status_rows)
    minutes = tsql_concat("<tr><td>", DURATION, F.coalesce(F.col("AvgDurationNBR"), F.lit(0)), MINUTES, CELL_CLOSE)
    schedule = tsql_concat("<tr><td>", F.col("ScheduleCategoryCD"), " | ", F.col("SchedulePatternTypeCD"), CELL_CLOSE)
    return tsql_plus(
        tsql_concat('"', F.col("DataMartNM"), ".", F.col("BatchDefinitionNM"), '"'), F.lit(LABEL_OPEN),
        tsql_concat("<tr>", mart_cell, "<b>", F.col("DataMartNM"), NAME_CLOSE),
        tsql_concat(batch_cell, F.col("BatchDefinitionNM"), CELL_CLOSE, minutes, schedule, status_rows), F.lit(LABEL_CLOSE))


def service_base_url(services: DataFrame, service_name: str = "IDEA-Web") -> DataFrame:
    """SRC-6: one-row lookup of the service URL, '/' appended when missing.

    A global aggregate always yields exactly one row (NULL when the service is
    absent), so it can be used as a scalar subquery."""
    url = F.col("ServiceUrl")
    fixed = F.when(F.substring(url, -1, 1) == "/", url).otherwise(tsql_concat(url, "/"))
    return services.filter(F.col("ServiceNM") == service_name).agg(F.max(fixed).alias("BaseUrl"))


def app_id(marts: DataFrame, app_mart: str = "ETLSequencedBatches") -> DataFrame:
    """One-row lookup of the application id (the IDEA mart named like the table)."""
    return (marts.filter((F.col("DataMartNM") == app_mart) & (F.col("DataMartTypeDSC") == "IDEA"))
                 .agg(F.max("DataMartID").alias("AppID")))


def sequenced_edges(cat, services: DataFrame) -> DataFrame:
    """JOB-2: declared edges with link URL and style (PF-19)."""
    esb = cat["ETLSequencedBatches"]
    # both parameters are single-row aggregates, evaluated once as scalar subqueries
    x = esb.withColumns({"BaseUrl": service_base_url(services).scalar(),
                         "AppID": app_id(cat["DataMartBASE"]).scalar()})
    from_key = tsql_concat(F.col("FromDataMartNM"), ".", amp_to_and(F.col("FromBatchDefinitionNM")))
    to_key = tsql_concat(F.col("ToDataMartNM"), ".", amp_to_and(F.col("ToBatchDefinitionNM")))
    link = tsql_concat(F.col("BaseUrl"), "applications/", F.col("AppID"), "/entry/", F.col("ID"))
    active = F.col("IsActiveFLG") == 1
    display = tsql_plus(
        tsql_concat('"', F.col("FromDataMartNM"), ".", amp_to_and(F.col("FromBatchDefinitionNM")), '" -> "',
                    F.col("ToDataMartNM"), ".", amp_to_and(F.col("ToBatchDefinitionNM")), '"'),
        tsql_concat(' [href="', F.col("BaseUrl"), "applications/", F.col("AppID"), "/entry/", F.col("ID"), '" ',
                    F.when(active, EDGE_ACTIVE).otherwise(EDGE_INACTIVE), "]"))
    return x.select(
        "ID", from_key.alias("FromNodeKey"), to_key.alias("ToNodeKey"), "IsActiveFLG",
        F.when(active, "solid").otherwise("dashed").alias("EdgeStyleCD"),
        link.alias("LinkURL"), display.alias("SegmentDisplay"))
