"""Refresh monitoring (JOB-26) and the hourly run calendar (JOB-27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Refresh status words and outcome codes.
DONE_STATUSES = ("Completed", "Success")
WAIT_STATUSES = ("InProgress", "Unknown")
FAILED_STATUS = "Failed"
ACTIVE_FIRST_HOUR, ACTIVE_LAST_HOUR = 6, 20


def check_flag(retry: Column) -> Column:
    """PF-21: check the refresh status only when retries are configured."""
    return F.when(retry == 0, "N").when(retry >= 1, "Y")


def refresh_outcome(history: DataFrame, operations: DataFrame) -> DataFrame:
    """JOB-26: per configured object, the latest status (W-2), the number of
    status checks, and the outcome of polling at most RetryAttemptNBR times:

    COMPLETED / FAILED / STOPPED (by any other status) -- the first status
    within the allowed checks that is neither InProgress nor Unknown; DID_NOT_COMPLETE -- all allowed checks saw InProgress/Unknown;
    PENDING -- fewer checks than allowed so far, none terminal;
    NOT_CHECKED -- retry count 0.

    ``TerminalAttemptNBR`` is the place of the first check of the whole history
    that ends a polling, also if it lies after the allowed ones; NULL if there is
    none. The first such check of each object is a partial aggregate; its place
    is one plus the checks before it, counted by a second one, so an object with
    a third of all history rows sends a few rows a task.
    """
    checks = history.select("ObjectID", "ts", "event_id", "StatusCD")
    order = F.struct("ts", "event_id")
    ends = ~F.col("StatusCD").isin(*WAIT_STATUSES)
    first = checks.filter(ends).groupBy("ObjectID").agg(F.min(F.struct("ts", "event_id", "StatusCD")).alias("_end"))
    before = (checks.join(first, "ObjectID").filter(order < F.struct("_end.ts", "_end.event_id"))
              .groupBy("ObjectID").agg(F.count(F.lit(1)).alias("_before")))
    terminal = first.join(before, "ObjectID", "left").select("ObjectID", F.struct(
        (F.coalesce("_before", F.lit(0)) + 1).alias("_at"), F.col("_end.StatusCD").alias("StatusCD")).alias("_first"))
    seen = checks.groupBy("ObjectID").agg(
        F.count(F.lit(1)).alias("CheckCNT"), F.max_by("StatusCD", F.struct("ts", "event_id")).alias("LatestStatusCD"))
    x = (operations.join(seen, "ObjectID", "left").join(terminal, "ObjectID", "left")
         .withColumn("CheckCNT", F.coalesce("CheckCNT", F.lit(0)))
         .withColumn("FirstTerminalStatusCD", F.col("_first.StatusCD")))
    retry = F.col("RetryAttemptNBR")
    term_attempt = F.col("_first._at")
    outcome = (F.when(retry == 0, "NOT_CHECKED")
                .when(term_attempt <= retry,
                      F.when(F.col("FirstTerminalStatusCD").isin(*DONE_STATUSES), "COMPLETED")
                      .when(F.col("FirstTerminalStatusCD") == FAILED_STATUS, "FAILED").otherwise("STOPPED"))
                .when(F.col("CheckCNT") >= retry, "DID_NOT_COMPLETE")
                .otherwise("PENDING"))
    return x.select(
        "ObjectID", "ObjectNM", "ObjectTypeCD", "RetryAttemptNBR", check_flag(retry).alias("CheckRefreshStatusFLG"),
        F.col("CheckCNT").cast("bigint").alias("CheckCNT"), "LatestStatusCD",
        F.least(F.col("CheckCNT"), retry).cast("bigint").alias("ChecksUsedCNT"),
        term_attempt.cast("bigint").alias("TerminalAttemptNBR"), outcome.alias("OutcomeCD"))


def active_hour(ts: Column) -> Column:
    """PF-28: inside the 06:00-20:59 run window."""
    return F.hour(ts).between(ACTIVE_FIRST_HOUR, ACTIVE_LAST_HOUR)


def next_run(ts: Column) -> Column:
    """Next run: top of the next hour inside the window, else 06:00 the same
    day (before 6) or the next day (after 20)."""
    day = F.date_trunc("day", ts)
    six = day + F.expr(f"INTERVAL {ACTIVE_FIRST_HOUR} HOURS")
    return (F.when(active_hour(ts), F.date_trunc("hour", ts) + F.expr("INTERVAL 1 HOUR"))
             .when(F.hour(ts) < ACTIVE_FIRST_HOUR, six)
             .otherwise(six + F.expr("INTERVAL 1 DAY")))


def run_calendar(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """JOB-27: active-hours flag, next run time and wait seconds for each
    timestamp."""
    ts = F.col(ts_col)
    nr = next_run(ts)
    wait = (F.unix_micros(nr.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / F.lit(1e6)
    return df.select("*", active_hour(ts).alias("ActiveFLG"), nr.alias("NextRunDTS"), wait.alias("WaitSecondsNBR"))
