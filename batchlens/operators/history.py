"""JOB-28: monthly effective-dated history -- for every month of the last 15
years up to the current month, the one effective row per entity that
overlaps the month (earliest end date, then company descending)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.session import as_of_literal


def month_calendar(spark, start: str, end: str) -> DataFrame:
    """Month rows (MonthStartDTS, MonthEndDTS) from ``start`` to ``end``."""
    return (spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                        F.expr("INTERVAL 1 MONTH"))).alias("MonthStartDTS"))
            .select(F.trunc("MonthStartDTS", "MM").alias("MonthStartDTS"))
            .distinct()
            .withColumn("MonthEndDTS", F.last_day("MonthStartDTS")))


def monthly_effective_history(events: DataFrame, calendar: DataFrame, as_of: str | None = None,
                              years: int = 15, entity: str = "EmployeeID",
                              tie_break: str | None = None) -> DataFrame:
    """J-13 + W-1.

    The month-overlap join (from <= month end AND to >= month start) is done
    as an equi-join: each event is expanded to the months it spans (bounded
    by the calendar's range), then joined on the month key -- no nested-loop
    range join. The calendar is reduced to distinct months first (a daily
    calendar would otherwise match each month once per day). ``row_number``
    = 1 per (entity, month) is planned with a partial group limit before the
    shuffle, so a hot entity does not funnel all its rows into one sort.
    ``tie_break`` names a column that completes the order, so the pick is deterministic.
    """
    now = F.to_date(as_of_literal(as_of))
    cal = (calendar.select(F.trunc("MonthStartDTS", "MM").alias("MonthStartDTS")).distinct()
           .filter((F.year("MonthStartDTS") > F.year(now) - years)
                   & (F.last_day("MonthStartDTS") <= F.last_day(now)))
           .withColumn("MonthEndDTS", F.last_day("MonthStartDTS")))
    # the calendar filter's own bounds (first month of the window, current
    # month) clamp each event's month range: no lookup of the calendar needed
    lo = F.make_date(F.year(now) - (years - 1), F.lit(1), F.lit(1))
    hi = F.trunc(now, "MM")
    f, t = F.col("EventFromEffectiveDTS"), F.col("EventToEffectiveDTS")
    m0 = F.greatest(F.trunc(F.to_date(f), "MM"), lo)
    m1 = F.least(F.trunc(F.to_date(t), "MM"), hi)
    ex = (events.filter(f.isNotNull() & t.isNotNull() & (m0 <= m1))
                .withColumn("MonthStartDTS", F.explode(F.sequence(m0, m1, F.expr("INTERVAL 1 MONTH")))))
    j = ex.join(cal, "MonthStartDTS")
    # exact overlap test on the original values (month keys are a superset)
    j = j.filter((f <= F.col("MonthEndDTS")) & (t >= F.col("MonthStartDTS")))
    order = [F.col("EventToEffectiveDTS").asc(), F.col("CompanyCD").desc()]
    if tie_break:
        order.append(F.col(tie_break).asc())
    w = Window.partitionBy(entity, "MonthStartDTS").orderBy(*order)
    return (j.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
             .select("MonthStartDTS", "MonthEndDTS", entity, "EventFromEffectiveDTS", "EventToEffectiveDTS",
                     F.col("EventCodeDSC").alias("RemoteWorkDSC"), "CompanyCD",
                     *(["SourceDSC"] if "SourceDSC" in events.columns else []),
                     *([tie_break] if tie_break else [])))
