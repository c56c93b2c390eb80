"""JOB-23: ETL progress -- table-load counts and shares by status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Table-history status codes and their display class (PF-20).
STATUS_CLASS = {"C": "Completed", "F": "Failed", "R": "Running", "P": "Pending", "W": "Waiting"}
STATUS_CLASS_DEFAULT = "Other"


def status_class(c):
    m = F.create_map(*[x for k, v in STATUS_CLASS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.lit(STATUS_CLASS_DEFAULT))


def _batch_filter(batch_history: DataFrame, batch_ids) -> DataFrame:
    bh = batch_history.select("BatchID", "StatusCD")
    if batch_ids is None:
        return bh
    if isinstance(batch_ids, DataFrame):  # PF-17 as a semi join with a key DataFrame
        return bh.join(batch_ids.select("BatchID").distinct(), "BatchID", "left_semi")
    return bh.filter(F.col("BatchID").isin(list(batch_ids)))


def etl_progress(batch_history: DataFrame, table_history: DataFrame, batch_ids=None) -> DataFrame:
    """A-1/A-2/W-4: count of table loads per status over the selected batches,
    grand total and percent share (one decimal).

    Table history is pre-aggregated per (BatchID, StatusCD) before the join, so
    a batch that owns a large share of the rows reaches the join as a handful
    of rows."""
    pre = table_history.groupBy("BatchID", "StatusCD").agg(F.count(F.lit(1)).alias("n"))
    bh = _batch_filter(batch_history, batch_ids).select("BatchID")
    # ETLBatchHistoryBASE is keyed by BatchID, but keep the inner-join
    # multiplicity exactly: count batch rows per id first.
    bh = bh.groupBy("BatchID").agg(F.count(F.lit(1)).alias("m"))
    g = (pre.join(bh, "BatchID").groupBy("StatusCD")
            .agg(F.sum(F.col("n") * F.col("m")).cast("bigint").alias("Count")))
    # W-4 over the per-status aggregate (one row per status code), not over
    # the history: the unpartitioned window sees a handful of rows, and the
    # total needs no second pass over the input (a scalar subquery would
    # re-plan the whole aggregate)
    total = F.sum("Count").over(Window.partitionBy())
    return g.select("StatusCD", status_class(F.col("StatusCD")).alias("StatusClassNM"), "Count",
                    total.cast("bigint").alias("TotalCount"),
                    F.round(F.col("Count") * 100.0 / total, 1).alias("SharePct"))


def status_share(batch_history: DataFrame, table_history: DataFrame) -> DataFrame:
    """Share of each table status within each batch run status (W-4 with a
    partition): counts per (batch StatusCD, table StatusCD) and percent of the
    batch-status total."""
    pre = table_history.groupBy("BatchID", "StatusCD").agg(F.count(F.lit(1)).alias("n"))
    bh = (batch_history.groupBy("BatchID", F.col("StatusCD").alias("BatchStatusCD"))
          .agg(F.count(F.lit(1)).alias("m")))
    g = (pre.join(bh, "BatchID").groupBy("BatchStatusCD", "StatusCD")
            .agg(F.sum(F.col("n") * F.col("m")).cast("bigint").alias("Count")))
    total = F.sum("Count").over(Window.partitionBy("BatchStatusCD"))
    return g.select("BatchStatusCD", "StatusCD", "Count", total.cast("bigint").alias("BatchStatusTotal"),
                    F.round(F.col("Count") * 100.0 / total, 1).alias("SharePct"))
