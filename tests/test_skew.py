"""Hot keys: one batch / one object owns a third of all rows. The jobs
pre-aggregate before joining, so results must equal plain brute-force
aggregates over the same skewed inputs."""
from pyspark.sql import functions as F

from batchlens.operators.progress import etl_progress
from batchlens.operators.refresh import refresh_outcome


def test_progress_with_hot_batch(spark):
    n = 30000
    th = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).cast("bigint").alias("BatchID"),
        F.element_at(F.array(*[F.lit(x) for x in "CFRPW"]), (F.col("id") % 5 + 1).cast("int")).alias("StatusCD"))
    bh = spark.range(997).select(F.col("id").alias("BatchID"), F.lit("Succeeded").alias("StatusCD"))
    got = {r.StatusCD: (r.Count, r.TotalCount) for r in etl_progress(bh, th).collect()}
    want = {r.StatusCD: r["count"] for r in th.join(bh.select("BatchID"), "BatchID").groupBy("StatusCD").count().collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] == n for v in got.values())


def test_refresh_outcome_with_hot_object(spark):
    n = 9000
    statuses = F.array(*[F.lit(x) for x in ["InProgress", "Unknown", "Completed", "Failed"]])
    hist = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 2).cast("bigint").alias("ObjectID"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"),
        F.when(F.col("id") < 3000, F.lit("InProgress")).otherwise(
            F.element_at(statuses, (F.col("id") % 4 + 1).cast("int"))).alias("StatusCD"))
    ops = spark.range(1, 52).select(F.col("id").alias("ObjectID"), F.lit("o").alias("ObjectNM"),
                                     F.lit("Dataflow").alias("ObjectTypeCD"), F.lit(2000).alias("RetryAttemptNBR"))
    got = {r.ObjectID: (r.CheckCNT, r.TerminalAttemptNBR, r.OutcomeCD) for r in refresh_outcome(hist, ops).collect()}
    # brute force for the hot object: rows in time order, first terminal status
    rows = sorted(((r.ts, r.event_id, r.StatusCD) for r in hist.filter("ObjectID = 1").collect()))
    first = next(i for i, r in enumerate(rows, 1) if r[2] in ("Completed", "Success", "Failed"))
    assert got[1][0] == len(rows) == n // 3
    assert got[1][1] == first and got[1][2] == ("COMPLETED" if rows[first - 1][2] == "Completed" else "FAILED")
