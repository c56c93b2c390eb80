"""Structured Streaming versions of the monitoring jobs (ST-1..ST-5).

The sources are append-only history files read with ``readStream``; event
time is cast from TIMESTAMP_NTZ to TIMESTAMP before ``withWatermark``.
Results go through ``foreachBatch`` into a changelog below
``spark.checkpoint.dir``, a versioned table to which each micro-batch is
committed once under its number, so a batch that runs again adds nothing and
readers see committed batches only. Update-mode aggregates are exact when read
back: the latest row of each key wins. Checkpoints live in the same shared folder;
a run that is given the path of an earlier one goes on where that one stopped.

Watermarks are an argument. Without one no row is late: results equal the batch
twin's whatever the order and number of files, as a backfill needs, and state
grows with the keys. A live stream passes one to bound its state.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchlens.operators.refresh import ACTIVE_FIRST_HOUR, ACTIVE_LAST_HOUR
from batchlens.sources import tables
from batchlens.session import ensure_checkpoint_dir

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Event type -> run / refresh status, as in the fixture views.
STATUS_OF_EVENT = {"view": "InProgress", "click": "Unknown", "purchase": "Completed", "signup": "Success"}
STATUS_DEFAULT = "Failed"
COMPACT_AT = 50  # batches of a changelog


def status_of(event_type):
    m = F.create_map(*[x for k, v in STATUS_OF_EVENT.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[event_type], F.lit(STATUS_DEFAULT))


def history_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Run/refresh history arriving at ``path`` (a folder, or one file) as a
    stream: ObjectID, event_id, ts (TIMESTAMP), StatusCD."""
    s = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
         .option("recursiveFileLookup", "true").parquet(path))
    return s.select("event_id", F.col("user_id").alias("ObjectID"), F.col("ts").cast("timestamp").alias("ts"),
                    status_of(F.col("event_type")).alias("StatusCD"))


def _watermarked(stream: DataFrame, watermark: str | None) -> DataFrame:
    return stream if watermark is None else stream.withWatermark("ts", watermark)


def status_counts(stream: DataFrame, window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """ST-1: run-status counts per tumbling event-time window; with a
    watermark, rows within it still update their window and older state goes."""
    return (_watermarked(stream, watermark)
            .groupBy(F.window("ts", window).alias("w"), "StatusCD")
            .agg(F.count(F.lit(1)).alias("EventCNT"))
            .select(F.col("w.start").alias("WindowStartDTS"), F.col("w.end").alias("WindowEndDTS"),
                    "StatusCD", "EventCNT"))


def refresh_latest(stream: DataFrame) -> DataFrame:
    """ST-2: per object, latest status (by event time, then id), number of
    status checks and last check time; update mode keeps one row per object."""
    return (stream.groupBy("ObjectID")
            .agg(F.max_by("StatusCD", F.struct("ts", "event_id")).alias("LatestStatusCD"),
                 F.count(F.lit(1)).alias("CheckCNT"), F.max("ts").alias("LatestDTS")))


def dedup_loads(stream: DataFrame, watermark: str | None = None, period: str = "day") -> DataFrame:
    """ST-3: duplicate-load guard -- the first load per (object, period)
    passes, repeats are dropped. ``period`` is 'day' (Daily snapshots) or
    'month' (Monthly). With a watermark (at least the period), keys older
    than it are forgotten."""
    if period not in ("day", "month"):
        raise ValueError("period must be 'day' or 'month'")
    key = F.to_date("ts") if period == "day" else F.trunc(F.to_date("ts"), "MM")
    loads = _watermarked(stream, watermark).withColumn("LoadDT", key)
    drop = loads.dropDuplicates if watermark is None else loads.dropDuplicatesWithinWatermark
    return drop(["ObjectID", "LoadDT"]).select("ObjectID", "LoadDT")


def hourly_active(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """ST-5: hourly buckets restricted to the 06:00-20:59 active window."""
    return (_watermarked(stream.filter(F.hour("ts").between(ACTIVE_FIRST_HOUR, ACTIVE_LAST_HOUR)), watermark)
            .groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("EventCNT"))
            .select(F.col("w.start").alias("HourStartDTS"), "EventCNT"))


def retention_on_load(plan_fn, sink_dir: str):
    """ST-4: ``foreachBatch`` handler -- each micro-batch of completed loads
    (columns JobID, EntityID) runs ``plan_fn(loads) -> DataFrame`` (for
    example the purge plan restricted to those invocations) and writes the
    result to the batch's own folder below ``sink_dir``; a batch that runs
    again replaces it."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        out = plan_fn(batch.select("JobID", "EntityID").distinct())
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")
    return handle


def run_retention(loads: DataFrame, plan_fn, path: str) -> DataFrame:
    """ST-4 over everything available now: ``plan_fn`` for the loads (JobID, EntityID) of each micro-batch, all rows
    written so far. Below ``path`` lie the checkpoint, where a later call goes on, and the plans."""
    spark = loads.sparkSession
    q = (loads.writeStream.option("checkpointLocation", f"{path}/checkpoint")
         .foreachBatch(retention_on_load(plan_fn, f"{path}/plans")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{path}/plans").drop("batch_id")


def stream_path(spark: SparkSession, name: str, *key: str) -> str:
    """A folder below spark.checkpoint.dir that is the same for the same name and key, whichever run asks."""
    tag = hashlib.sha1("\n".join(key).encode()).hexdigest()[:16]
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}-{tag}"


def _latest_rows(changelog: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch_id"))
    return changelog.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def run_available_now(stream_df: DataFrame, mode: str, keys: list[str] | None = None,
                      name: str = "stream", path: str | None = None) -> DataFrame:
    """Run a streaming query over everything available now and return its
    final result as a batch DataFrame.

    ``path`` keeps the checkpoint and the changelog: a run that was stopped, or
    that finds new input, resumes there. Without it the run has a folder of its
    own. For ``update`` mode the row of the latest batch per ``keys`` wins; a
    changelog of more than ``COMPACT_AT`` batches is replaced by these rows."""
    spark = stream_df.sparkSession
    base = path or ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{name}-{uuid.uuid4().hex[:10]}"
    sink, ckpt = base + "/changelog", base + "/checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.append(batch.withColumn("_batch_id", F.lit(batch_id).cast("bigint")), sink, txn=(name, batch_id))

    q = (stream_df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    done = tables.version(spark, sink)
    if not done.number:  # there was no batch
        return spark.createDataFrame([], stream_df.schema)
    out = tables.read(spark, done)
    if mode == "update" and keys:
        out = _latest_rows(out, keys)
        if len(done.parts) > COMPACT_AT:
            out = tables.read(spark, tables.replace(out, done))
    return out.drop("_batch_id")


def refresh_monitor_handler(state_dir: str):
    """``foreachBatch`` handler keeping per-object refresh state as versions
    of a table at ``state_dir`` (shared folder), for histories that arrive in
    time order; ``monitor.RefreshMonitor`` does without that order.

    Each micro-batch (ObjectID, event_id, ts, StatusCD) is reduced with
    partial aggregates -- check count, first terminal check, checks before
    it, latest check -- so a hot object reaches the merge as one row; the
    merge is a full outer join with the previous state. A batch is committed
    once under its id, so a retried one is not counted twice. Assumes each object's checks arrive in time order across
    batches (an append-only history)."""
    from batchlens.operators.refresh import WAIT_STATUSES

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = tables.version(spark, state_dir)
        if base.txns.get("monitor", -1) >= batch_id:
            return
        terminal = ~F.col("StatusCD").isin(*WAIT_STATUSES)
        chk = F.struct("ts", "event_id", "StatusCD")
        agg = batch.groupBy("ObjectID").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.when(terminal, chk)).alias("ft"), F.max(chk).alias("last"))
        before = (batch.join(agg.select("ObjectID", "ft"), "ObjectID")
                  .groupBy("ObjectID").agg(F.count(F.when(
                      F.struct("ts", "event_id") < F.struct(F.col("ft.ts"), F.col("ft.event_id")), 1)).alias("b")))
        cur = agg.join(before, "ObjectID")
        prev = tables.read(spark, base) if base.number else spark.createDataFrame(
            [], "ObjectID bigint, CheckCNT bigint, FirstTerminalAttemptNBR bigint, "
                "FirstTerminalStatusCD string, Latest struct<ts:timestamp,event_id:bigint,StatusCD:string>")
        p, c = prev.alias("p"), cur.alias("c")
        prev_n = F.coalesce(F.col("p.CheckCNT"), F.lit(0))
        merged = p.join(c, F.col("p.ObjectID") == F.col("c.ObjectID"), "full_outer").select(
            F.coalesce(F.col("p.ObjectID"), F.col("c.ObjectID")).alias("ObjectID"),
            (prev_n + F.coalesce(F.col("c.n"), F.lit(0))).cast("bigint").alias("CheckCNT"),
            F.coalesce(F.col("p.FirstTerminalAttemptNBR"),
                       F.when(F.col("c.ft").isNotNull(), prev_n + F.col("c.b") + 1)).cast("bigint")
            .alias("FirstTerminalAttemptNBR"),
            F.when(F.col("p.FirstTerminalAttemptNBR").isNotNull(), F.col("p.FirstTerminalStatusCD"))
            .otherwise(F.col("c.ft.StatusCD")).alias("FirstTerminalStatusCD"),
            F.greatest(F.col("p.Latest"), F.col("c.last")).alias("Latest"))
        tables.replace(merged, base, txn=("monitor", batch_id))

    return handle


def refresh_monitor_outcome(state: DataFrame, operations: DataFrame, timeout: str | None = None) -> DataFrame:
    """Outcome per configured object from the monitor state (same rules as
    the batch ``refresh_outcome``). With ``timeout`` (an interval such as
    '2 hours'), an object still waiting whose last check is older than the
    newest check seen minus the timeout is TIMED_OUT instead of PENDING."""
    from batchlens.operators.refresh import DONE_STATUSES, FAILED_STATUS, WAIT_STATUSES, check_flag
    x = operations.join(state, "ObjectID", "left").withColumn("CheckCNT", F.coalesce("CheckCNT", F.lit(0)))
    retry = F.col("RetryAttemptNBR")
    fta = F.col("FirstTerminalAttemptNBR")
    outcome = (F.when(retry == 0, "NOT_CHECKED")
                .when(fta <= retry, F.when(F.col("FirstTerminalStatusCD").isin(*DONE_STATUSES), "COMPLETED")
                      .when(F.col("FirstTerminalStatusCD") == FAILED_STATUS, "FAILED").otherwise("STOPPED"))
                .when(F.col("CheckCNT") >= retry, "DID_NOT_COMPLETE"))
    if timeout is not None:
        # the newest check of any object: a one-row aggregate of the state
        newest = state.agg(F.max("Latest.ts")).scalar()
        stale = (F.col("Latest.StatusCD").isin(*WAIT_STATUSES)
                 & (F.col("Latest.ts") < newest - F.expr(f"INTERVAL {timeout}")))
        outcome = outcome.when(stale, "TIMED_OUT")
    outcome = outcome.otherwise("PENDING")
    return x.select(
        "ObjectID", "ObjectNM", "ObjectTypeCD", "RetryAttemptNBR", check_flag(retry).alias("CheckRefreshStatusFLG"),
        F.col("CheckCNT").cast("bigint").alias("CheckCNT"), F.col("Latest.StatusCD").alias("LatestStatusCD"),
        F.least(F.col("CheckCNT"), retry).cast("bigint").alias("ChecksUsedCNT"),
        fta.cast("bigint").alias("TerminalAttemptNBR"), outcome.alias("OutcomeCD"))


def run_refresh_monitor(stream: DataFrame, operations: DataFrame, name: str = "refresh_monitor") -> DataFrame:
    """Run the handler over everything available now; return the outcome per object."""
    spark = stream.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{name}-{uuid.uuid4().hex[:10]}"
    q = (stream.select("ObjectID", "event_id", "ts", "StatusCD").writeStream
         .option("checkpointLocation", base + "/checkpoint")
         .foreachBatch(refresh_monitor_handler(base + "/state")).trigger(availableNow=True).start())
    q.awaitTermination()
    return refresh_monitor_outcome(tables.read(spark, tables.version(spark, base + "/state")), operations)
