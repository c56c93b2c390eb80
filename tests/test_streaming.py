"""Streaming jobs equal their batch twins over a file stream."""
import datetime as dt

from pyspark.sql import functions as F


from batchlens.streaming.jobs import (dedup_loads, history_stream, hourly_active, refresh_latest,
                                      run_available_now, status_counts)


def _events(spark, folder):
    t = dt.datetime
    rows = [(i, t(2024, 1, 1, h, m), u, et, 1.0, '{"k": 1}')
            for i, (h, m, u, et) in enumerate([(5, 1, 1, "view"), (6, 5, 1, "purchase"), (6, 30, 2, "click"),
                                                (7, 0, 2, "signup"), (21, 10, 1, "error"), (6, 40, 1, "view")])]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    df.coalesce(1).write.parquet(folder + "/batch1")


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "events")
    _events(spark, folder)
    s = lambda: history_stream(spark, folder + "/batch1")
    counts = run_available_now(status_counts(s()), "update", ["WindowStartDTS", "StatusCD"], "t1")
    got = {(str(r.WindowStartDTS), r.StatusCD): r.EventCNT for r in counts.collect()}
    assert got[("2024-01-01 06:00:00", "InProgress")] == 1 and got[("2024-01-01 06:00:00", "Completed")] == 1
    assert sum(got.values()) == 6
    latest = {r.ObjectID: (r.LatestStatusCD, r.CheckCNT) for r in
              run_available_now(refresh_latest(s()), "update", ["ObjectID"], "t2").collect()}
    assert latest == {1: ("Failed", 4), 2: ("Success", 2)}
    loads = run_available_now(dedup_loads(s()), "append", name="t3")
    assert sorted((r.ObjectID, str(r.LoadDT)) for r in loads.collect()) == [(1, "2024-01-01"), (2, "2024-01-01")]
    hours = {str(r.HourStartDTS): r.EventCNT for r in
             run_available_now(hourly_active(s()), "update", ["HourStartDTS"], "t4").collect()}
    assert hours == {"2024-01-01 06:00:00": 3, "2024-01-01 07:00:00": 1}


def test_unordered_files_equal_batch(spark, tmp_path):
    """Rows days apart in files of any order, one file a micro-batch: nothing is late without a watermark."""
    t = dt.datetime
    rows = [(i, t(2024, 1, 1 + (i * 5) % 9, 6 + i % 4, i % 60), i % 3, "view", 1.0, "{}") for i in range(60)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    folder = str(tmp_path / "unordered")
    for part in (2, 0, 1):
        spark.createDataFrame(sorted(rows, key=lambda r: r[1])[part::3][::-1], schema).coalesce(1).write.mode(
            "append").parquet(folder)
    s = lambda: history_stream(spark, folder, 1)
    counts = run_available_now(status_counts(s()), "update", ["WindowStartDTS", "StatusCD"], "u1")
    assert counts.agg(F.sum("EventCNT")).first()[0] == 60
    hours = run_available_now(hourly_active(s()), "update", ["HourStartDTS"], "u2")
    assert hours.agg(F.sum("EventCNT")).first()[0] == 60
    loads = run_available_now(dedup_loads(s()), "append", name="u3").collect()
    assert sorted((r.ObjectID, r.LoadDT) for r in loads) == sorted({(r[2], r[1].date()) for r in rows})


def test_retention_on_load_foreach_batch(spark, tmp_path):
    from batchlens.streaming.jobs import retention_on_load
    loads = spark.createDataFrame([(100, 1), (100, 1), (101, 2)], "JobID bigint, EntityID bigint")
    loads.coalesce(1).write.parquet(str(tmp_path / "loads"))
    config = spark.createDataFrame([(1, 30), (3, 0)], "EntityID bigint, PurgeLookbackDaysNBR int")

    def plan_fn(batch):  # the post-entity hook: plan only for configured entities that just loaded
        return batch.join(config, "EntityID")

    sink = str(tmp_path / "plans")
    stream = spark.readStream.schema("JobID bigint, EntityID bigint").parquet(str(tmp_path / "loads"))
    q = (stream.writeStream.foreachBatch(retention_on_load(plan_fn, sink))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = [(r.JobID, r.EntityID, r.PurgeLookbackDaysNBR) for r in spark.read.parquet(sink).collect()]
    assert got == [(100, 1, 30)]
    retention_on_load(plan_fn, sink)(loads, 0)  # a batch that runs again
    assert spark.read.parquet(sink).count() == 1


def test_dedup_loads_monthly(spark, tmp_path):
    folder = str(tmp_path / "events")
    _events(spark, folder)
    loads = run_available_now(dedup_loads(history_stream(spark, folder + "/batch1"), period="month"), "append",
                              name="t5")
    assert sorted((r.ObjectID, str(r.LoadDT)) for r in loads.collect()) == [(1, "2024-01-01"), (2, "2024-01-01")]


def test_refresh_monitor_across_batches_equals_batch_outcome(spark, tmp_path):
    from batchlens.operators.refresh import refresh_outcome
    from batchlens.streaming.jobs import refresh_monitor_handler, refresh_monitor_outcome, run_refresh_monitor, status_of
    from batchlens.sources.sinks import read_latest
    rnd_types = ["view", "click", "purchase", "signup", "error"]
    folder = tmp_path / "hist"
    rows_all = []
    eid = 0
    for part in range(3):                      # three files -> three micro-batches, time ordered
        rows = []
        for obj in range(1, 6):
            for k in range(4):
                et = rnd_types[(obj * 7 + part * 3 + k) % 5] if not (obj == 2 and part < 2) else "view"
                rows.append((eid, dt.datetime(2024, 1, 1 + part, obj, k), obj, et, 1.0, "{}"))
                eid += 1
        rows_all += rows
        spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                    "value double, props string").coalesce(1).write.parquet(str(folder / f"p{part}"))
    ops = spark.createDataFrame([(o, f"o{o}", "Dataflow", r) for o, r in [(1, 2), (2, 9), (3, 12), (4, 0), (5, 1), (6, 3)]],
                                "ObjectID bigint, ObjectNM string, ObjectTypeCD string, RetryAttemptNBR int")
    s = (spark.readStream.schema("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                                 "props STRING").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
         .parquet(str(folder))
         .select("event_id", F.col("user_id").alias("ObjectID"), F.col("ts").cast("timestamp").alias("ts"),
                 status_of(F.col("event_type")).alias("StatusCD")))
    got = {r.ObjectID: tuple(r) for r in run_refresh_monitor(s, ops, "t6").collect()}
    hist = spark.createDataFrame(rows_all, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                           "value double, props string").select(
        "event_id", F.col("user_id").alias("ObjectID"), "ts", status_of(F.col("event_type")).alias("StatusCD"))
    want = {r.ObjectID: tuple(r) for r in refresh_outcome(hist, ops).collect()}
    assert got == want
    # a retried batch id is not applied twice
    state_dir = str(tmp_path / "state")
    h = refresh_monitor_handler(state_dir)
    one = hist.filter("ObjectID = 1").withColumn("ts", F.col("ts").cast("timestamp"))
    h(one, 0)
    h(one, 0)
    assert read_latest(spark, state_dir).filter("ObjectID = 1").first().CheckCNT == 12
    assert refresh_monitor_outcome(read_latest(spark, state_dir), ops).filter("ObjectID = 1").first().CheckCNT == 12


def test_refresh_monitor_timeout(spark):
    from batchlens.streaming.jobs import refresh_monitor_outcome
    t = dt.datetime
    state = spark.createDataFrame([
        (1, 3, None, None, (t(2024, 1, 1, 1), 1, "InProgress")),
        (2, 3, None, None, (t(2024, 1, 1, 9), 2, "Unknown")),
        (3, 3, 2, "Completed", (t(2024, 1, 1, 2), 3, "Completed"))],
        "ObjectID bigint, CheckCNT bigint, FirstTerminalAttemptNBR bigint, FirstTerminalStatusCD string, "
        "Latest struct<ts:timestamp,event_id:bigint,StatusCD:string>")
    ops = spark.createDataFrame([(1, "a", "x", 10), (2, "b", "x", 10), (3, "c", "x", 10)],
                                "ObjectID bigint, ObjectNM string, ObjectTypeCD string, RetryAttemptNBR int")
    got = {r.ObjectID: r.OutcomeCD for r in refresh_monitor_outcome(state, ops, "2 hours").collect()}
    assert got == {1: "TIMED_OUT", 2: "PENDING", 3: "COMPLETED"}
    assert {r.ObjectID: r.OutcomeCD for r in refresh_monitor_outcome(state, ops).collect()}[1] == "PENDING"
