"""The stateful refresh monitor equals the batch job whatever the order of arrival, and streams go on where they stopped."""
import datetime as dt
import random

from pyspark.sql import functions as F

from batchlens.operators.refresh import refresh_outcome
from batchlens.sources import tables
from batchlens.streaming.jobs import history_stream, run_available_now, run_retention, status_counts, status_of
from batchlens.streaming.monitor import first_terminal, merged, run_monitor

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
OPS = "ObjectID bigint, ObjectNM string, ObjectTypeCD string, RetryAttemptNBR int"


def _rows(n=120):
    rng = random.Random(6)
    types = ["view"] * 6 + ["click"] * 4 + ["purchase", "signup", "error"]
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 400)),
             rng.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, 99]), rng.choice(types), 1.0, "{}") for i in range(n)]
    rng.shuffle(rows)
    return rows


def _write(spark, rows, folder, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], EVENTS).coalesce(1).write.mode("append").parquet(folder)


def _batch(spark, rows, ops):
    hist = spark.createDataFrame(rows, EVENTS).select(
        "event_id", F.col("user_id").alias("ObjectID"), "ts", status_of(F.col("event_type")).alias("StatusCD"))
    return {r.ObjectID: tuple(r) for r in refresh_outcome(hist, ops).collect()}


def _ops(spark):
    return spark.createDataFrame([(o, f"o{o}", "Dataflow", r) for o, r in [(1, 9), (2, 3), (3, 30), (4, 0), (5, 1), (6, 4), (7, 2), (8, 5)]], OPS)


def test_shuffled_batches_equal_the_batch_job(spark, tmp_path):
    rows, ops = _rows(), _ops(spark)
    want = _batch(spark, rows, ops)
    folder = str(tmp_path / "h")
    _write(spark, rows, folder, 4)  # each file a micro-batch, times mixed over all of them
    got = {r.ObjectID: tuple(r) for r in run_monitor(history_stream(spark, folder, 1), ops, path=str(tmp_path / "run")).collect()}
    assert got == want
    # more checks, also earlier ones, arrive; the run goes on with its state
    more = [(1000 + i, dt.datetime(2024, 1, 1, 0, 1, i % 60), o, e, 1.0, "{}")
            for i, (o, e) in enumerate([(1, "error"), (2, "view"), (3, "purchase"), (6, "click"), (8, "view")])]
    _write(spark, more, folder, 2)
    got = {r.ObjectID: tuple(r) for r in run_monitor(history_stream(spark, folder, 1), ops, path=str(tmp_path / "run")).collect()}
    assert got == _batch(spark, rows + more, ops)


def test_timer_closes_idle_objects(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    ops = spark.createDataFrame([(1, "a", "x", 9), (2, "b", "x", 9), (3, "c", "x", 9)], OPS)
    folder = str(tmp_path / "h")
    for rows in ([(1, t(0), 1, "view", 1.0, "{}"), (2, t(1), 2, "view", 1.0, "{}"), (3, t(2), 2, "purchase", 1.0, "{}"),
                  (4, t(3), 3, "view", 1.0, "{}")],
                 [(5, t(50), 3, "click", 1.0, "{}")], [(6, t(52), 3, "view", 1.0, "{}")]):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    out = run_monitor(history_stream(spark, folder, 1), ops, path=str(tmp_path / "run"), timeout_seconds=600)
    assert {r.ObjectID: r.OutcomeCD for r in out.collect()} == {1: "TIMED_OUT", 2: "COMPLETED", 3: "PENDING"}


def test_merge_does_not_depend_on_order():
    rng = random.Random(1)
    checks = [(rng.randint(0, 9), i, rng.choice(["InProgress", "Unknown", "Failed"])) for i in range(40)]
    want = merged(None, checks, 5)
    for _ in range(20):
        rng.shuffle(checks)
        cut = sorted(rng.sample(range(1, 40), 3))
        state = None
        for a, b in zip([0, *cut], [*cut, 40], strict=True):
            state = merged(state, checks[a:b], 5)
        assert state == want
    assert first_terminal((3, 0, 0, "x", [], [], ["Unknown", "InProgress", "Failed"])) == (3, "Failed")
    assert first_terminal((1, 0, 0, "x", [], [], [])) == (None, None)


def test_streams_resume(spark, tmp_path):
    """Stopped after some input and started again: the same result as in one go, and nothing is counted twice."""
    rows, folder, run = _rows(), str(tmp_path / "h"), str(tmp_path / "run")

    def counts(path):
        out = run_available_now(status_counts(history_stream(spark, folder, 1)), "update", ["WindowStartDTS", "StatusCD"], "c", path)
        return sorted(map(tuple, out.collect()))

    _write(spark, rows[:70], folder, 2)
    first = counts(run)
    assert sum(r[3] for r in first) == 70
    assert counts(run) == first  # nothing new
    _write(spark, rows[70:], folder, 2)
    assert counts(run) == counts(None) and sum(r[3] for r in counts(run)) == 120
    log = tables.version(spark, run + "/changelog")
    assert log.txns["c"] == 3
    tables.append(spark.range(1), run + "/changelog", txn=("c", 3))  # an epoch that is tried again
    assert tables.version(spark, run + "/changelog").number == log.number


def test_retention_resumes(spark, tmp_path):
    src, run = str(tmp_path / "loads"), str(tmp_path / "run")
    config = spark.createDataFrame([(1, 30)], "EntityID bigint, Days int")
    plan = lambda batch: batch.join(config, "EntityID")
    stream = lambda: spark.readStream.schema("JobID bigint, EntityID bigint").parquet(src)
    spark.createDataFrame([(1, 1), (2, 2)], "JobID bigint, EntityID bigint").coalesce(1).write.parquet(src)
    assert run_retention(stream(), plan, run).count() == 1
    spark.createDataFrame([(3, 1)], "JobID bigint, EntityID bigint").coalesce(1).write.mode("append").parquet(src)
    assert sorted(r.JobID for r in run_retention(stream(), plan, run).collect()) == [1, 3]
    assert run_retention(stream(), plan, run).count() == 2
