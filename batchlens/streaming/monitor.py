"""ST-2: the refresh monitor as a stateful operator.

Per object the state holds the number of checks, the latest check and the
earliest checks up to the first that ends the polling. These are a count, a
maximum and a minimum with what lies before it, so the state is the same whatever
the order in which checks arrive and however micro-batches cut them. What comes
after the first ending check is only counted.

With a time-out (event time) a timer runs from the latest check: when the
watermark passes it, the object's last row is emitted -- ``TimedOutFLG`` if it
was still waiting -- and its state is removed, so finished objects cost nothing.
A check that comes later opens the object anew: it belongs to its next refresh.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from batchlens.operators.refresh import WAIT_STATUSES
from batchlens.streaming.jobs import run_available_now, refresh_monitor_outcome

STATE = "n long, last_us long, last_id long, last_status string, us array<long>, ids array<long>, statuses array<string>, allowed int"
OUTPUT = ("ObjectID long, CheckCNT long, FirstTerminalAttemptNBR long, FirstTerminalStatusCD string, "
          "LatestDTS timestamp, LatestID long, LatestStatusCD string, TimedOutFLG boolean")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = dt.datetime(1970, 1, 1)


def merged(state: tuple | None, checks: list[tuple], allowed: int) -> tuple:
    """The state after more ``checks`` (micros, id, status); independent of their order."""
    n, last, first = 0, (), []
    if state is not None:
        n, last = state[0], (state[1], state[2], state[3])
        first = list(zip(state[4], state[5], state[6], strict=True))
    last = max([last, *checks]) if last else max(checks)
    end = min((x for x in first + checks if x[2] not in WAIT_STATUSES), default=None)
    first = sorted(x for x in first + checks if end is None or x <= end)
    return (n + len(checks), *last, [x[0] for x in first], [x[1] for x in first], [x[2] for x in first], allowed)


def first_terminal(state: tuple) -> tuple[int | None, str | None]:
    """(attempt, status) of the first check that ends the polling, within the allowed ones or after them."""
    for at, status in enumerate(state[6], 1):
        if status not in WAIT_STATUSES:
            return at, status
    return None, None


class RefreshMonitor(StatefulProcessor):
    """Input columns: ObjectID, event_id, us (event time in micros), StatusCD, allowed (attempts)."""

    def __init__(self, timeout_ms: int | None = None):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("checks", STATE)

    def _row(self, key, state: tuple, timed_out: bool = False) -> pd.DataFrame:
        attempt, status = first_terminal(state)
        return pd.DataFrame({
            "ObjectID": [key[0]], "CheckCNT": [state[0]], "FirstTerminalAttemptNBR": pd.array([attempt], "Int64"),
            "FirstTerminalStatusCD": [status], "LatestDTS": [pd.Timestamp(state[1], unit="us", tz="UTC")],
            "LatestID": [state[2]], "LatestStatusCD": [state[3]], "TimedOutFLG": [timed_out]})

    def handleInputRows(self, key, rows, timerValues):
        state = self.state.get() if self.state.exists() else None
        for pdf in rows:
            checks = [(int(a), int(b), str(c)) for a, b, c in zip(pdf.us, pdf.event_id, pdf.StatusCD, strict=True)]
            if checks:
                state = merged(state, checks, int(pdf.allowed.iloc[0]))
        self.state.update(state)
        if self.timeout_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(state[1] // 1000 + self.timeout_ms)
        yield self._row(key, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            state = self.state.get()
            self.state.clear()
            attempt = first_terminal(state)[0]
            yield self._row(key, state, state[3] in WAIT_STATUSES and (attempt is None or attempt > state[7]))

    def close(self) -> None:
        pass


def monitored(stream: DataFrame, operations: DataFrame, timeout_seconds: int | None = None,
              watermark: str = "0 seconds") -> DataFrame:
    """One row per object and micro-batch in which it changed (update mode). ``operations`` names the objects and the
    attempts they are allowed; checks of other objects are left out."""
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE:
        raise ValueError(f"transformWithState needs spark.sql.streaming.stateStore.providerClass = {STATE_STORE}")
    allowed = operations.select("ObjectID", F.col("RetryAttemptNBR").cast("int").alias("allowed"))
    timed = stream if timeout_seconds is None else stream.withWatermark("ts", watermark)
    checks = timed.join(allowed, "ObjectID").select(
        "ObjectID", "event_id", "ts", F.unix_micros("ts").alias("us"), "StatusCD", "allowed")
    return checks.groupBy("ObjectID").transformWithStateInPandas(
        RefreshMonitor(None if timeout_seconds is None else timeout_seconds * 1000), OUTPUT, "Update",
        "None" if timeout_seconds is None else "eventTime")


def run_monitor(stream: DataFrame, operations: DataFrame, name: str = "refresh_monitor", path: str | None = None,
                timeout_seconds: int | None = None, watermark: str = "0 seconds") -> DataFrame:
    """The outcome per object after everything available now; with ``path`` a later call goes on from there.

    An object whose time-out has expired is TIMED_OUT if no check within its attempts ended its polling."""
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        rows = run_available_now(monitored(stream, operations, timeout_seconds, watermark), "update", ["ObjectID"], name, path)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    state = rows.select("ObjectID", "CheckCNT", "FirstTerminalAttemptNBR", "FirstTerminalStatusCD", F.struct(
        F.col("LatestDTS").alias("ts"), F.col("LatestID").alias("event_id"), F.col("LatestStatusCD").alias("StatusCD"))
        .alias("Latest"), "TimedOutFLG")
    out = refresh_monitor_outcome(state.drop("TimedOutFLG"), operations)
    late = state.where("TimedOutFLG").select("ObjectID", F.lit(True).alias("_late"))
    return out.join(late, "ObjectID", "left").withColumn("OutcomeCD", F.when(
        F.col("_late") & F.col("OutcomeCD").isin("PENDING", "DID_NOT_COMPLETE"), "TIMED_OUT").otherwise(F.col("OutcomeCD"))).drop("_late")


