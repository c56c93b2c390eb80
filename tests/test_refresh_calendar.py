import datetime as dt

from batchlens.operators.refresh import refresh_outcome, run_calendar


def test_refresh_outcomes(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    hist = spark.createDataFrame([
        (1, 1, t(1), "InProgress"), (2, 1, t(2), "Completed"),
        (3, 2, t(1), "Unknown"), (4, 2, t(2), "InProgress"), (5, 2, t(3), "Failed"),
        (6, 3, t(1), "InProgress"),
        (7, 4, t(1), "Failed"),
    ], "event_id bigint, ObjectID bigint, ts timestamp_ntz, StatusCD string")
    ops = spark.createDataFrame([(1, "a", "Dataflow", 5), (2, "b", "Dataflow", 2), (3, "c", "Dataflow", 5),
                                 (4, "d", "Dataflow", 0), (5, "e", "Dataflow", 3)],
                                "ObjectID bigint, ObjectNM string, ObjectTypeCD string, RetryAttemptNBR int")
    got = {r.ObjectID: (r.OutcomeCD, r.LatestStatusCD) for r in refresh_outcome(hist, ops).collect()}
    assert got[1] == ("COMPLETED", "Completed")
    assert got[2] == ("DID_NOT_COMPLETE", "Failed")   # failure came after the 2 allowed checks
    assert got[3] == ("PENDING", "InProgress")
    assert got[4] == ("NOT_CHECKED", "Failed")
    assert got[5] == ("PENDING", None)              # configured, no checks yet


def test_run_calendar(spark):
    d = dt.datetime
    df = spark.createDataFrame([(d(2024, 1, 1, 5, 10),), (d(2024, 1, 1, 6, 0),), (d(2024, 1, 1, 20, 59),),
                                (d(2024, 1, 1, 21, 0),)], "ts timestamp_ntz")
    rows = run_calendar(df).collect()
    assert [r.ActiveFLG for r in rows] == [False, True, True, False]
    assert [r.NextRunDTS for r in rows] == [d(2024, 1, 1, 6), d(2024, 1, 1, 7), d(2024, 1, 1, 21), d(2024, 1, 2, 6)]
    assert rows[0].WaitSecondsNBR == 50 * 60


def test_other_status_stops_polling(spark):
    """A status that is none of the known words ends the polling, whatever comes after it."""
    from batchlens.operators.refresh import refresh_outcome
    history = spark.sql("SELECT * FROM VALUES (1L, 1, timestamp_ntz'2001-01-01 00:00:00', 'Cancelled'), "
                        "(2L, 1, timestamp_ntz'2001-01-01 00:01:00', 'Completed') AS t(event_id, ObjectID, ts, StatusCD)")
    ops = spark.sql("SELECT 1 AS ObjectID, 'a' AS ObjectNM, 'Model' AS ObjectTypeCD, 3 AS RetryAttemptNBR")
    assert [r.OutcomeCD for r in refresh_outcome(history, ops).collect()] == ["STOPPED"]


def test_terminal_check_after_the_allowed_ones(spark):
    """The place of the first terminal check is taken over the whole history, not over the allowed checks alone."""
    from batchlens.operators.refresh import refresh_outcome
    history = spark.sql("SELECT id AS event_id, o AS ObjectID, timestamp_ntz'2001-01-01 00:00:00' AS ts, "
                        "CASE WHEN id = 29 THEN 'Failed' WHEN id > 29 THEN 'Completed' ELSE 'Unknown' END AS StatusCD "
                        "FROM range(40) CROSS JOIN (SELECT explode(array(1L, 2L)) AS o)")
    ops = spark.createDataFrame([(1, "a", "x", 3), (2, "b", "x", 0), (3, "c", "x", 5)],
                                "ObjectID bigint, ObjectNM string, ObjectTypeCD string, RetryAttemptNBR int")
    got = {r.ObjectID: (r.TerminalAttemptNBR, r.OutcomeCD) for r in refresh_outcome(history, ops).collect()}
    assert got == {1: (30, "DID_NOT_COMPLETE"), 2: (30, "NOT_CHECKED"), 3: (None, "PENDING")}
