"""Versioned tables: no lost updates, whole versions, one commit an epoch, purges that touch what they must."""
import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from batchlens.operators.lineage import REF_COLUMNS, REF_SCHEMA, keyed_replace, latest_references, load_references
from batchlens.operators.retention import purge_apply, purge_table
from batchlens.sources import tables
from batchlens.sources.sinks import append_event_log, read_event_log, read_latest, write_new_version


def _refs(spark, *ids):
    return spark.createDataFrame([(i, None, None, None, f"c{i}", None) for i in ids], REF_SCHEMA)


def test_interleaved_writers_lose_nothing(spark, tmp_path):
    """A reads, B commits, A writes: A raises instead of hiding B's rows."""
    d = str(tmp_path / "t")
    write_new_version(_refs(spark, 1), d)
    base = tables.version(spark, d)
    mine = keyed_replace(tables.read(spark, base), _refs(spark, 3))
    write_new_version(_refs(spark, 1, 2), d)
    with pytest.raises(tables.Conflict):
        write_new_version(mine, d, base)
    assert sorted(r[0] for r in read_latest(spark, d).collect()) == [1, 2]
    assert tables.versions(spark, d) == ["0000000001", "0000000002"]


def test_concurrent_loads_merge(spark, tmp_path):
    """Loads that run at the same time end with the rows of all of them."""
    d = str(tmp_path / "refs")
    errors = []

    def load(i):
        try:
            load_references(spark, _refs(spark, i, 100), d, retries=10)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=load, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = latest_references(spark, d)
    assert sorted(r[0] for r in got.collect()) == [0, 1, 2, 3, 100] and got.columns == REF_COLUMNS
    assert not [n for n in os.listdir(f"{d}/{tables.COMMITS}") if n.endswith(".tmp")]


def test_create_if_missing(spark, tmp_path):
    d = str(tmp_path / "c")
    made = tables.create(spark, d, "k bigint, v string")
    assert made.number == 1 and tables.read(spark, made).schema.simpleString() == "struct<k:bigint,v:string>"
    tables.append(spark.createDataFrame([(1, "a")], "k bigint, v string"), d)
    assert tables.create(spark, d, "other int").number == 2 and read_latest(spark, d).count() == 1
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([(1,)], "x int"), d)
    with pytest.raises(ValueError):
        tables.read(spark, tables.version(spark, str(tmp_path / "none")))


def test_event_log_appends_once(spark, tmp_path):
    """A run that is tried again adds nothing; other runs and appends that overlap all stay."""
    d = str(tmp_path / "log")
    rows = lambda n: spark.range(n).select(F.col("id").alias("JobID"))
    append_event_log(rows(3), d, ("purge", 1))
    append_event_log(rows(3), d, ("purge", 1))
    append_event_log(rows(4), d, ("purge", 2))
    append_event_log(rows(3), d, ("purge", 1))
    append_event_log(rows(5), d, ("validate", 1))
    assert read_event_log(spark, d).count() == 12
    old = tables.version(spark, d, 1)
    assert tables.read(spark, old).count() == 3


def _dated(spark, rows):
    return spark.createDataFrame(rows, "k bigint, d timestamp_ntz")


def test_purge_touches_only_the_cutoff_month(spark, tmp_path):
    d = str(tmp_path / "snap")
    rows = [(i, dt.datetime(2001, 1 + i % 6, 1 + i % 28, i % 24)) for i in range(300)] + [(1000 + i, None) for i in range(5)]
    tables.append(_dated(spark, rows), d, date_col="d")
    before = {p.folder: p for p in tables.version(spark, d).parts}
    assert len(before) == 7 and sum(p.rows for p in before.values()) == 305

    def stamps():
        return {os.path.join(a, f): os.stat(os.path.join(a, f)).st_mtime_ns
                for a, _, names in os.walk(d) for f in names if f.endswith(".parquet")}

    files = stamps()
    record, n = purge_table(spark, d, "d", "2001-03-15")
    kept, _ = purge_apply(_dated(spark, rows), "d", "2001-03-15")
    assert n == 305 - kept.count() and record.endswith("0000000002")
    assert sorted(map(tuple, read_latest(spark, d).collect()), key=str) == sorted(map(tuple, kept.collect()), key=str)
    after = tables.version(spark, d)
    # April to June and the rows without a date keep their folders and files, March alone was written
    assert len(set(before) & {p.folder for p in after.parts}) == 4 and len(after.parts) == 5
    assert all(stamps()[f] == t for f, t in files.items())
    assert len(set(stamps()) - set(files)) == 1
    # nothing to remove: no new version
    assert purge_table(spark, d, "d", "2001-03-15") == (after.record, 0)
    # a purge on a version that was overtaken raises
    tables.append(_dated(spark, [(7, dt.datetime(2001, 1, 1))]), d)
    with pytest.raises(tables.Conflict):
        tables.purge(spark, after, "d", "2001-05-01")


def test_range_reaches_folders_and_scan(spark, tmp_path):
    d = str(tmp_path / "snap")
    tables.append(_dated(spark, [(i, dt.datetime(2001, 1 + i % 6, 10)) for i in range(60)]), d, date_col="d")
    df = tables.read(spark, tables.version(spark, d), "2001-03-01", "2001-04-01")
    assert df.count() == 10 and len(df.inputFiles()) == 1
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2001-03-01" in plan
