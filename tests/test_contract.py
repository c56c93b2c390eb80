"""Driver contract and DuckDB-oracle parity on the smallest driver tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data not present")

FAST = ["etl_progress", "sequenced_nodes", "sequenced_edges", "resolve_batch_from", "derived_edges",
        "unused_batches", "missing_batch_audit", "not_run_view_nodes", "purge_plan", "purge_kept", "purge_log",
        "validate_snapshot", "dot_lines", "lineage_refs", "refresh_outcome", "monthly_effective_history",
        "snapshot_index", "stream_status_counts"]


def test_every_query_has_an_oracle():
    from batchlens.plans.queries import QUERIES
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["SegmentDisplay", "LastRunHourTXT"]


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else str(v)) for v in r))
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP"}
    spark_types = {f.name: types.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    order = [rel.columns.index(c) for c in df.columns]
    orows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert _norm(df.collect()) == _norm(orows)
