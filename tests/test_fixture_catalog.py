"""The catalog computes a table when a job asks for it, and copies none that only renames columns."""
import os

from batchlens.sources.fixtures import FIXTURE_VIEWS, FixtureCatalog, computed

SF = "/root/testdata/sf0.001"


def test_a_job_pays_for_its_own_tables(spark, tmp_path):
    for name in os.listdir(SF):  # a folder of its own, so that no other test has stored its tables
        os.symlink(f"{SF}/{name}", tmp_path / name)
    cat = FixtureCatalog(spark, str(tmp_path))
    assert cat["ETLTableHistoryBASE"].count() == cat["lineitem"].count()
    assert cat["ETLBatchHistoryBASE"].count() > 0
    assert os.listdir(cat.root) == ["ETLBatchHistoryBASE"]


def test_stored_and_lazy_tables_have_the_same_columns(spark):
    stored, lazy = FixtureCatalog(spark, SF), FixtureCatalog(spark, SF, materialize=False)
    for name, sql in FIXTURE_VIEWS:
        assert [(f.name, f.dataType) for f in stored[name].schema] == [(f.name, f.dataType) for f in lazy[name].schema], name
        if computed(sql):
            assert stored[name].count() == lazy[name].count(), name
