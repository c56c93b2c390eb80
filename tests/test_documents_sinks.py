import json

import pytest
from pyspark.sql import functions as F

from batchlens.operators.documents import (environment_inventory, flatten_bindings, flatten_json_text,
                                           pivot_attributes, read_bindings, write_csv)

DOC = {
    "Id": 42, "DestinationEntityId": 7, "DataMartId": 3, "Name": "Invented binding", "Classification": "Generic",
    "Description": None, "Status": "Active", "SourceConnectionId": 2, "GroupingColumn": None,
    "GroupingFormat": None, "ContentId": "00000000-0000-0000-0000-000000000001", "BindingType": "SQL",
    "GrainName": None, "LoadTypeCode": "Full",
    "AttributeValues": [
        {"ObjectId": 42, "Id": 1, "AttributeName": "IsProtected", "AttributeValue": "False"},
        {"ObjectId": 42, "Id": 2, "AttributeName": "Tags", "AttributeValue": None},
        {"ObjectId": 42, "Id": 3, "AttributeName": "UserDefinedSQL", "AttributeValue": "SELECT a.b FROM s.t a"},
    ],
    "SourcedByEntities": [{"EntityId": "9", "Name": "src"}],
}


def test_read_and_flatten_bindings(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps(DOC, indent=2))
    docs = read_bindings(spark, str(tmp_path / "b.json"))
    out = flatten_bindings(docs)
    core = out["core"].first()
    assert (core.Id, core.Name, core.GrainName, core.LoadTypeCode) == (42, "Invented binding", None, "Full")
    attrs = {r.AttributeName: r.AttributeValue for r in out["attributes"].collect()}
    assert attrs == {"IsProtected": "False", "Tags": None, "UserDefinedSQL": "SELECT a.b FROM s.t a"}
    assert sorted((r.Key, r.Value) for r in out["sourced_by"].collect()) == [("EntityId", "9"), ("Name", "src")]
    assert out["incremental"].count() == 0          # absent arrays read as NULL -> no rows
    piv = pivot_attributes(out["attributes"]).first()
    assert piv["UserDefinedSQL"].startswith("SELECT")


def test_flatten_json_text(spark):
    df = spark.createDataFrame([(1, '{"k": 69}'), (2, "not json"), (3, None)], "id bigint, props string")
    assert [(r.id, r.AttributeName, r.AttributeValue) for r in flatten_json_text(df, "id", "props").collect()] == [
        (1, "k", "69")]


def test_environment_inventory_csv(spark, tmp_path):
    envs = spark.createDataFrame([(1, "DEV")], "environment_id bigint, environment_name string")
    var = spark.createDataFrame([(10, 1, "Conn", "x"), (11, 1, "Secret", None)],
                                "variable_id bigint, environment_id bigint, name string, value string")
    inv = environment_inventory(var, envs)
    write_csv(inv, str(tmp_path / "inv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "inv"))
    assert sorted((r.name, r.PlainValue) for r in back.collect()) == [("Conn", "x"), ("Secret", None)]


def test_snapshot_json_is_array_newest_first(spark):
    from batchlens.operators.archive import snapshot_index, snapshot_index_json
    files = spark.createDataFrame([("G_S_20260101_0900.svg",), ("G_S_20260102_0800.svg",)], "FileNM string")
    js = json.loads(snapshot_index_json(snapshot_index(files)).first().SnapshotsJSON)
    assert [e["filename"] for e in js] == ["G_S_20260102_0800.svg", "G_S_20260101_0900.svg"]
    assert set(js[0]) == {"filename", "htmlFile", "date", "time", "timeFormatted", "timestamp"}


def test_validation_strict_raises(spark):
    from batchlens.operators.retention import validate_snapshot
    cat = {
        "TableBASE": spark.createDataFrame([(1, 100, 5, "Edw", "S", "T1")],
                                           "TableID bigint, ContentID bigint, DataMartID bigint, DatabaseNM string, SchemaNM string, TableNM string"),
        "EntityBASE": spark.createDataFrame([(1, 100)], "EntityID bigint, ContentID bigint"),
        "DataMartBASE": spark.createDataFrame([(5,)], "DataMartID bigint"),
    }
    config = spark.createDataFrame([(2, 1, 1, "Daily")], "ID bigint, TableID bigint, ValidateSnapshotFLG int, SnapshotPeriodCD string")
    counts = spark.createDataFrame([(1, "2001-07-31", 3)], "TargetID bigint, DayDT string, RowCNT bigint") \
        .withColumn("DayDT", F.to_date("DayDT"))
    rel = validate_snapshot(config, cat, counts, F.col("TableID"), "2001-07-31 12:00:00")
    r = rel.first()
    assert (r.RowCNT, r.ValidationStatusCD) == (3, "FAILED")
    with pytest.raises(Exception):
        validate_snapshot(config, cat, counts, F.col("TableID"), "2001-07-31 12:00:00", strict=True).collect()


def test_hook_rows(spark):
    from batchlens.operators.retention import hook_rows
    rows = {r.EventNM: r for r in hook_rows(spark, "purge.ps1", "validate.ps1").collect()}
    assert rows["PostEntity"].OrderNBR == 6 and rows["PreEntity"].FailsExecutionFLG == 1


def test_load_references_versions(spark, tmp_path):
    from batchlens.operators.lineage import REF_COLUMNS, latest_references, load_references
    schema = ", ".join(f"{c} {'bigint' if i == 0 else 'string'}" for i, c in enumerate(REF_COLUMNS))
    v1 = spark.createDataFrame([(1, None, None, None, "a", None), (2, None, None, None, "b", None)], schema)
    v2 = spark.createDataFrame([(2, None, None, None, "c", None)], schema)
    d = str(tmp_path / "refs")
    load_references(spark, v1, d)
    load_references(spark, v2, d)
    assert sorted((r.DestinationBindingID, r.ParsedColumnNM) for r in latest_references(spark, d).collect()) == [
        (1, "a"), (2, "c")]


def test_fill_template_and_document_json(spark, tmp_path):
    from batchlens.functions.tsql import fill_template
    from batchlens.operators.documents import write_documents_json
    df = spark.createDataFrame([("<h1>NAME_PLACEHOLDER</h1>[SNAPSHOTS_PLACEHOLDER]", "Dev graph")], "tpl string, nm string")
    out = df.select(fill_template(F.col("tpl"), {"NAME_PLACEHOLDER": F.col("nm"), "SNAPSHOTS_PLACEHOLDER": "[]"}).alias("t"))
    assert out.first().t == "<h1>Dev graph</h1>[[]]"
    (tmp_path / "b.json").write_text(json.dumps(DOC))
    docs = read_bindings(spark, str(tmp_path / "b.json"))
    write_documents_json(docs.select("Id", "Name", "AttributeValues"), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).first()
    assert back.Id == 42 and len(back.AttributeValues) == 3


def test_document_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """documents are written compressed, in files of bounded size as one task reads each, and read back whole."""
    from batchlens.operators import documents
    monkeypatch.setattr(documents, "FILE_DOCUMENTS", 300)
    docs = spark.range(1000).coalesce(1).select(
        F.col("id").alias("Id"), F.concat(F.lit("Binding \u00e9 "), "id").alias("Name"),
        F.array(F.struct(F.lit("UserDefinedSQL").alias("AttributeName"),
                         F.lit("SELECT a\nFROM b").alias("AttributeValue"))).alias("AttributeValues"))
    documents.write_documents_json(docs, str(tmp_path / "docs"))
    files = [f for f in (tmp_path / "docs").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4 and all(f.read_bytes()[:2] == b"\x1f\x8b" for f in files)
    rows = documents.read_bindings(spark, str(tmp_path / "docs"), one_per_line=True).select(
        "Id", "Name", F.col("AttributeValues")[0]["AttributeValue"].alias("v")).collect()
    assert sorted((r.Id, r.Name, r.v) for r in rows) == [(i, f"Binding \u00e9 {i}", "SELECT a\nFROM b") for i in range(1000)]


def test_unfinished_and_overtaken_versions(spark, tmp_path):
    """A folder that was not committed is not read; a writer that was overtaken raises and leaves no version."""
    import pytest
    from batchlens.sources.sinks import read_latest, table_versions, write_new_version
    root = str(tmp_path / "t")
    write_new_version(spark.range(100), root)
    spark.range(26).write.parquet(f"{root}/version=00000002-unfinished")
    (tmp_path / "t" / "version=00000002-unfinished" / "_SUCCESS").unlink()
    assert read_latest(spark, root).count() == 100

    class Slow:
        """A table to write; another writer commits first."""
        sparkSession = spark

        @property
        def write(self):
            write_new_version(spark.range(7), root)
            return spark.range(5).write

    with pytest.raises(RuntimeError):
        write_new_version(Slow(), root)
    assert read_latest(spark, root).count() == 7 and len(table_versions(spark, root)) == 2
