"""Chains, view counts, nested documents, hooks, archive and audit against plain versions."""
import json
import random

from pyspark.sql import functions as F

from batchlens.operators import graph

EDGES = "FromNodeKey string, ToNodeKey string, EdgeStyleCD string"


def _depths(pairs, seeds=None):
    up = {}
    for p, c in pairs:
        up.setdefault(c.lower(), set()).add(p.lower())
    nodes = {x.lower() for e in pairs for x in e}
    out = set()
    for s in nodes if seeds is None else {x.lower() for x in seeds}:
        seen, frontier, d = {}, {s}, 0
        while frontier:
            d += 1
            frontier = {p for n in frontier for p in up.get(n, ())} - set(seen)
            seen |= dict.fromkeys(frontier, d)
        out |= {(s, n, d) for n, d in seen.items()}
    return out


def test_chains_on_random_cyclic_graphs(spark):
    rng = random.Random(9)
    for n, m in ((12, 30), (30, 34)):
        pairs = [(f"N{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)]
        edges = spark.createDataFrame([(a, b, "solid") for a, b in pairs], EDGES)
        got = {tuple(r) for r in graph.upstream_chain(edges).collect()}
        assert got == _depths(pairs)
        seeds = spark.createDataFrame([("N1",), ("n2",), ("absent",)], "NodeKey string")
        got = {tuple(r) for r in graph.upstream_chain(edges, seeds).collect()}
        assert got == _depths(pairs, ["n1", "n2"])
        got = {tuple(r) for r in graph.upstream_chain(edges, seeds, max_depth=2).collect()}
        assert got == {r for r in _depths(pairs, ["n1", "n2"]) if r[2] <= 2}
        down = {tuple(r) for r in graph.upstream_chain(edges, direction="down").collect()}
        assert down == _depths([(b, a) for a, b in pairs])


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    """500 levels and a cycle: as many rounds as the depth doubles, and the session's settings stay."""
    pairs = [(f"l{i}", f"l{i + 1}") for i in range(500)] + [("l3", "l0")]
    edges = spark.createDataFrame([(a, b, "s") for a, b in pairs], EDGES)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit")}
    chain = graph.upstream_chain(edges)
    deepest = chain.agg(F.max("DepthNBR")).first()[0]
    assert chain.count() == len(_depths(pairs)) and deepest == 500
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_view_counts_equal_the_views(spark):
    rng = random.Random(2)
    nodes = [(f"M.{rng.choice('aAbBcdefgh')}{rng.randrange(3)}", rng.choice(["FINISHED", "MISSED", "MISSED_UNSCHEDULED"]),
              rng.random() < 0.2, rng.random() < 0.2) for _ in range(30)]
    n = spark.createDataFrame(nodes, "NodeKey string, RunStatusCD string, BrokenMartFLG boolean, BrokenBatchFLG boolean")
    keys = [x[0] for x in nodes] + ["gone.x"]
    e = spark.createDataFrame([(rng.choice(keys), rng.choice(keys).upper(), "s") for _ in range(40)], EDGES)
    got = {r.ViewNM: (r.SeedCNT, r.NodeCNT, r.NodeRowCNT, r.EdgeCNT) for r in graph.view_counts(n, e).collect()}
    for name, seeds, view in (("NotRun", graph.not_run_seeds(n), graph.not_run_view(n, e)),
                              ("BrokenRefs", graph.broken_seeds(n), graph.broken_view(n, e))):
        vn, ve = view
        assert got[name] == (seeds.select(F.lower("NodeKey")).distinct().count(), vn.select(F.lower("NodeKey")).distinct().count(),
                             vn.count(), ve.count())


def test_all_document_tables_in_one_pass(spark, tmp_path):
    from batchlens.operators.documents import CORE_FIELDS, flatten_all, flatten_bindings, read_bindings
    docs = [{"Id": 1, "Name": "a", "DataMart": {"Id": 3, "Name": "m"}, "SourceConnection": "c",
             "AttributeValues": [{"ObjectId": 1, "Id": 5, "AttributeName": "x", "AttributeValue": "y"}, {"Id": 6}],
             "SourcedByEntities": [{"EntityId": "9", "N": "s"}], "ObjectRelationships": [{"K": "v"}, {}]},
            {"Id": 2, "IncrementalConfigurations": []}]
    path = tmp_path / "d.json"
    path.write_text("\n".join([*map(json.dumps, docs), "no json {"]))
    df = read_bindings(spark, str(path), one_per_line=True)
    got = {(r.BindingId, r.TableNM, r.Pos, r.FieldNM): r.ValueTXT for r in flatten_all(df).collect()}
    assert len(CORE_FIELDS) == 17 and sum(k[1] == "core" for k in got) == 34
    assert got[1, "core", 0, "Name"] == "a" and got[2, "core", 0, "Name"] is None
    assert json.loads(got[1, "core", 0, "DataMart"]) == {"Id": 3, "Name": "m"} and got[1, "core", 0, "SourceConnection"] == "c"
    assert got[1, "attributes", 0, "AttributeValue"] == "y" and got[1, "attributes", 1, "Id"] == "6"
    assert got[1, "sourced_by", 0, "EntityId"] == "9" and got[1, "relationships", 0, "K"] == "v"
    assert got[None, "corrupt", 0, "_corrupt_record"] == "no json {"
    assert not [k for k in got if k[1] == "incremental"]
    assert flatten_bindings(df)["core"].columns == CORE_FIELDS


def test_hooks_stop_at_a_failing_one(spark, tmp_path):
    from batchlens.operators.retention import HOOK_SCHEMA, dispatch_hooks, hook_rows, register_hooks
    from batchlens.sources.sinks import read_latest
    d = str(tmp_path / "hooks")
    hooks = hook_rows(spark, "p -e $entity -j $batchExecution", "v", "2001-07-31 12:00:00", "ops")
    assert len(hooks.columns) == 15 and hooks.first().LastModifiedByNM == "ops"
    register_hooks(hooks, d, ("setup", 1))
    register_hooks(hooks, d, ("setup", 1))
    extra = [("First", "PreEntity", "Batch", "PowerShell", 0, "System", "f", 0, 0, 1, 0, "", 1, None, None),
             ("Own", "PostEntity", "Batch", "PowerShell", 7, "Entity", "o", 0, 1, 9, 0, "", 1, None, None),
             ("Off", "PostEntity", "Batch", "PowerShell", 0, "System", "x", 0, 1, 1, 0, "", 0, None, None)]
    register_hooks(spark.createDataFrame(extra, HOOK_SCHEMA), d)
    control = read_latest(spark, d)
    assert control.count() == 5
    loads = spark.createDataFrame([(1, 7), (2, 8), (3, 7), (3, 7)], "JobID bigint, EntityID bigint")
    exits = spark.createDataFrame([(2, 8, "ValidateSnapshotData", 1), (1, 7, "First", 1)],
                                  "JobID bigint, EntityID bigint, EventHandlerNM string, ExitCD int")
    got = {}
    for r in sorted(dispatch_hooks(control, loads, exits).collect(), key=lambda r: (r.JobID, r.StepNBR)):
        got.setdefault((r.JobID, r.EntityID), []).append((r.EventHandlerNM, r.StatusCD))
    assert got == {
        (1, 7): [("First", "FAILED"), ("ValidateSnapshotData", "RAN"), ("PurgeHistoricalSnapshotData", "RAN"), ("Own", "RAN")],
        (2, 8): [("First", "RAN"), ("ValidateSnapshotData", "FAILED"), ("PurgeHistoricalSnapshotData", "BLOCKED")],
        (3, 7): [("First", "RAN"), ("ValidateSnapshotData", "RAN"), ("PurgeHistoricalSnapshotData", "RAN"), ("Own", "RAN")]}
    text = dispatch_hooks(control, loads, exits).filter("JobID = 2 AND OrderNBR = 6 AND EventNM = 'PostEntity'").first().CommandTXT
    assert text == "p -e 8 -j 2"


def test_hooks_of_entities_equal_those_of_loads(spark):
    """exits by entity give each load what exits by load do, and no hook row of a load is shuffled."""
    from batchlens.operators.retention import HOOK_SCHEMA, dispatch_hooks, hook_exits, hook_rows
    own = [("Own", "PostEntity", "Batch", "PowerShell", 7, "Entity", "o $entity $batchExecution", 0, 1, 9, 0, "", 1, None, None)]
    control = hook_rows(spark, "p $entity $batchExecution", "v").unionByName(spark.createDataFrame(own, HOOK_SCHEMA))
    loads = spark.createDataFrame([(j, e) for j in range(40) for e in (7, 7, 8, 9, None)], "JobID bigint, EntityID bigint")
    gate = spark.createDataFrame([(7, "Y"), (8, "N"), (9, "Y"), (None, "N")], "EntityID bigint, ConfiguredFLG string")
    outcomes = spark.createDataFrame([(9, 1, "PASSED"), (9, 2, "FAILED"), (7, 3, "PASSED")],
                                     "EntityID bigint, ID bigint, ValidationStatusCD string")
    exits = hook_exits(gate, outcomes)
    assert "JobID" not in exits.columns
    by_load = loads.select("JobID", "EntityID").distinct().join(exits, "EntityID")
    got, want = dispatch_hooks(control, loads, exits), dispatch_hooks(control, loads, by_load)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 40 * (3 + 2 + 2 + 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(EntityID" in plan and "windowspecdefinition(JobID" not in plan


def test_archive_folders_and_empty_index(spark, tmp_path):
    from batchlens.operators.archive import expired_files, snapshot_index, snapshot_index_json, snapshot_stamp
    from batchlens.operators.dot import read_dot_archive
    from batchlens.sources.sinks import write_graph_snapshot
    lines = spark.createDataFrame([(2, '\t"M.a" [label=<<b>M</b>>];'), (4, '\t"M.a" -> "M.b" [style="dashed"]')], "SectionNBR int, LineTXT string")
    for stamp in ("20010730_0100", "20010731_0200"):
        write_graph_snapshot(lines, str(tmp_path / "g"), "EDW", stamp)
    nodes, edges = read_dot_archive(spark, str(tmp_path / "g" / "archive"))
    want = [("EDW", "2001-07-30 01:00:00"), ("EDW", "2001-07-31 02:00:00")]
    assert sorted((r.EnvironmentNM, str(r.SnapshotDTS)) for r in nodes.collect()) == want
    assert sorted((r.EnvironmentNM, str(r.SnapshotDTS)) for r in edges.collect()) == want
    assert spark.range(1).select(snapshot_stamp()).first()[0] == "20010731_1200"
    files = spark.createDataFrame([("G_A_20010101_0900.svg",), ("G_A_20010102_0900.gv",), ("G_B_20010101_0900.gv",),
                                   ("H_A_20010101_0900.gv",)], "FileNM string")
    wanted = spark.createDataFrame([("G_A",), ("G_B",)], "SeriesNM string")
    docs = {r.SeriesNM: json.loads(r.SnapshotsJSON) for r in snapshot_index_json(snapshot_index(files), wanted).collect()}
    assert docs["G_B"] == [] and len(docs["G_A"]) == 1
    none = snapshot_index_json(snapshot_index(files.limit(0)), wanted).collect()
    assert {r.SnapshotsJSON for r in none} == {"[]"}
    old = expired_files(files, days=90, graph="G", environment="A").collect()
    assert sorted(r.FileNM for r in old) == ["G_A_20010101_0900.svg", "G_A_20010102_0900.gv"]


def test_declared_columns_and_sample(spark, tmp_path):
    from batchlens.operators.lineage import first_record
    from batchlens.sources.fixtures import CATALOG_SCHEMAS, read_catalog
    spark.createDataFrame([(1, 5)], "TableID bigint, DataMartID bigint").write.parquet(str(tmp_path / "TableBASE"))
    t = read_catalog(spark, str(tmp_path), ["TableBASE"])["TableBASE"]
    assert t.columns == ["TableID", "DataMartID", "DatabaseNM", "SchemaNM", "TableNM", "LoadTypeCD", "ContentID"]
    assert t.first().TableNM is None and len(CATALOG_SCHEMAS) == 17
    assert first_record(spark.range(5)).count() == 1


def test_references_are_parsed_once_and_repeated(spark):
    from batchlens.operators.lineage import downstream_bindings, downstream_references, extract_references
    cat = {
        "SummaryBindingDependency": spark.createDataFrame(
            [("A", "e", "B", 1, "d"), ("A", "f", "B", 1, "d"), ("C", "g", "C", 1, "d"), ("C", "g", "B", 2, "d")],
            "SourceDataMartNM string, SourceEntityNM string, DestinationDataMartNM string, DestinationBindingID bigint, DestinationEntityNM string"),
        "ObjectAttributeBASE": spark.createDataFrame(
            [(1, "UserDefinedSQL", "SELECT t.a, b AS c FROM d.s.t"), (2, "UserDefinedSQL", None), (3, "UserDefinedSQL", "SELECT z FROM q"),
             (1, "Other", "SELECT n FROM m")], "ObjectID bigint, AttributeNM string, AttributeValueLongTXT string")}
    want = sorted(map(str, extract_references(downstream_bindings(cat)).collect()))
    assert len(want) == 4 and sorted(map(str, downstream_references(cat).collect())) == want
    one = downstream_references(cat, source_mart="C").count()
    assert one == extract_references(downstream_bindings(cat, "C")).count() == 0


def test_service_address_ends_with_one_slash(spark):
    from batchlens.operators.sequence import service_base_url
    for url, want in (("https://s.example.org", "https://s.example.org/"), ("https://s.example.org/", "https://s.example.org/")):
        services = spark.createDataFrame([("IDEA-Web", url), ("Other", "x")], "ServiceNM string, ServiceUrl string")
        assert service_base_url(services).first().BaseUrl == want
    assert service_base_url(services.filter("ServiceNM = 'Other'")).first().BaseUrl is None
