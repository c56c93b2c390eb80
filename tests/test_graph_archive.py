from batchlens.operators.archive import orphan_files, snapshot_index
from batchlens.operators.graph import adjacency, broken_view, not_run_view, snapshot_diff, upstream_chain

NODES = "NodeKey string, RunStatusCD string, BrokenMartFLG boolean, BrokenBatchFLG boolean, CompletedDTS string, " \
        "AvgDurationNBR bigint, NextScheduledStartDTS string"
EDGES = "FromNodeKey string, ToNodeKey string, EdgeStyleCD string"


def _graph(spark):
    nodes = spark.createDataFrame([
        ("M.a", "FINISHED", False, False, "x", 1, "n"), ("M.b", "NOT_SCHEDULED", False, False, "x", 1, "n"),
        ("M.c", "MISSED", False, False, "x", 1, "n"), ("Gone.d", "MISSED_UNSCHEDULED", True, True, "x", 1, "n"),
        ("M.e", "FINISHED", False, False, "x", 1, "n")], NODES)
    edges = spark.createDataFrame([("M.a", "M.b", "solid"), ("M.b", "m.C", "solid"), ("M.e", "Gone.d", "dashed"),
                                   ("M.a", "M.e", "solid")], EDGES)
    return nodes, edges


def test_not_run_view_adds_direct_parents_case_insensitively(spark):
    nodes, edges = _graph(spark)
    vn, ve = not_run_view(nodes, edges)
    assert {r.NodeKey for r in vn.collect()} == {"M.b", "M.c", "Gone.d", "M.e"}
    assert {(r.FromNodeKey, r.ToNodeKey) for r in ve.collect()} == {("M.b", "m.C"), ("M.e", "Gone.d")}
    bn, be = broken_view(nodes, edges)
    assert {r.NodeKey for r in bn.collect()} == {"Gone.d", "M.e"}


def test_adjacency_and_chain(spark):
    nodes, edges = _graph(spark)
    adj = {(r.ChildKey, r.ParentKey): r.ParentCNT for r in adjacency(edges).collect()}
    assert adj[("m.c", "M.b")] == 1 and adj[("m.e", "M.a")] == 1
    ch = {(r.SeedKey, r.NodeKey): r.DepthNBR for r in upstream_chain(edges).collect()}
    assert ch[("m.c", "m.a")] == 2 and ch[("gone.d", "m.a")] == 2 and ch[("m.b", "m.a")] == 1
    cyc = spark.createDataFrame([("x", "y", "s"), ("y", "x", "s")], EDGES)
    assert {(r.SeedKey, r.NodeKey, r.DepthNBR) for r in upstream_chain(cyc).collect()} == {
        ("x", "y", 1), ("y", "x", 1), ("x", "x", 2), ("y", "y", 2)}


def test_snapshot_diff(spark):
    nodes, _ = _graph(spark)
    new = nodes.filter("NodeKey <> 'M.e'").replace("MISSED", "FINISHED", "RunStatusCD")
    d = {r.NodeKey: r.ChangeCD for r in snapshot_diff(nodes, new).collect()}
    assert d == {"M.e": "REMOVED", "M.c": "CHANGED"}


def test_snapshot_index_and_orphans(spark):
    files = spark.createDataFrame([("G_SRV_20260223_0005.svg",), ("G_SRV_20260223_1555.svg",),
                                   ("G_SRV_20260223_1555.html",), ("G_SRV_20260222_1200.html",)], "FileNM string")
    idx = snapshot_index(files).collect()
    assert [(r.filename, r.timeFormatted, r.timestamp) for r in idx] == [
        ("G_SRV_20260223_1555.svg", "3:55 PM", "2026-02-23T15:55:00"),
        ("G_SRV_20260223_0005.svg", "12:05 AM", "2026-02-23T00:05:00")]
    assert idx[0].htmlFile == "G_SRV_20260223_1555.html"
    assert [r.FileNM for r in orphan_files(files).collect()] == ["G_SRV_20260222_1200.html"]


def test_list_files_and_snapshot_sink(spark, tmp_path):
    from batchlens.operators.archive import expired_files
    from batchlens.sources.files import list_files
    from batchlens.sources.sinks import write_graph_snapshot
    for n in ("G_SRV_20010101_1000.svg", "G_SRV_20010101_1000.html", "other.txt"):
        (tmp_path / n).write_text("x")
    files = list_files(spark, str(tmp_path), "G_*")
    assert sorted(r.FileNM for r in files.collect()) == ["G_SRV_20010101_1000.html", "G_SRV_20010101_1000.svg"]
    assert expired_files(files, "2001-07-31 12:00:00", days=90).count() == 2
    lines = spark.createDataFrame([(1, "digraph {"), (5, "}")], "SectionNBR int, LineTXT string")
    write_graph_snapshot(lines, str(tmp_path / "out"), "DEV", "20010101_1000")
    back = spark.read.text(str(tmp_path / "out" / "archive")).collect()
    assert {r.value for r in back} == {"digraph {", "}"}


def test_edge_diff(spark):
    from batchlens.operators.graph import edge_diff
    old = spark.createDataFrame([("a", "b", "solid"), ("b", "c", "solid")], EDGES)
    new = spark.createDataFrame([("a", "b", "dashed"), ("c", "d", "solid")], EDGES)
    got = {(r.FromNodeKey, r.ToNodeKey): r.ChangeCD for r in edge_diff(old, new).collect()}
    assert got == {("a", "b"): "CHANGED", ("b", "c"): "REMOVED", ("c", "d"): "ADDED"}


def test_downstream_chain(spark):
    nodes, edges = _graph(spark)
    down = {(r.SeedKey, r.NodeKey): r.DepthNBR for r in upstream_chain(edges, direction="down").collect()}
    assert down[("m.a", "m.c")] == 2 and down[("m.a", "gone.d")] == 2 and ("m.c", "m.a") not in down
    seeded = upstream_chain(edges, seeds=spark.createDataFrame([("M.C",)], "NodeKey string"))
    assert {(r.NodeKey, r.DepthNBR) for r in seeded.collect()} == {("m.b", 1), ("m.a", 2)}
