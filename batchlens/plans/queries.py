"""Driver queries: each runs one job over the fixture catalog of a data folder.

Every query reads the driver tables through the fixture views, whose SQL says
which rows model which catalog table, so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.session import apply_conf, stored
from batchlens.sources.fixtures import fixture_catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The mart whose consumers are listed.
SOURCE_MART = "NATION_3"

# Service registry row used by the sequence edges (the catalog's discovery
# service table is not part of the driver tables).
SERVICE_URL = "https://catalog-service.example.org"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def cat_of(spark: SparkSession, sf_dir: str):
    apply_conf(spark)
    return fixture_catalog(spark, sf_dir)


def services_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("IDEA-Web", SERVICE_URL)], "ServiceNM string, ServiceUrl string")


# Intermediates shared by several reports over the same catalog (the
# dependency base and batch resolution; the declared sequence graph) are
# computed once per session and catalog and cut from their lineage with
# reliable checkpoints in spark.checkpoint.dir -- what a run that produces
# all the reports from one catalog snapshot does.
_SHARED: dict[tuple, object] = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, build):
    cat = cat_of(spark, sf_dir)
    key = (id(spark), id(cat), name)
    hit = _SHARED.get(key)
    if hit is None or hit[0] is not cat:
        hit = (cat, build(cat))
        _SHARED[key] = hit
    return hit[1]


def _derived_ctx(spark, sf_dir):
    from batchlens.operators.derived import DerivedContext
    return _shared(spark, sf_dir, "derived", lambda c: DerivedContext(c).persist())


# --- progress --------------------------------------------------------------

@query("etl_progress")
def q_etl_progress(spark, sf_dir):
    from batchlens.operators.progress import etl_progress
    c = cat_of(spark, sf_dir)
    return etl_progress(c["ETLBatchHistoryBASE"], c["ETLTableHistoryBASE"])


@query("etl_progress_batches")
def q_etl_progress_batches(spark, sf_dir):
    """Progress of the given batches (PF-17): the two last ones, as after a daily run."""
    from batchlens.operators.progress import etl_progress
    c = cat_of(spark, sf_dir)
    ids = c["ETLBatchHistoryBASE"].select("BatchID").orderBy(F.desc("BatchID")).limit(2)
    return etl_progress(c["ETLBatchHistoryBASE"], c["ETLTableHistoryBASE"], ids)


@query("status_share")
def q_status_share(spark, sf_dir):
    from batchlens.operators.progress import status_share
    c = cat_of(spark, sf_dir)
    return status_share(c["ETLBatchHistoryBASE"], c["ETLTableHistoryBASE"])


# --- declared sequence -----------------------------------------------------

@query("run_stats")
def q_run_stats(spark, sf_dir):
    from batchlens.operators.sequence import run_stats
    c = cat_of(spark, sf_dir)
    return run_stats(c["ETLBatchHistoryBASE"]).select(
        "DataMartID", "BatchDefinitionID", "AvgDurationNBR",
        F.date_format("LastSuccessDTS", "yyyy-MM-dd HH:mm:ss").alias("LastSuccessDTS"), "SuccessFLG")


@query("schedule_flags")
def q_schedule_flags(spark, sf_dir):
    from batchlens.operators.sequence import schedule_flags
    return schedule_flags(cat_of(spark, sf_dir)).distinct()


@query("sequenced_nodes")
def q_sequenced_nodes(spark, sf_dir):
    from batchlens.operators.sequence import sequenced_nodes
    return sequenced_nodes(cat_of(spark, sf_dir))


@query("run_status")
def q_run_status(spark, sf_dir):
    from batchlens.operators.sequence import sequenced_nodes
    return (_seq(spark, sf_dir)[0]
            .groupBy("RunStatusCD").agg(F.count(F.lit(1)).alias("NodeCNT")))


@query("sequenced_edges")
def q_sequenced_edges(spark, sf_dir):
    from batchlens.operators.sequence import sequenced_edges
    return sequenced_edges(cat_of(spark, sf_dir), services_df(spark))


# --- derived graph ---------------------------------------------------------

def _resolve(spark, sf_dir, side):
    from batchlens.operators.resolve import resolve_batch
    c = cat_of(spark, sf_dir)
    return resolve_batch(c["TableBASE"], c["ETLBatchDefinitionBASE"], c["ETLBatchDefinitionTableBASE"],
                         c["BindingBASE"], side).select(
        "TableID", "ConnID", "PriorityNBR", "BatchDefinitionID", "BatchDefinitionNM")


@query("resolve_batch_from")
def q_resolve_from(spark, sf_dir):
    return _resolve(spark, sf_dir, "from")


@query("resolve_batch_to")
def q_resolve_to(spark, sf_dir):
    return _resolve(spark, sf_dir, "to")


@query("derived_nodes")
def q_derived_nodes(spark, sf_dir):
    from batchlens.operators.derived import derived_nodes
    return derived_nodes(cat_of(spark, sf_dir), ctx=_derived_ctx(spark, sf_dir))


@query("derived_edges")
def q_derived_edges(spark, sf_dir):
    from batchlens.operators.derived import derived_edges
    return derived_edges(cat_of(spark, sf_dir), ctx=_derived_ctx(spark, sf_dir))


@query("unused_batches")
def q_unused(spark, sf_dir):
    from batchlens.operators.derived import unused_batches
    return unused_batches(cat_of(spark, sf_dir), ctx=_derived_ctx(spark, sf_dir))


@query("missing_batch_audit")
def q_missing(spark, sf_dir):
    from batchlens.operators.derived import missing_batch_audit
    return missing_batch_audit(cat_of(spark, sf_dir), ctx=_derived_ctx(spark, sf_dir))


# --- graph views -----------------------------------------------------------

def _seq(spark, sf_dir, as_of=None):
    from batchlens.operators.sequence import sequenced_edges, sequenced_nodes
    from concurrent.futures import ThreadPoolExecutor

    def build(c):
        parts = (sequenced_nodes(c, as_of), sequenced_edges(c, services_df(spark)))
        with ThreadPoolExecutor(max_workers=2) as pool:
            return tuple(pool.map(lambda df: df.checkpoint(), parts))
    return _shared(spark, sf_dir, f"seq:{as_of}", build)


def _view(spark, sf_dir, which):
    from batchlens.operators import graph
    n, e = _seq(spark, sf_dir)
    return (graph.not_run_view if which == "nr" else graph.broken_view)(n, e)


@query("not_run_view_nodes")
def q_nr_nodes(spark, sf_dir):
    return _view(spark, sf_dir, "nr")[0].select("NodeKey", "RunStatusCD", "SegmentLabel")


@query("not_run_view_edges")
def q_nr_edges(spark, sf_dir):
    return _view(spark, sf_dir, "nr")[1].select("ID", "FromNodeKey", "ToNodeKey", "SegmentDisplay")


@query("broken_view_nodes")
def q_br_nodes(spark, sf_dir):
    return _view(spark, sf_dir, "br")[0].select("NodeKey", "RunStatusCD", "SegmentLabel")


@query("broken_view_edges")
def q_br_edges(spark, sf_dir):
    return _view(spark, sf_dir, "br")[1].select("ID", "FromNodeKey", "ToNodeKey", "SegmentDisplay")


@query("graph_view_counts")
def q_view_counts(spark, sf_dir):
    from batchlens.operators.graph import view_counts
    return view_counts(*_seq(spark, sf_dir))


@query("adjacency")
def q_adjacency(spark, sf_dir):
    from batchlens.operators.graph import adjacency
    return adjacency(_seq(spark, sf_dir)[1])


@query("snapshot_diff")
def q_snapshot_diff(spark, sf_dir):
    from batchlens.operators.graph import snapshot_diff
    old, _ = _seq(spark, sf_dir, "2001-07-30 12:00:00")
    new, _ = _seq(spark, sf_dir)
    return snapshot_diff(old, new)


@query("upstream_chain")
def q_upstream_chain(spark, sf_dir):
    from batchlens.operators.graph import upstream_chain
    return upstream_chain(_seq(spark, sf_dir)[1])


# --- DOT text ----------------------------------------------------------------

DOT_TITLE = "Batch Sequencing - fixture"


@query("dot_lines")
def q_dot_lines(spark, sf_dir):
    from batchlens.operators.dot import render_dot_lines
    n, e = _seq(spark, sf_dir)
    return render_dot_lines(n, e, DOT_TITLE)


@query("dot_roundtrip")
def q_dot_roundtrip(spark, sf_dir):
    from batchlens.operators.dot import parse_dot_nodes, render_dot_lines
    n, e = _seq(spark, sf_dir)
    lines = render_dot_lines(n, e, DOT_TITLE).select(F.col("LineTXT").alias("value"))
    return parse_dot_nodes(lines).select(
        "NodeKey", "DataMartNM", "BatchDefinitionNM", "AvgDurationNBR", "ScheduleCategoryCD",
        "SchedulePatternTypeCD", "RunStatusCD", "CompletedTXT", "NextRunTXT", "BrokenReferenceFLG").distinct()


def _archive(spark, sf_dir):
    """The graph of two days, written as an archive and read back."""
    from batchlens.operators.archive import snapshot_stamp
    from batchlens.operators.dot import read_dot_archive, render_dot_lines
    from batchlens.sources.sinks import write_graph_snapshot
    from batchlens.session import as_of_literal, new_path

    def build(_):
        root = new_path(spark, "graphs")
        for as_of in ("2001-07-30 12:00:00", "2001-07-31 12:00:00"):
            lines = render_dot_lines(*_seq(spark, sf_dir, None if as_of.startswith("2001-07-31") else as_of), DOT_TITLE)
            stamp = spark.range(1).select(snapshot_stamp(as_of_literal(as_of))).first()[0]
            write_graph_snapshot(lines, root, "EDW", stamp)
        return root
    return read_dot_archive(spark, _shared(spark, sf_dir, "graph-archive", build) + "/archive")


@query("dot_archive_nodes")
def q_archive_nodes(spark, sf_dir):
    return _archive(spark, sf_dir)[0].select(
        "EnvironmentNM", "SnapshotDTS", "NodeKey", "DataMartNM", "BatchDefinitionNM", "AvgDurationNBR", "ScheduleCategoryCD",
        "SchedulePatternTypeCD", "RunStatusCD", "CompletedTXT", "NextRunTXT", "BrokenReferenceFLG").distinct()


@query("dot_archive_edges")
def q_archive_edges(spark, sf_dir):
    return _archive(spark, sf_dir)[1].select(
        "EnvironmentNM", "SnapshotDTS", "FromNodeKey", "ToNodeKey", "EdgeStyleCD", "LinkURL").distinct()


# --- snapshot archive ------------------------------------------------------

@query("snapshot_index")
def q_snapshot_index(spark, sf_dir):
    from batchlens.operators.archive import snapshot_index
    return snapshot_index(cat_of(spark, sf_dir)["SnapshotFiles"])


@query("snapshot_index_json")
def q_snapshot_json(spark, sf_dir):
    """The index document of every graph and environment of which there are files, with or without snapshots."""
    from batchlens.operators.archive import snapshot_index, snapshot_index_json, with_stamp
    files = cat_of(spark, sf_dir)["SnapshotFiles"]
    series = with_stamp(files).filter(F.col("SeriesNM").isNotNull()).select("SeriesNM")
    series = series.unionByName(series.select(F.concat("SeriesNM", F.lit("-new")).alias("SeriesNM")))
    return snapshot_index_json(snapshot_index(files), series)


@query("snapshot_day_counts")
def q_snapshot_day_counts(spark, sf_dir):
    from batchlens.operators.archive import snapshot_index, snapshots_per_day
    return snapshots_per_day(snapshot_index(cat_of(spark, sf_dir)["SnapshotFiles"]))


@query("expired_files")
def q_expired(spark, sf_dir):
    from batchlens.operators.archive import expired_files
    return expired_files(cat_of(spark, sf_dir)["SnapshotFiles"], days=90)


@query("expired_files_env")
def q_expired_env(spark, sf_dir):
    from batchlens.operators.archive import expired_files
    return expired_files(cat_of(spark, sf_dir)["SnapshotFiles"], days=90, graph="BatchSequence", environment="ENV1")


@query("orphan_files")
def q_orphans(spark, sf_dir):
    from batchlens.operators.archive import orphan_files
    return orphan_files(cat_of(spark, sf_dir)["SnapshotFiles"])


# --- retention / validation -------------------------------------------------
# fixture: policy row for table t purges / validates SnapshotRows of table t % 10

def _target_of():
    return F.col("TableID") % 10


def _plan(spark, sf_dir):
    from batchlens.operators.retention import purge_plan
    c = cat_of(spark, sf_dir)
    return purge_plan(c["SAMSnapshotTableManagementBASE"], c)


@query("purge_plan")
def q_purge_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("purge_kept")
def q_purge_kept(spark, sf_dir):
    from batchlens.operators.retention import purge_kept
    c = cat_of(spark, sf_dir)
    rows = c["SnapshotRows"].withColumn("TargetID", F.col("TableID"))
    return purge_kept(rows, _plan(spark, sf_dir), "l_shipdate", _target_of()).drop("TargetID")


@query("purge_log")
def q_purge_log(spark, sf_dir):
    from batchlens.operators.retention import daily_counts, hook_invocations, purge_policies, purge_run_log
    c = cat_of(spark, sf_dir)
    return purge_run_log(purge_policies(c["SAMSnapshotTableManagementBASE"], c), hook_invocations(c),
                         daily_counts(c["SnapshotRows"], "l_shipdate", "TableID"), _target_of())


def _outcomes(spark, sf_dir):
    from batchlens.operators.retention import daily_counts, period_rows, validate_snapshot
    c = cat_of(spark, sf_dir)
    counts = daily_counts(period_rows(c["SnapshotRows"], "LastLoadDTS"), "LastLoadDTS", "TableID")
    return validate_snapshot(c["SAMSnapshotTableManagementBASE"], c, counts, _target_of())


def _validate(spark, sf_dir):
    from batchlens.operators.retention import hook_invocations, validate_runs
    return validate_runs(_outcomes(spark, sf_dir), hook_invocations(cat_of(spark, sf_dir))).drop(
        "DatabaseNM", "SchemaNM", "TableNM")


@query("validate_snapshot")
def q_validate(spark, sf_dir):
    return _validate(spark, sf_dir)


@query("validate_daily")
def q_validate_daily(spark, sf_dir):
    return _validate(spark, sf_dir).filter(F.col("SnapshotPeriodCD") == "Daily")


@query("validate_monthly")
def q_validate_monthly(spark, sf_dir):
    return _validate(spark, sf_dir).filter(F.col("SnapshotPeriodCD") == "Monthly")


@query("validate_log")
def q_validate_log(spark, sf_dir):
    from batchlens.operators.retention import hook_invocations, validation_log
    return validation_log(_outcomes(spark, sf_dir), hook_invocations(cat_of(spark, sf_dir)))


@query("configured_entities")
def q_configured(spark, sf_dir):
    from batchlens.operators.retention import configured_entities
    c = cat_of(spark, sf_dir)
    return configured_entities(c["SAMSnapshotTableManagementBASE"], c, c["ETLTableHistoryBASE"])


@query("hook_dispatch")
def q_hook_dispatch(spark, sf_dir):
    """The hooks of every recorded load: the control table as registered, the gate and the validation as exit codes."""
    from batchlens.operators.retention import configured_entities, dispatch_hooks, hook_exits, hook_rows, HOOK_SCHEMA, register_hooks
    from batchlens.session import new_path
    from batchlens.sources.sinks import read_latest
    c = cat_of(spark, sf_dir)
    args = "-entityID $entity -jobID $batchExecution"
    more = spark.createDataFrame([
        ("AuditLoad", "PostEntity", "Batch", "PowerShell", 0, "System", f"Audit.ps1 {args}", 0, 0, 5, 0, "Audit", 1, None, None),
        ("RetiredCheck", "PreEntity", "Batch", "PowerShell", 0, "System", f"Old.ps1 {args}", 0, 1, 1, 0, "Old", 0, None, None)],
        HOOK_SCHEMA)
    control = new_path(spark, "hooks")
    register_hooks(hook_rows(spark, f"Purge.ps1 {args}", f"Validate.ps1 {args}"), control, ("retention", 1))
    register_hooks(more, control, ("audit", 1))
    loads = c["ETLTableHistoryBASE"].select(F.col("BatchID").alias("JobID"), "EntityID")
    gate = configured_entities(c["SAMSnapshotTableManagementBASE"], c, c["ETLTableHistoryBASE"])
    return dispatch_hooks(read_latest(spark, control), loads, hook_exits(gate, _outcomes(spark, sf_dir)))


# --- lineage ----------------------------------------------------------------

@query("downstream_bindings")
def q_downstream(spark, sf_dir):
    from batchlens.operators.lineage import downstream_bindings
    return downstream_bindings(cat_of(spark, sf_dir))


def _parsed(spark, sf_dir):
    from batchlens.operators.lineage import parsed_bindings
    return _shared(spark, sf_dir, "references", lambda c: stored(parsed_bindings(c), "references"))


@query("downstream_of_mart")
def q_downstream_of_mart(spark, sf_dir):
    from batchlens.operators.lineage import downstream_bindings
    return downstream_bindings(cat_of(spark, sf_dir), SOURCE_MART)


@query("lineage_refs")
def q_lineage_refs(spark, sf_dir):
    from batchlens.operators.lineage import downstream_references
    return downstream_references(cat_of(spark, sf_dir), _parsed(spark, sf_dir))


@query("replace_by_key")
def q_replace_by_key(spark, sf_dir):
    from batchlens.operators.lineage import downstream_references, keyed_replace
    c = cat_of(spark, sf_dir)
    parsed = _parsed(spark, sf_dir)
    old = downstream_references(c, parsed)
    active = (c["BindingBASE"].filter(F.col("BindingStatusCD") == "Active")
              .select(F.col("BindingID").alias("DestinationBindingID")))
    return keyed_replace(old, parsed.join(active, "DestinationBindingID", "left_semi"))


# --- documents --------------------------------------------------------------

@query("flatten_attributes")
def q_flatten(spark, sf_dir):
    from batchlens.operators.documents import flatten_json_text
    return flatten_json_text(cat_of(spark, sf_dir)["events"], "event_id", "props")


def binding_documents(c):
    """Binding documents of the catalog in their nested shape."""
    def attribute(n, name, value):
        return F.struct(F.col("Id").alias("ObjectId"), (F.col("Id") * 10 + n).alias("Id"), F.lit(name).alias("AttributeName"),
                        value.cast("string").alias("AttributeValue"))

    sources = c["BindingDependencyBASE"].groupBy(F.col("BindingID").alias("Id")).agg(
        F.sort_array(F.collect_list("SourceEntityID")).alias("_s"))  # the tables of one binding
    d = c["BindingDocuments"].join(sources, "Id", "left")
    return d.select(
        "Id", "DestinationEntityId", "DataMartId", "Name", "Classification", "Description", "Status", "SourceConnectionId",
        F.lit("SQL").alias("BindingType"), F.lit("Full").alias("LoadTypeCode"), "DestinationEntity", "DataMart",
        F.array(attribute(1, "IsProtected", F.lit("False")), attribute(2, "Tags", F.lit(None)),
                attribute(3, "UserDefinedSQL", F.col("UserSQL"))).alias("AttributeValues"),
        F.transform("_s", lambda e: F.create_map(F.lit("EntityId"), e.cast("string"))).alias("SourcedByEntities"),
        F.when(F.col("Id") % 5 == 0, F.array(F.create_map(F.lit("ColumnName"), F.lit("LastLoadDTS"), F.lit("TypeCode"), F.lit("Date"))))
        .alias("IncrementalConfigurations"))


@query("binding_documents")
def q_binding_documents(spark, sf_dir):
    """Every binding written as a nested document, read with the declared schema and flattened into all its tables."""
    from batchlens.operators.documents import flatten_all, read_bindings, write_documents_json
    from batchlens.session import new_path

    def build(c):
        path = new_path(spark, "documents")
        write_documents_json(binding_documents(c), path)
        return path
    return flatten_all(read_bindings(spark, _shared(spark, sf_dir, "documents", build), one_per_line=True))


@query("environment_inventory")
def q_env(spark, sf_dir):
    from batchlens.operators.documents import environment_inventory
    c = cat_of(spark, sf_dir)
    envs = c["region"].select(F.col("r_regionkey").cast("bigint").alias("environment_id"),
                              F.concat(F.lit("env-"), "r_name").alias("environment_name"))
    variables = c["nation"].select(
        F.col("n_nationkey").cast("bigint").alias("variable_id"), F.col("n_regionkey").cast("bigint").alias("environment_id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("v"), F.col("n_nationkey").cast("string"))).alias("value"))
    return environment_inventory(variables, envs)


# --- refresh / calendar / history ---------------------------------------------

@query("refresh_outcome")
def q_refresh(spark, sf_dir):
    from batchlens.operators.refresh import refresh_outcome
    c = cat_of(spark, sf_dir)
    return refresh_outcome(c["RefreshHistory"], c["RefreshOperation"])


@query("run_calendar")
def q_run_calendar(spark, sf_dir):
    from batchlens.operators.refresh import run_calendar
    return run_calendar(cat_of(spark, sf_dir)["events"].select("event_id", "ts"))


@query("monthly_effective_history")
def q_monthly(spark, sf_dir):
    from batchlens.operators.history import month_calendar, monthly_effective_history
    c = cat_of(spark, sf_dir)
    cal = month_calendar(spark, "1995-01-01", "2001-07-31")
    return monthly_effective_history(c["EffectiveEvents"], cal, tie_break="o_orderkey")


# --- streaming (run to completion with availableNow; oracle = batch SQL) ------

def _stream(spark, sf_dir):
    from batchlens.streaming.jobs import history_stream
    apply_conf(spark)
    return history_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def _stream_path(spark, sf_dir, name):
    """The run's folder: the same for the same input files, so a run that is started again resumes."""
    from batchlens.sources.fixtures import signature
    from batchlens.streaming.jobs import stream_path
    return stream_path(spark, name, sf_dir, signature(spark, sf_dir, ("events", "lineitem", "orders")))


@query("stream_retention_plan")
def q_stream_retention(spark, sf_dir):
    from batchlens.operators.retention import purge_plan
    from batchlens.streaming.jobs import run_retention
    c = cat_of(spark, sf_dir)
    loads = (spark.readStream.schema(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema)
             .option("recursiveFileLookup", "true").parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
             .select(F.col("l_orderkey").alias("JobID"), F.col("l_partkey").alias("EntityID")))
    runs = c["ETLBatchHistoryBASE"].select(F.col("BatchID").alias("JobID"), "BatchDefinitionID")

    def plan(batch):
        return purge_plan(c["SAMSnapshotTableManagementBASE"], c, invocations=batch.join(runs, "JobID"))
    return run_retention(loads, plan, _stream_path(spark, sf_dir, "retention_plan")).distinct()


@query("stream_status_counts")
def q_stream_status_counts(spark, sf_dir):
    from batchlens.streaming.jobs import run_available_now, status_counts
    return run_available_now(status_counts(_stream(spark, sf_dir)), "update", ["WindowStartDTS", "StatusCD"],
                             "status_counts", _stream_path(spark, sf_dir, "status_counts"))


@query("stream_refresh_latest")
def q_stream_refresh_latest(spark, sf_dir):
    from batchlens.streaming.jobs import refresh_latest, run_available_now
    return run_available_now(refresh_latest(_stream(spark, sf_dir)), "update", ["ObjectID"], "refresh_latest",
                             _stream_path(spark, sf_dir, "refresh_latest"))


@query("stream_dedup_loads")
def q_stream_dedup(spark, sf_dir):
    from batchlens.streaming.jobs import dedup_loads, run_available_now
    return run_available_now(dedup_loads(_stream(spark, sf_dir)), "append", name="dedup_loads",
                             path=_stream_path(spark, sf_dir, "dedup_loads"))


@query("stream_hourly_active")
def q_stream_hourly(spark, sf_dir):
    from batchlens.streaming.jobs import hourly_active, run_available_now
    return run_available_now(hourly_active(_stream(spark, sf_dir)), "update", ["HourStartDTS"], "hourly_active",
                             _stream_path(spark, sf_dir, "hourly_active"))


@query("stream_refresh_outcome")
def q_stream_refresh_outcome(spark, sf_dir):
    from batchlens.streaming.monitor import run_monitor
    return run_monitor(_stream(spark, sf_dir), cat_of(spark, sf_dir)["RefreshOperation"],
                       path=_stream_path(spark, sf_dir, "refresh_monitor"))
