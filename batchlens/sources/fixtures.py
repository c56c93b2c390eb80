"""Fixture catalog: the ETL catalog tables as deterministic views over the
driver's parquet tables (TPC-H-ish star schema plus ``events``).

The SQL below is the one text shared by Spark (``spark.sql``) and by the
DuckDB oracle (as a CTE prelude), so both engines see identical inputs.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# Fixture view definitions (view name, SQL), in dependency order.
FIXTURE_VIEWS: list[tuple[str, str]] = [
    ("DataMartBASE", """
SELECT CAST(n_nationkey AS BIGINT) AS DataMartID, n_name AS DataMartNM,
  CASE WHEN n_regionkey IN (0,1) THEN 'Source' WHEN n_regionkey IN (2,3) THEN 'Subject Area' ELSE 'IDEA' END AS DataMartTypeDSC,
  CASE WHEN n_nationkey % 10 = 9 THEN 'Y' ELSE 'N' END AS IsHiddenFLG FROM nation
  UNION ALL SELECT CAST(1000 AS BIGINT), 'ETLSequencedBatches', 'IDEA', 'N'"""),
    ("SAMBASE", """
SELECT DataMartID FROM DataMartBASE WHERE DataMartTypeDSC <> 'Source'"""),
    ("ETLBatchDefinitionBASE", """
SELECT s_suppkey AS BatchDefinitionID,
  CASE WHEN s_suppkey % 7 = 0 THEN s_name || ' & Co' ELSE s_name END AS BatchDefinitionNM,
  CAST(s_nationkey AS BIGINT) AS DataMartID,
  CASE s_suppkey % 4 WHEN 0 THEN 'All' WHEN 1 THEN 'Full' WHEN 2 THEN 'Incremental' ELSE 'Tables' END AS BatchLoadTypeCD,
  CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE s_suppkey % 5 END AS SourceConnectionID,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE TIMESTAMP '2001-07-31 00:00:00' + INTERVAL '1' HOUR * CAST(s_suppkey % 24 AS INT) END AS LastRunDTS FROM supplier"""),
    ("TableBASE", """
SELECT p_partkey AS TableID, p_partkey % 25 AS DataMartID, 'Edw' AS DatabaseNM, p_brand AS SchemaNM, 'T' || CAST(p_partkey AS VARCHAR(20)) AS TableNM,
  CASE WHEN p_type IN ('ECONOMY','SMALL') THEN 'Full' WHEN p_type = 'LARGE' THEN 'All' ELSE 'Incremental' END AS LoadTypeCD,
  p_partkey - p_partkey % 3 + 100000 AS ContentID FROM part"""),
    ("EntityBASE", """
SELECT p_partkey AS EntityID, p_partkey + 100000 AS ContentID FROM part"""),
    ("BindingBASE", """
SELECT o_orderkey AS BindingID, o_custkey % np AS DestinationEntityID, o_custkey % 25 AS DataMartID, o_orderkey % 5 AS SourceConnectionID,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Inactive' ELSE 'Draft' END AS BindingStatusCD
  FROM orders CROSS JOIN (SELECT COUNT(*) AS np FROM part) k"""),
    ("BindingDependencyBASE", """
SELECT l_orderkey AS BindingID, l_partkey AS SourceEntityID FROM lineitem"""),
    ("ETLBatchDefinitionTableBASE", """
SELECT p_partkey AS TableID, p_partkey % ns AS BatchDefinitionID FROM part CROSS JOIN (SELECT COUNT(*) AS ns FROM supplier) k WHERE p_size < 10"""),
    ("ETLBatchHistoryBASE", """
SELECT o_orderkey AS BatchID, s_suppkey AS BatchDefinitionID, CAST(s_nationkey AS BIGINT) AS DataMartID, o_orderdate AS StartDTS,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 600 AS INT) END AS EndDTS,
  (o_orderkey % 600) * 60 AS DurationSecondsCNT,
  CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'O' THEN 'Failed' ELSE 'Running' END AS StatusCD
  FROM orders CROSS JOIN (SELECT COUNT(*) AS ns FROM supplier) k JOIN supplier ON s_suppkey = o_custkey % ns"""),
    ("ETLTableHistoryBASE", """
SELECT l_orderkey AS BatchID, l_partkey AS EntityID,
  CASE WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'F' WHEN l_returnflag = 'N' THEN 'R' WHEN l_linestatus = 'F' THEN 'P' ELSE 'W' END AS StatusCD FROM lineitem"""),
    ("ETLBatchScheduleBASE", """
SELECT s_suppkey AS BatchDefinitionID, s_suppkey AS ScheduleID, CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE CAST(s_suppkey % 2 AS INT) END AS EnabledFLG FROM supplier WHERE s_suppkey % 3 <> 0"""),
    ("ETLSchedulePatternBASE", """
SELECT s_suppkey AS ScheduleID, CASE s_suppkey % 4 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Weekly' WHEN 2 THEN 'Monthly' END AS PatternTypeCD FROM supplier"""),
    ("ETLScheduleBASE", """
SELECT s_suppkey AS ScheduleID, CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE TIMESTAMP '2001-07-31 06:30:00' + INTERVAL '1' DAY * CAST(s_suppkey % 3 AS INT) END AS NextScheduledStartDTS FROM supplier"""),
    ("ETLSequencedBatches", """
SELECT a.BatchDefinitionID AS ID, ma.DataMartNM AS FromDataMartNM, a.BatchDefinitionNM AS FromBatchDefinitionNM,
  CASE WHEN b.BatchDefinitionID % 13 = 0 THEN 'Retired mart' ELSE mb.DataMartNM END AS ToDataMartNM,
  CASE WHEN b.BatchDefinitionID % 11 = 0 THEN 'Missing batch' ELSE b.BatchDefinitionNM END AS ToBatchDefinitionNM,
  CASE WHEN a.BatchDefinitionID % 5 = 0 THEN 0 ELSE 1 END AS IsActiveFLG
  FROM ETLBatchDefinitionBASE a JOIN ETLBatchDefinitionBASE b ON b.BatchDefinitionID = a.BatchDefinitionID + 1 + a.BatchDefinitionID % 3
  JOIN DataMartBASE ma ON ma.DataMartID = a.DataMartID JOIN DataMartBASE mb ON mb.DataMartID = b.DataMartID"""),
    ("SummaryBindingDependency", """
SELECT fm.DataMartNM AS SourceDataMartNM, ft.TableNM AS SourceEntityNM, tm.DataMartNM AS DestinationDataMartNM, b.BindingID AS DestinationBindingID, tt.TableNM AS DestinationEntityNM
  FROM BindingBASE b JOIN BindingDependencyBASE d ON d.BindingID = b.BindingID JOIN TableBASE ft ON ft.TableID = d.SourceEntityID JOIN TableBASE tt ON tt.TableID = b.DestinationEntityID
  JOIN DataMartBASE fm ON fm.DataMartID = ft.DataMartID JOIN DataMartBASE tm ON tm.DataMartID = b.DataMartID"""),
    ("ObjectAttributeBASE", """
SELECT BindingID AS ObjectID, 'UserDefinedSQL' AS AttributeNM,
  'SELECT T' || CAST(DestinationEntityID AS VARCHAR(20)) || '.C1 AS A1, Edw.Dbo.C2, C3,C4, COUNT(x) AS n, last' || CHR(10) || 'FROM [Edw].[Dbo].[T' || CAST(DestinationEntityID AS VARCHAR(20)) || '] t JOIN Edw.U' || CAST(BindingID AS VARCHAR(20)) || ' u' AS AttributeValueLongTXT FROM BindingBASE"""),
    ("SAMSnapshotTableManagementBASE", """
SELECT p_partkey + 1 AS ID, p_partkey AS TableID, CASE p_partkey % 4 WHEN 3 THEN 0 WHEN 2 THEN NULL ELSE 1 END AS PurgeDataFLG,
  CASE WHEN p_partkey % 5 = 4 THEN NULL ELSE 'l_shipdate' END AS PurgeDateFieldNM, CASE p_partkey % 6 WHEN 0 THEN 0 WHEN 5 THEN NULL ELSE CAST(p_partkey % 6 AS INT) * 365 END AS PurgeLookbackDaysNBR,
  CASE WHEN p_partkey % 7 = 6 THEN 0 ELSE 1 END AS ValidateSnapshotFLG, CASE p_partkey % 3 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Monthly' ELSE 'Weekly' END AS SnapshotPeriodCD FROM part"""),
    ("SnapshotRows", """
SELECT l_suppkey % 10 AS TableID, l_orderkey, l_linenumber, l_shipdate, l_shipdate AS LastLoadDTS FROM lineitem"""),
    ("RefreshOperation", """
SELECT DISTINCT user_id AS ObjectID, 'object-' || CAST(user_id AS VARCHAR(20)) AS ObjectNM, CASE WHEN user_id % 2 = 0 THEN 'Dataflow' ELSE 'Semantic Model / Dataset' END AS ObjectTypeCD, CAST(user_id % 4 AS INT) * 20 AS RetryAttemptNBR FROM events"""),
    ("RefreshHistory", """
SELECT event_id, user_id AS ObjectID, ts, CASE event_type WHEN 'view' THEN 'InProgress' WHEN 'click' THEN 'Unknown' WHEN 'purchase' THEN 'Completed' WHEN 'signup' THEN 'Success' ELSE 'Failed' END AS StatusCD FROM events"""),
    ("SnapshotFiles", """
SELECT DISTINCT 'BatchSequence_ENV' || CAST(user_id % 2 AS VARCHAR(20)) || '_' || CAST(200101 + (event_id % 12) AS VARCHAR(20)) || CAST(10 + event_id % 18 AS VARCHAR(20)) || '_' || CAST(10 + event_id % 14 AS VARCHAR(20)) || CAST(10 + event_id % 50 AS VARCHAR(20)) || CASE WHEN event_type IN ('view','error') THEN '.svg' WHEN event_type = 'click' THEN '.gv' ELSE '.html' END AS FileNM FROM events"""),
    ("BindingDocuments", """
SELECT b.BindingID AS Id, b.DestinationEntityID AS DestinationEntityId, b.DataMartID AS DataMartId, 'Binding ' || CAST(b.BindingID AS VARCHAR(20)) AS Name,
  CASE WHEN b.BindingID % 3 = 0 THEN 'Summary' ELSE 'Detail' END AS Classification, CASE WHEN b.BindingID % 4 = 0 THEN NULL ELSE 'Loads T' || CAST(b.DestinationEntityID AS VARCHAR(20)) END AS Description,
  b.BindingStatusCD AS Status, b.SourceConnectionID AS SourceConnectionId, m.DataMartNM AS DataMart, 'T' || CAST(b.DestinationEntityID AS VARCHAR(20)) AS DestinationEntity, o.AttributeValueLongTXT AS UserSQL
  FROM BindingBASE b JOIN ObjectAttributeBASE o ON o.ObjectID = b.BindingID LEFT JOIN DataMartBASE m ON m.DataMartID = b.DataMartID"""),
    ("EffectiveEvents", """
SELECT o_custkey AS EmployeeID, o_orderdate AS EventFromEffectiveDTS, o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey % 120 AS INT) AS EventToEffectiveDTS, o_orderpriority AS EventCodeDSC, o_orderstatus AS CompanyCD, 'Source ' || CAST(o_orderkey % 4 AS VARCHAR(20)) AS SourceDSC, o_orderkey FROM orders"""),
]

FIXTURE_NAMES = [n for n, _ in FIXTURE_VIEWS]


def oracle_prelude(names: list[str] | None = None, recursive: bool = False) -> str:
    """``WITH`` clause defining the fixture views for a DuckDB oracle query.

    Only the views a query needs (plus their dependencies) are emitted.
    """
    wanted = set(names or FIXTURE_NAMES)
    # dependencies between fixture views
    deps = {
        "SAMBASE": {"DataMartBASE"},
        "ETLSequencedBatches": {"ETLBatchDefinitionBASE", "DataMartBASE"},
        "SummaryBindingDependency": {"BindingBASE", "BindingDependencyBASE", "TableBASE", "DataMartBASE"},
        "ObjectAttributeBASE": {"BindingBASE"},
        "BindingDocuments": {"BindingBASE", "ObjectAttributeBASE", "DataMartBASE"},
    }
    changed = True
    while changed:
        changed = False
        for n in list(wanted):
            for d in deps.get(n, ()):
                if d not in wanted:
                    wanted.add(d)
                    changed = True
    parts = [f"{n} AS ({sql.strip()})" for n, sql in FIXTURE_VIEWS if n in wanted]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


#: Declared columns of the catalog tables (SRC-1).
CATALOG_SCHEMAS = {
    "DataMartBASE": "DataMartID bigint, DataMartNM string, DataMartTypeDSC string, IsHiddenFLG string",
    "SAMBASE": "DataMartID bigint",
    "ETLBatchDefinitionBASE": "BatchDefinitionID bigint, BatchDefinitionNM string, DataMartID bigint, "
                              "BatchLoadTypeCD string, SourceConnectionID bigint, LastRunDTS timestamp_ntz",
    "TableBASE": "TableID bigint, DataMartID bigint, DatabaseNM string, SchemaNM string, TableNM string, "
                 "LoadTypeCD string, ContentID bigint",
    "EntityBASE": "EntityID bigint, ContentID bigint",
    "BindingBASE": "BindingID bigint, DestinationEntityID bigint, DataMartID bigint, SourceConnectionID bigint, "
                   "BindingStatusCD string",
    "BindingDependencyBASE": "BindingID bigint, SourceEntityID bigint",
    "ETLBatchDefinitionTableBASE": "TableID bigint, BatchDefinitionID bigint",
    "ETLBatchHistoryBASE": "BatchID bigint, BatchDefinitionID bigint, DataMartID bigint, StartDTS timestamp_ntz, "
                           "EndDTS timestamp_ntz, DurationSecondsCNT bigint, StatusCD string",
    "ETLTableHistoryBASE": "BatchID bigint, EntityID bigint, StatusCD string",
    "ETLBatchScheduleBASE": "BatchDefinitionID bigint, ScheduleID bigint, EnabledFLG int",
    "ETLSchedulePatternBASE": "ScheduleID bigint, PatternTypeCD string",
    "ETLScheduleBASE": "ScheduleID bigint, NextScheduledStartDTS timestamp_ntz",
    "ETLSequencedBatches": "ID bigint, FromDataMartNM string, FromBatchDefinitionNM string, ToDataMartNM string, "
                           "ToBatchDefinitionNM string, IsActiveFLG int",
    "SummaryBindingDependency": "SourceDataMartNM string, SourceEntityNM string, DestinationDataMartNM string, "
                                "DestinationBindingID bigint, DestinationEntityNM string",
    "ObjectAttributeBASE": "ObjectID bigint, AttributeNM string, AttributeValueLongTXT string",
    "SAMSnapshotTableManagementBASE": "ID bigint, TableID bigint, PurgeDataFLG int, PurgeDateFieldNM string, "
                                      "PurgeLookbackDaysNBR int, ValidateSnapshotFLG int, SnapshotPeriodCD string",
}

_lock = threading.Lock()


class FixtureCatalog(dict):
    """Mapping of catalog table name -> DataFrame over one driver data folder.

    With ``materialize`` (the default) a view that joins, counts or removes
    repeats is computed when a job first asks for it, written as a parquet table
    below ``spark.checkpoint.dir`` (the shared folder) and read back -- the shape
    a production catalog has (stored tables), and a lineage cut that survives
    executor loss. A job pays for the tables it reads alone, and one after the
    other. Views that only name and map the columns of one driver table stay SQL
    over it: a copy would cost what it holds and save nothing. Without
    ``materialize`` all views are lazy SQL over the driver tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir
        root = None
        if materialize:
            from batchlens.session import ensure_checkpoint_dir
            # folder, definitions and input file sizes/times name the copy, so a
            # changed definition or input never reuses a stale one
            sig = [sf_dir, signature(spark, sf_dir)] + [sql for _, sql in FIXTURE_VIEWS]
            tag = hashlib.sha1("\n".join(sig).encode()).hexdigest()[:16]
            root = ensure_checkpoint_dir(spark).rstrip("/") + f"/batchlens-catalog/{tag}"
        self.root = root
        self._todo: set[str] = set()
        with _lock:
            for t in DRIVER_TABLES:
                spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)
                self[t] = spark.table(t)
            for name, sql in FIXTURE_VIEWS:
                spark.sql(sql).createOrReplaceTempView(name)
                self[name] = spark.table(name)
                if root is not None and computed(sql):
                    self._todo.add(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._todo:
            with _lock:
                if name in self._todo:
                    path = f"{self.root}/{name}"
                    if not _exists(self.spark, f"{path}/_SUCCESS"):
                        super().__getitem__(name).write.mode("overwrite").parquet(path)
                    reader = self.spark.read.schema(CATALOG_SCHEMAS[name]) if name in CATALOG_SCHEMAS else self.spark.read
                    self[name] = reader.parquet(path)
                    self._todo.discard(name)
        return super().__getitem__(name)


def computed(sql: str) -> bool:
    """Whether a view does more than name and map the columns of one table."""
    return any(word in sql for word in (" JOIN ", "DISTINCT", "UNION", "COUNT("))


def signature(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> str:
    """Size and time of every file of the input tables, from whatever file system they lie in."""
    out = []
    for t in names:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            continue
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append(f"{t}:{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return ";".join(sorted(out))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_cache: dict[tuple, FixtureCatalog] = {}


def fixture_catalog(spark: SparkSession, sf_dir: str) -> FixtureCatalog:
    """Build (once per session and folder) the fixture catalog for ``sf_dir``."""
    key = (id(spark), sf_dir.rstrip("/"), signature(spark, sf_dir))
    cat = _cache.get(key)
    if cat is None or cat.spark is not spark:
        cat = FixtureCatalog(spark, sf_dir)
        _cache[key] = cat
    return cat


def read_catalog(spark: SparkSession, root: str, tables: list[str] | None = None, fmt: str = "parquet",
                 schemas: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """SRC-1: read catalog tables stored one folder per table below ``root``, with their declared columns: a column
    that a table lacks reads as NULL, and no file is opened to infer a schema.

    ``schemas`` replaces the declaration of tables by name; a table without any is read as it is."""
    declared = CATALOG_SCHEMAS | (schemas or {})
    out = {}
    for t in tables if tables is not None else CATALOG_SCHEMAS:
        reader = spark.read.format(fmt)
        out[t] = (reader.schema(declared[t]) if t in declared else reader).load(f"{root.rstrip('/')}/{t}")
    return out
