"""SQL lineage: downstream bindings (JOB-22), table/column references
extracted from their SQL text (JOB-20) and the keyed replace load (JOB-21).

Extraction is a projection of built-in regex and higher-order functions
inside each row: every match of the table and column patterns becomes an
array element, column qualifiers are resolved against the last table of the
same lower-cased name, and the column matches are exploded. No Python runs
per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.sources import tables
from batchlens.sources.sinks import read_latest

# The two reference patterns (Python ``re`` with IGNORECASE;
# ``(?iU)`` gives Java the same Unicode-aware \w and case folding).
TABLE_PATTERN = r'(?:FROM|JOIN)\s+(?:\[?([\w]+)\]?\.)?(?:\[?([\w]+)\]?\.)?\[?([\w]+)\]?'
COLUMN_PATTERN = r'(?:SELECT|,)\s+(?:\[?([\w]+)\]?\.)?(?:\[?([\w]+)\]?\.)?\[?([\w]+)\]?(?:\s+(?:AS\s+)?\[?([\w]+)\]?)?'
FLAGS = "(?iU)"

REF_COLUMNS = ["DestinationBindingID", "ParsedDatabaseNM", "ParsedSchemaNM", "ParsedTableNM",
               "ParsedColumnNM", "ParsedColumnAliasNM"]


def downstream_bindings(cat, source_mart: str | None = None) -> DataFrame:
    """JOB-22: bindings of other marts that consume a mart, with their
    user-defined SQL (J-6 attribute filter in the join). ``source_mart=None``
    lists them for every source mart."""
    sbd = cat["SummaryBindingDependency"]
    oab = (cat["ObjectAttributeBASE"].filter(F.col("AttributeNM") == "UserDefinedSQL")
           .select(F.col("ObjectID").alias("DestinationBindingID"), "AttributeValueLongTXT"))
    x = sbd.join(oab, "DestinationBindingID")
    if source_mart is not None:
        x = x.filter(F.col("SourceDataMartNM") == source_mart)
    x = x.filter(F.col("SourceDataMartNM") != F.col("DestinationDataMartNM"))
    return x.select("SourceDataMartNM", "SourceEntityNM", "DestinationDataMartNM", "DestinationBindingID",
                    "DestinationEntityNM", "AttributeValueLongTXT")


def _all_matches(text, pattern: str, ngroups: int, prefix: str):
    """Array of structs, one per match, fields ``<prefix>1..n`` (groups that
    did not participate are ''). The text is scanned once; the groups are taken
    from the short matches, where the pattern finds the same groups again."""
    return F.transform(F.regexp_extract_all(text, F.lit(FLAGS + pattern), 0), lambda m: F.struct(
        *[F.regexp_extract(m, "^" + FLAGS + pattern, i).alias(f"{prefix}{i}") for i in range(1, ngroups + 1)]))


def extract_references(df: DataFrame, id_col: str = "DestinationBindingID",
                       sql_col: str = "AttributeValueLongTXT") -> DataFrame:
    """JOB-20 (LIN-1): one row per column reference found in each SQL text.

    Tables: ``FROM``/``JOIN`` + 1-3 part name; database/schema/table are the
    pattern's three groups (so a two-part name fills database, not schema),
    keyed by lower(table), the last occurrence wins. Columns: ``SELECT`` or a
    comma, whitespace, 1-3 part name, optional alias. A first qualifier that
    names a found table takes that table's parts; otherwise two qualifiers
    read as schema.table; otherwise all NULL. NULL/empty texts yield nothing.

    Each text is handled inside its own row (regex arrays + higher-order
    functions), so the job is a narrow map over the input: no shuffle, no
    row ids, and the whole text is always scanned. Table references become a
    per-text map (built once), so resolving column qualifiers costs one map
    lookup each.
    """
    txt = F.col(sql_col)
    tables = _all_matches(txt, TABLE_PATTERN, 3, "t")
    src = (df.filter(txt.isNotNull() & (txt != ""))
             .select(F.col(id_col).alias("_bid"), tables.alias("_tables"),
                     _all_matches(txt, COLUMN_PATTERN, 4, "c").alias("_cols")))
    # per text, once: lower(table) -> its last occurrence. Distinct keys, each
    # mapped to the element at its last position, so the map has no duplicate
    # keys and every column lookup below is a single map access.
    keys = F.transform("_tables", lambda t: F.lower(t["t3"]))
    last = lambda k: F.element_at(
        F.col("_tables"), (F.size(keys) - F.array_position(F.reverse(keys), k) + F.lit(1)).cast("int"))
    lookup = F.map_from_entries(F.transform(
        F.filter(F.array_distinct(keys), lambda k: k != ""), lambda k: F.struct(k.alias("k"), last(k).alias("v"))))
    x = src.select("_bid", lookup.alias("_lookup"), F.explode("_cols").alias("m"))
    ne = lambda c: F.nullif(c, F.lit(""))
    q1, q2 = ne(F.col("m.c1")), ne(F.col("m.c2"))
    x = x.withColumn("_hit", F.when(q1.isNotNull(), F.try_element_at(F.col("_lookup"), F.lower(q1))))
    found = F.col("_hit").isNotNull()
    two = q2.isNotNull()
    return x.select(
        F.col("_bid").alias("DestinationBindingID"),
        F.when(found, ne(F.col("_hit.t1"))).alias("ParsedDatabaseNM"),
        F.when(found, ne(F.col("_hit.t2"))).when(two, q1).alias("ParsedSchemaNM"),
        F.when(found, ne(F.col("_hit.t3"))).when(two, q2).alias("ParsedTableNM"),
        ne(F.col("m.c3")).alias("ParsedColumnNM"), ne(F.col("m.c4")).alias("ParsedColumnAliasNM"))


def parsed_bindings(cat) -> DataFrame:
    """References of every binding's user-defined SQL, each text parsed once (``extract_references``)."""
    return extract_references(cat["ObjectAttributeBASE"].filter(F.col("AttributeNM") == "UserDefinedSQL"),
                              "ObjectID", "AttributeValueLongTXT")


def downstream_references(cat, parsed: DataFrame | None = None, source_mart: str | None = None) -> DataFrame:
    """JOB-20 over JOB-22: the references of each row of ``downstream_bindings``.

    A binding occurs there once per dependency, with the same text: it is
    parsed once, and its references are repeated as often as it occurs."""
    parsed = parsed_bindings(cat) if parsed is None else parsed
    rows = cat["SummaryBindingDependency"]
    if source_mart is not None:
        rows = rows.filter(F.col("SourceDataMartNM") == source_mart)
    times = (rows.filter(F.col("SourceDataMartNM") != F.col("DestinationDataMartNM"))
             .groupBy("DestinationBindingID").agg(F.count(F.lit(1)).alias("_times")))
    return parsed.join(times, "DestinationBindingID").withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).select(*REF_COLUMNS)


def keyed_replace(existing: DataFrame, new: DataFrame, key: str = "DestinationBindingID") -> DataFrame:
    """SNK-4: delete the rows whose key occurs in the new batch, then insert
    the batch (null-safe anti join on the distinct new keys)."""
    keys = new.select(key).distinct()
    kept = existing.join(keys, existing[key].eqNullSafe(keys[key]), "left_anti")
    return kept.unionByName(new.select(*existing.columns))


#: Declared columns of the reference table, which is created with them when it is missing (SNK-6).
REF_SCHEMA = ", ".join(f"{c} {'bigint' if c == 'DestinationBindingID' else 'string'}" for c in REF_COLUMNS)


def load_references(spark, new: DataFrame, table_dir: str, retries: int = 5) -> str:
    """JOB-21: keyed replace into a versioned table under ``table_dir`` (SNK-6
    creates it when missing); the new version's commit record.

    The replacement is committed on the version that it was computed from; if
    another load has committed since, it is computed anew from that one, so
    neither load loses the other's rows."""
    base = tables.create(spark, table_dir, REF_SCHEMA)
    for attempt in range(retries + 1):
        out = keyed_replace(tables.read(spark, base), new.select(*REF_COLUMNS))
        try:
            return tables.replace(out, base).record
        except tables.Conflict:
            if attempt == retries:
                raise
            base = tables.version(spark, table_dir)


def latest_references(spark, table_dir: str) -> DataFrame:
    return read_latest(spark, table_dir)


def first_record(df: DataFrame) -> DataFrame:
    """S-5: the first record, a sample to try a parser on."""
    return df.limit(1)


def verify_sample(refs: DataFrame, n: int = 10) -> DataFrame:
    """S-3: the post-load check -- first ``n`` rows in key order."""
    return refs.orderBy(*REF_COLUMNS).limit(n)
