"""Nested metadata documents (JOB-24) and the environment-variable
inventory export (JOB-25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTRIBUTE = T.StructType([
    T.StructField("ObjectId", T.LongType()), T.StructField("Id", T.LongType()),
    T.StructField("AttributeName", T.StringType()), T.StructField("AttributeValue", T.StringType())])

CORRUPT = "_corrupt_record"  # text of a document that is no JSON
FILE_DOCUMENTS = 200_000  # of a compressed file

# Declared schema of a source-binding document; absent fields read as NULL.
BINDING_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("DestinationEntityId", T.LongType()),
    T.StructField("DataMartId", T.LongType()), T.StructField("Name", T.StringType()),
    T.StructField("Classification", T.StringType()), T.StructField("Description", T.StringType()),
    T.StructField("Status", T.StringType()), T.StructField("SourceConnectionId", T.LongType()),
    T.StructField("GroupingColumn", T.StringType()), T.StructField("GroupingFormat", T.StringType()),
    T.StructField("ContentId", T.StringType()), T.StructField("BindingType", T.StringType()),
    T.StructField("GrainName", T.StringType()), T.StructField("LoadTypeCode", T.StringType()),
    # a linked object, or its name: an object is kept as its JSON text
    T.StructField("DestinationEntity", T.StringType()), T.StructField("DataMart", T.StringType()),
    T.StructField("SourceConnection", T.StringType()),
    T.StructField("AttributeValues", T.ArrayType(ATTRIBUTE)),
    T.StructField("SourcedByEntities", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("IncrementalConfigurations", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("ObjectRelationships", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField(CORRUPT, T.StringType()),
])

CORE_FIELDS = ["Id", "DestinationEntityId", "DataMartId", "Name", "Classification", "Description", "Status",
               "SourceConnectionId", "GroupingColumn", "GroupingFormat", "ContentId", "BindingType", "GrainName",
               "LoadTypeCode", "DestinationEntity", "DataMart", "SourceConnection"]
# name of each nested table and its field
NESTED = {"sourced_by": "SourcedByEntities", "incremental": "IncrementalConfigurations",
          "relationships": "ObjectRelationships"}


def read_bindings(spark, path: str, one_per_line: bool = False) -> DataFrame:
    """SRC-3: binding documents (one JSON document per file, or per line,
    which splits large files that are not compressed) with the declared schema; no inference pass over
    the data. What is no JSON is kept in the corrupt-record column."""
    return (spark.read.schema(BINDING_SCHEMA).option("multiLine", not one_per_line)
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def flatten_bindings(docs: DataFrame) -> dict[str, DataFrame]:
    """JOB-24: core fields (PF-27) and one table per nested array (F-24):
    attributes, sourced-by entities, incremental configurations and object
    relationships, each keyed by the binding id."""
    core = docs.select(*CORE_FIELDS)
    attrs = (docs.select(F.col("Id").alias("BindingId"), F.explode_outer("AttributeValues").alias("a"))
             .filter(F.col("a").isNotNull()).select("BindingId", "a.*"))
    out = {"core": core, "attributes": attrs}
    for name, col in NESTED.items():
        out[name] = (docs.select(F.col("Id").alias("BindingId"), F.posexplode(col).alias("Pos", "e"))
                     .select("BindingId", "Pos", F.explode("e").alias("Key", "Value")))
    return out


def flatten_all(docs: DataFrame) -> DataFrame:
    """JOB-24, all tables in one pass over the documents: (BindingId, TableNM,
    Pos, FieldNM, ValueTXT). A document becomes one array of its core fields and
    of the fields of all its nested records, exploded once; absent core fields
    are NULL, and a text that is no JSON is the only row of its document."""
    def cell(table: str, pos, name, value):
        return F.struct(F.lit(table).alias("TableNM"), pos.cast("int").alias("Pos"), name.alias("FieldNM"),
                        value.cast("string").alias("ValueTXT"))

    zero = F.lit(0)
    parts = [F.array(*[cell("core", zero, F.lit(c), F.col(c)) for c in CORE_FIELDS])]
    parts.append(F.flatten(F.transform(F.col("AttributeValues"), lambda a, i: F.array(
        *[cell("attributes", i, F.lit(f.name), a[f.name]) for f in ATTRIBUTE.fields]))))
    def records(name: str, col: str):
        return F.flatten(F.transform(F.col(col), lambda e, i: F.transform(
            F.map_entries(e), lambda kv: cell(name, i, kv["key"], kv["value"]))))

    parts += [records(name, col) for name, col in NESTED.items()]
    empty = F.array().cast("array<struct<TableNM:string,Pos:int,FieldNM:string,ValueTXT:string>>")
    cells = F.when(F.col(CORRUPT).isNotNull(), F.array(cell("corrupt", zero, F.lit(CORRUPT), F.col(CORRUPT)))).otherwise(
        F.concat(*[F.coalesce(p, empty) for p in parts]))
    return docs.select(F.col("Id").alias("BindingId"), F.inline(cells))


def pivot_attributes(attrs: DataFrame) -> DataFrame:
    """Optional attribute pivot: one row per binding, one column per
    attribute name (names collected by Spark's pivot)."""
    return attrs.groupBy("BindingId").pivot("AttributeName").agg(F.first("AttributeValue"))


def flatten_json_text(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """JOB-24 over JSON text held in a column: one (id, AttributeName,
    AttributeValue) row per top-level key; unparsable text yields nothing."""
    m = F.from_json(F.col(json_col), "map<string,string>")
    return df.select(F.col(id_col), F.explode_outer(m).alias("AttributeName", "AttributeValue")).filter(
        F.col("AttributeName").isNotNull())


def environment_inventory(variables: DataFrame, environments: DataFrame) -> DataFrame:
    """JOB-25: plain environment variables with their environment. Secret
    values are never read: a variable with no plain value keeps NULL."""
    return (variables.join(environments, "environment_id")
            .select("variable_id", "environment_id", "environment_name", "name", F.col("value").alias("PlainValue")))


def write_documents_json(docs: DataFrame, path: str) -> None:
    """SNK-3: one JSON document per line (the nested shape is kept: arrays of
    structs stay arrays of objects). Files are compressed, as field names and
    texts repeat in each document; one task reads such a file, so none holds
    more than ``FILE_DOCUMENTS``."""
    docs.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCUMENTS).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-2: CSV with header, UTF-8."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
