"""SRC-5: file listings read by Spark (name, modification time, size) --
the archive jobs' input. ``binaryFile`` is used for its metadata columns
only; the content column is never selected, so file bodies are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(FilePath, FileNM, ModifiedDTS, LengthNBR) for files in ``folder`` matching ``pattern``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(folder))
    return df.select(F.col("path").alias("FilePath"),
                     F.regexp_extract("path", r"([^/\\]+)$", 1).alias("FileNM"),
                     F.col("modificationTime").cast("timestamp_ntz").alias("ModifiedDTS"),
                     F.col("length").alias("LengthNBR"))
