"""Helpers the operators share: input tables, shared scratch tables, word patterns."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlens.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words between ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Words of digits, lower-case ASCII letters and all non-ASCII characters.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage is cut and it is computed once."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same, faster, where all characters are ASCII."""
    return F.when(F.char_length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def words_of(c: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in order; NULL text has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key() -> Column:
    """Tells rows apart that share a doc_id but not the text."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Null-safe equality of (doc_id, k)."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["k"] == b["k"])


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only where the counted rows stay within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def sampled(seed: int, *columns: str, wanted: int, rows: int) -> Column:
    """Rows whose hash of ``columns`` is among the lowest ``wanted`` of ``rows`` parts: about ``wanted`` rows of any
    number, as the hash has 63 bits."""
    most = (1 << 63) - 1
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit(most)) <= F.lit(most * min(wanted, rows) // max(rows, 1))


def removed(spark: SparkSession, path: str) -> None:
    """Removes a scratch table of ``work_path`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def portions(sizes: list[int], most: int):
    """(from, to) of runs of items that end where their sizes reach ``most``."""
    first = size = 0
    for i, own in enumerate(sizes, 1):
        size += own
        if size >= most:
            yield first, i
            first, size = i, 0
    if first < len(sizes):
        yield first, len(sizes)


def keep_freed_memory() -> None:
    """Lets this process keep memory it frees for its next arrays. Without it, malloc gives arrays of some MB back to
    the system each time, and every 4 KB of the next ones cost a page fault; its limit grows to a freed block's size."""
    np.empty(31 << 20, np.uint8)  # malloc's own bound is 32 MB
