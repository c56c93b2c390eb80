"""Range shards with splitters that depend on the rows alone, and files committed by rename.

``ranges`` picks splitters from a hash-chosen sample of the keys, weighted by
bytes, so the same rows give the same shards whatever the partitions or
executors were. Files are written under a temporary name and renamed, so a
task that is lost or runs twice leaves no partial file under a final name; what
counts is listed in the manifest, which Spark commits as a table.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import sampled

SAMPLE_PER_SHARD = 40
MOST_SAMPLED = 2_000_000  #: keys on the driver at most, for any number of shards


def ranges(rows: DataFrame, key: str, size: Column, shard_bytes: int) -> list[int]:
    """Upper bounds of all shards but the last, each of about ``shard_bytes`` by ``size``."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    shards = max(1, -(-(total["bytes"] or 0) // shard_bytes))
    if shards == 1:
        return []
    sample = rows.where(sampled(23, key, wanted=min(shards * SAMPLE_PER_SHARD, MOST_SAMPLED), rows=total["n"]))
    # a key that repeats is one row with all its bytes
    drawn = (sample.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.sum(size + 1).alias("bytes"))
             .toPandas().sort_values(["key", "bytes"]))
    if not len(drawn):
        return []
    at = np.searchsorted(drawn["bytes"].cumsum(), np.arange(1, shards) * drawn["bytes"].sum() / shards)
    return sorted({int(k) for k in drawn["key"].to_numpy()[np.minimum(at, len(drawn) - 1)]})


def shard_of(key: Column, bounds: list[int]) -> Column:
    """Number of the shard of a key; NULL keys come first."""
    cuts = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.int64), side="left").astype(np.int32))

    return F.when(key.isNull(), F.lit(0)).otherwise(find(F.coalesce(key.cast("long"), F.lit(0))))


def file_system(uri: str):
    """Arrow file system and path of a folder, local or not."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class RenamedFile:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, path = file_system(folder)
        self.fs.create_dir(path, recursive=True)
        self.final, self.temporary = f"{path}/{name}", f"{path}/_{name}.{uuid.uuid4().hex}.tmp"
        self.out, self.bytes = self.fs.open_output_stream(self.temporary, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.final)
