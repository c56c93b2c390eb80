"""Centroid clustering of integer vectors with an incremental distance matrix.

Each vector keeps its exact integer dot products with all centroids. When the
centroids move, only the components that changed are multiplied: the dot
products grow by v[changed] . difference, and the nearest centroid is the
smallest |c|^2 - 2 v.c (ties: the smaller number). All arithmetic is on
integers, so a product that was updated ten times equals one made anew.

A round is one pass: tasks read the last state table, update, assign, write the
next state, and add one row with their sums for each cluster. Spark adds these
rows up; only K x (components + 1) sums and K centroids reach the driver. A state
table lies in the shared folder, so a lost executor costs its tasks of one
round; once the next state is written it is removed, so two are kept at most.
No row is ever shuffled: a cluster with nearly all vectors costs no more.

Defined results: vectors that are NULL, of another length, or with a NULL or
non-finite component are left out; components beyond +-2^27 after scaling are
held there, so that every distance fits 64 bits; rows that repeat are clustered
each; a NULL vec_id is hashed as an empty one; fewer vectors than centroids
give as many centroids; an empty table gives an empty result; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlens.llm.common import removed, table, work_path

COMPONENTS = 64
SCALE = 1024
K = 8
ROUNDS = 10
SEED = 3
BOUND = 1 << 27


def integers(vector: Column, scale: int, bound: int) -> Column:
    """floor(scale * x) of every component as int; NULL where one is NULL or not finite."""
    def one(x: Column) -> Column:
        x = x.cast("double")
        return F.floor(F.least(F.greatest(x * scale, F.lit(float(-bound))), F.lit(float(bound)))).cast("int")

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, one))


def kept(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and v (integers) of the vectors that take part."""
    v = F.when(F.size("embedding") == components, integers(F.col("embedding"), scale, BOUND))
    return vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull())


def starts(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes, in their order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    found = rows.select("v", F.sha2(text.cast("binary"), 256).alias("h")).orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in found], np.int64)


def _state(rows: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("v", T.BinaryType()),
                         T.StructField("dots", T.BinaryType()), T.StructField("cluster", T.IntegerType()),
                         T.StructField("distance", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def updated(dots: np.ndarray, v: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids changed by ``change`` (K x components)."""
    out = dots.copy()
    for j, row in enumerate(change):
        at = np.flatnonzero(row)
        if len(at):
            out[:, j] += v[:, at].astype(np.int64) @ row[at]
    return out


def _pass(centroids: np.ndarray, change: np.ndarray):
    """Arrow batches of a state to those of the next; a batch without ``dots`` starts from nothing."""
    k, width = centroids.shape
    norms = (centroids * centroids).sum(1)

    def run(batches):
        sums, vec_id = np.zeros((k, width + 1), np.int64), None
        for b in batches:
            if not b.num_rows:
                continue
            vec_id = b.column("vec_id").type
            if "dots" in b.schema.names:
                v = _unpacked(b.column("v"), "<i4", width)
                dots = updated(_unpacked(b.column("dots"), "<i8", k), v, change)
            else:
                v = b.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, width)
                dots = updated(np.zeros((len(v), k), np.int64), v, centroids)
            near = norms - 2 * dots
            cluster = near.argmin(1)
            wide = v.astype(np.int64)
            distance = near[np.arange(len(v)), cluster] + (wide * wide).sum(1)
            for j in range(k):
                own = wide[cluster == j]
                sums[j, :width] += own.sum(0)
                sums[j, width] += len(own)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), _packed(v), _packed(dots), pa.array(cluster, pa.int32()), pa.array(distance),
                 pa.nulls(len(v), pa.list_(pa.int64()))], ["vec_id", "v", "dots", "cluster", "distance", "sums"])
        if vec_id is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, vec_id), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
                 pa.nulls(1, pa.int64()), pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))],
                ["vec_id", "v", "dots", "cluster", "distance", "sums"])

    return run


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the means of the clusters; an empty one keeps its centroid."""
    k, width = centroids.shape
    rows = state.where(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    total = np.zeros(k * (width + 1), object)
    for r in rows:
        total[r["at"]] = int(r["n"])
    total = total.reshape(k, width + 1)
    out = centroids.copy()
    for j in range(k):
        if total[j, width]:
            out[j] = [s // total[j, width] for s in total[j, :width]]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, dots, cluster, distance of every vector that takes part; centroids) after ``rounds`` rounds."""
    spark = vectors.sparkSession
    rows = kept(vectors, components, scale)
    centroids, schema = starts(rows, k, seed), _state(rows)
    if not len(centroids):
        return spark.createDataFrame([], schema).drop("sums"), np.zeros((0, components), np.int64)

    def passed(df: DataFrame, change: np.ndarray) -> tuple[str, DataFrame]:
        path = work_path(spark, "clusters")
        df.mapInArrow(_pass(centroids, change), schema).write.parquet(path)
        return path, spark.read.schema(schema).parquet(path)

    path, state = passed(rows, centroids)
    for _ in range(rounds):
        new = _means(state, centroids)
        change, centroids = new - centroids, new
        if not change.any():
            break  # nothing moves any more: all further rounds give the same
        old = path
        path, state = passed(state.where(F.col("v").isNotNull()), change)
        removed(spark, old)
    return state.where(F.col("v").isNotNull()).drop("sums"), centroids


def clustered(vectors: DataFrame) -> DataFrame:
    """The contract's row per vector."""
    state, centroids = cluster(vectors)
    spark = vectors.sparkSession
    found = {r["cluster"]: int(r["d"]) for r in state.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # K rows at most
    most, total = (1 << 63) - 1, sum(found.values())
    of = [(j, min(d, most), min(total, most), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest())
          for j, d in found.items()]
    of = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def oracle() -> str:
    """DuckDB SQL: the rounds one after the other, every distance anew."""
    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min([d, j]) AS near
            FROM (SELECT r, vec_id, v, j, CAST(list_sum(list_transform(list_zip(v, c),
                  lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, c{n}) GROUP BY r)"""

    steps = []
    for n in range(ROUNDS):
        steps.append(assigned(n))
        steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT c{n}.j, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
            SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c FROM (
                SELECT near[2] AS j, p, sum(v[p]) AS s, count(*) AS n FROM a{n}, range(1, {COMPONENTS + 1}) g(p)
                GROUP BY 1, 2) GROUP BY j) m ON m.j = c{n}.j)""")
    steps.append(assigned(ROUNDS))
    rounds = ",\n".join(steps)
    return f"""WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id,
               list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {COMPONENTS}
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS BIGINT) AS j, v AS c
        FROM kept QUALIFY j < {K}),
    {rounds}
    SELECT vec_id, CAST(near[2] AS INTEGER) AS cluster, near[1] AS distance,
           CAST(sum(near[1]) OVER (PARTITION BY near[2]) AS BIGINT) AS cluster_inertia,
           CAST(sum(near[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN c{ROUNDS} ON j = near[2]"""
