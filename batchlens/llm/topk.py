"""Exact top-k inner products by a three-phase uniform threshold.

After Cao and Wang, "Efficient Top-K Query Processing in Large Networks"
(2004). A score is the sum of ``LISTS`` local scores, one for each run of
components. (1) Each list gives every query its highest local entries; their
whole scores are gathered, and the k-th best of them is a safe cutoff: k vectors
reach it, so nothing below it is wanted. (2) The cutoff is sent to all lists,
which give up their entries of at least cutoff / ``LISTS``: a vector below that
in every list is below the cutoff. Of these, an entry whose known local scores
and the threshold in place of the missing ones stay below the cutoff goes too.
(3) The scores of what is left are resolved exactly, and the best k taken.

At scale: equal vectors are one class that carries its k + 1 smallest ids,
found by a group limit before the shuffle, so a group of copies, and ties, cost
one vector; queries with equal vectors are asked once. Query classes and
classes meet in tiles of ``QUERY_BLOCK`` x ``BLOCK``; a tile holds all lists of
its vectors and returns at most k entries a query (twice that in phase 1), so
what is shuffled after the tiles grows with queries, not with pairs. Nothing but
counts reaches the driver.

Defined results: vectors that are NULL or hold a NULL or non-finite component
take no part; of vectors of different lengths the components that one lacks
count as 0; components beyond +-2^23 after scaling are held there; a vec_id that
repeats names several rows, each a candidate, and each a query of its own that
leaves out only its own row; a NULL vec_id is no query and comes last among
ties; fewer candidates than k are all returned; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.centroids import integers
from batchlens.llm.common import broadcast_if_small, table, written

SCALE = 256
BOUND = 1 << 23
TOP = 5
EVERY = 50
LISTS = 2  #: two runs of components: the threshold is half the cutoff, as high as a sum of lists allows
BLOCK = 4096  #: vectors of a tile
QUERY_BLOCK = 2048  #: queries of a tile
AT_ONCE = 64  #: queries of a tile that are scored at once
MOST_PARTITIONS = 10_000
BROADCAST_ROWS = 100_000


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for row, v in zip(out, column.to_pylist(), strict=True):
        row[:len(v)] = v
    return out


def _widest(*columns: pa.ChunkedArray) -> int:
    return max(max(map(len, c.to_pylist()), default=0) for c in columns)


def local_scores(q: np.ndarray, v: np.ndarray, lists: int = LISTS) -> list[np.ndarray]:
    """Exact local scores (queries x vectors) of every list."""
    out = []
    for at in np.array_split(np.arange(q.shape[1]), lists):
        a, b = q[:, at], v[:, at]
        most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * len(at)
        if most < 2 ** 53:  # exact in doubles, whose products are fast
            out.append((a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64))
        else:
            out.append(a @ b.T)
    return out


def gathered(local: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (query, whole score) of each list's ``k`` highest entries of every query."""
    n, m = local[0].shape
    take = min(k, m)
    seen = np.zeros((n, m), bool)
    for x in local:
        np.put_along_axis(seen, np.argpartition(-x, take - 1, axis=1)[:, :take], True, axis=1)
    q, v = np.nonzero(seen)
    return q, sum(x[q, v] for x in local)


def sufficient(local: list[np.ndarray], cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3: (query, vector, score) of all that reach each query's cutoff."""
    lists = len(local)
    near = np.zeros(local[0].shape, bool)
    for x in local:
        near |= x >= -(-cutoff // lists)[:, None]
    q, v = np.nonzero(near)
    # a list that did not send the entry has it below the threshold
    below = -(-cutoff[q] // lists) - 1
    parts = [x[q, v] for x in local]
    upper = sum(np.maximum(x, below) for x in parts)
    able = upper >= cutoff[q]
    q, v, score = q[able], v[able], sum(x[able] for x in parts)
    top = score >= cutoff[q]
    return q[top], v[top], score[top]


def _first(query: np.ndarray, k: int, *order: np.ndarray) -> np.ndarray:
    """Positions of the first ``k`` of each query by ``order`` (the last key counts most, after the query)."""
    at = np.lexsort((*order, query))
    own = query[at]
    start = np.searchsorted(own, own, side="left")
    return at[np.arange(len(at)) - start < k]


def _tiles(queries: DataFrame, classes: DataFrame, sizes: tuple[int, int], run, schema: str) -> DataFrame:
    """``run`` on each tile of a block of queries (class, v, ...) and a block of classes (class, v, ...)."""
    qb, vb = max(1, -(-sizes[0] // QUERY_BLOCK)), max(1, -(-sizes[1] // BLOCK))
    partitions = min(qb * vb, MOST_PARTITIONS)

    def dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64(F.lit(37), "class"), F.lit(blocks))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn(
            other, F.col(other).cast("long")).repartition(partitions, "qb", "vb")

    return dealt(queries, "qb", qb, "vb", vb).groupBy("qb", "vb").cogroup(
        dealt(classes, "vb", vb, "qb", qb).groupBy("qb", "vb")).applyInArrow(run, schema)


def _scored(left: pa.Table, right: pa.Table):
    """(first query, local scores) of a tile, ``AT_ONCE`` queries at a time."""
    if not left.num_rows or not right.num_rows:
        return
    width = _widest(left.column("v"), right.column("v"))
    q, v = _matrix(left.column("v"), width), _matrix(right.column("v"), width)
    for at in range(0, len(q), AT_ONCE):
        yield at, local_scores(q[at:at + AT_ONCE], v)


def cutoffs(queries: DataFrame, classes: DataFrame, sizes: tuple[int, int], k: int) -> DataFrame:
    """Phase 1: query and its cutoff, for queries with at least ``k`` candidate classes."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ids = left.column("class").to_numpy()
        for at, local in _scored(left, right):
            q, s = gathered(local, k)
            best = _first(q, k, -s)
            query.append(ids[at + q[best]])
            score.append(s[best])
        return pa.table({"query": np.concatenate(query), "score": np.concatenate(score)})

    found = _tiles(queries, classes, sizes, run, "query long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    found = found.withColumn("place", place).where(F.col("place") <= k)
    return found.groupBy("query").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") == k).drop("n")


def best_classes(queries: DataFrame, classes: DataFrame, sizes: tuple[int, int], k: int) -> DataFrame:
    """Phases 2 and 3: query, class and score of the ``k`` best classes; ``queries`` have ``cutoff`` (or NULL)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query": [np.zeros(0, np.int64)], "class": [np.zeros(0, np.int64)], "score": [np.zeros(0, np.int64)]}
        ids, names = left.column("class").to_numpy(), right.column("class").to_numpy()
        cutoff = left.column("cutoff").fill_null(-(1 << 62)).to_numpy()
        no_id = right.column("no_id").to_numpy()
        vec_id = right.column("vec_id").fill_null(0).to_numpy()
        for at, local in _scored(left, right):
            q, v, s = sufficient(local, cutoff[at:at + AT_ONCE])
            best = _first(q, k, names[v], vec_id[v], no_id[v], -s)
            out["query"].append(ids[at + q[best]])
            out["class"].append(names[v[best]])
            out["score"].append(s[best])
        return pa.table({n: np.concatenate(x) for n, x in out.items()})

    found = _tiles(queries, classes, sizes, run, "query long, class long, score long")
    ids = classes.select("class", "no_id", "vec_id")
    found = found.join(broadcast_if_small(ids, sizes[1], BROADCAST_ROWS), "class")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "vec_id", "class"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("query", "class", "score")


def search(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of every row that ``is_query`` (of vec_id) chooses."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), scale, BOUND).alias("v"))
    rows = written(rows.where(F.col("v").isNotNull()).withColumn("row", F.monotonically_increasing_id()), "vectors")
    # one more than k: a query's own row may be among them
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"), "row"))
    members = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("v").agg(F.sort_array(
        F.collect_list(F.struct(F.col("vec_id").isNull().cast("int").alias("no_id"), "vec_id", "row"))).alias("members"))
    classes = written(members.select("v", "members", F.col("members")[0]["row"].alias("class"),
                                     F.col("members")[0]["no_id"].alias("no_id"),
                                     F.col("members")[0]["vec_id"].alias("vec_id")), "classes")
    asked = rows.where(is_query)
    wanted = asked.select("v").distinct()
    queries = written(classes.join(wanted, "v", "left_semi").select("class", "v"), "queries")
    sizes = queries.count(), classes.count()

    tiled = classes.select("class", "v", "no_id", "vec_id")
    cut = written(cutoffs(queries, tiled.select("class", "v"), sizes, k + 1), "cutoffs")
    with_cutoff = queries.join(cut, F.col("class") == F.col("query"), "left").select("class", "v", "cutoff")
    best = best_classes(with_cutoff, tiled, sizes, k + 1)

    # at most (k + 1)^2 rows a query class
    rows_of = best.join(broadcast_if_small(classes.select("class", "members"), sizes[1], BROADCAST_ROWS), "class").select(
        "query", "score", F.explode("members").alias("m"))
    answers = rows_of.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("s"), "m.no_id", "m.vec_id", "m.row"))), 1, k + 1).alias("best"))
    answers = written(answers.join(queries, F.col("query") == F.col("class")).select("v", "best"), "answers")
    found = asked.withColumnRenamed("vec_id", "query_id").join(broadcast_if_small(answers, sizes[0], BROADCAST_ROWS), "v")
    others = F.slice(F.filter("best", lambda x: x["row"] != F.col("row")), 1, k)
    return found.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS INTEGER) AS rank,
       c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
FROM kept q JOIN kept c ON q.r <> c.r WHERE q.vec_id % {EVERY} = 0 QUALIFY rank <= {TOP}"""
