"""Benchmark decontamination by winnowed fingerprints.

Of every ``GUARANTEE - K + 1`` consecutive k-gram hashes the smallest is kept,
on both sides. Two texts that share ``GUARANTEE`` words share such a window, so
they share a kept hash: joining the fingerprints finds every document with a
shared span, and extending the hits (a join of whole windows, as text) drops
the rest. Items of fewer than ``GUARANTEE`` words are one window, too short for
the guarantee; of those, whole windows of their length are joined at once.

The benchmark side is broadcast while its counted rows stay within
``BROADCAST_ROWS``; beyond, the same joins shuffle and adaptive execution
splits skewed keys. Hits are rows of one document each and are counted per
document, so an item that thousands of documents copy gathers nowhere.

Defined results: NULL or empty text has no words and no hits; rows that repeat
a doc_id are told apart by their text, equal rows get equal results; items
with the same id count once; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import (PLAIN_WORD, ascii_lower, broadcast_if_small, let, row_key, same_row, table,
                                  words_of, written)

GUARANTEE = 10
K = 5
BROADCAST_ROWS = 2_000_000
BROADCAST_KINDS = 20_000  #: sets of items, each with its ids


def _split(df: DataFrame, *cols) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return df.select(*cols, words_of(ascii_lower(text), PLAIN_WORD).alias("w"))


def fingerprints(words: Column) -> Column:
    """The distinct winnowed k-gram hashes of a word array; none for arrays shorter than GUARANTEE."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - K),
                         lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)]))
    per_window = GUARANTEE - K + 1
    least = let(hashed, lambda h: F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(h) - per_window),
        lambda i: F.least(*[F.get(h, i + j) for j in range(per_window)]))))
    return F.when(F.size(words) >= GUARANTEE, least).otherwise(F.array().cast("array<bigint>"))


def windows(words: Column, length: int) -> Column:
    """Every window of ``length`` consecutive words as (its text, its start)."""
    return F.when(F.size(words) >= length, F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.struct(F.array_join(F.slice(words, i + 1, length), " ").alias("g"), i.alias("start"))))


def item_windows(items: DataFrame) -> DataFrame:
    """(g, item, length): the distinct windows of every item."""
    whole = F.array(F.struct(F.array_join("w", " ").alias("g"), F.lit(0).alias("start")))
    return (items.where(F.size("w") > 0)
            .select("item", F.least(F.size("w"), F.lit(GUARANTEE)).alias("length"),
                    F.explode(F.when(F.size("w") >= GUARANTEE, windows(F.col("w"), GUARANTEE)).otherwise(whole)))
            .select(F.col("col.g").alias("g"), "item", "length").distinct())


def window_sets(wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, length, set): each window once, with the id of the set of items that have it; (set, items): those sets.

    A document meets a window once, however many items share it; items come in per set, not per place."""
    per = wanted.groupBy("g", "length").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per = written(per.withColumn("set", F.sha2(F.to_json("items").cast("binary"), 256)), "window-sets")
    return per.select("g", "length", "set"), per.groupBy("set").agg(F.first("items").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k, set, start, length): every place of a document where a window of items occurs; (set, items)."""
    items = written(_split(benchmark, F.col("item_id").cast("string").alias("item")), "items")
    wanted = written(item_windows(items), "item-windows")
    windows_of, sets = window_sets(wanted)
    lengths = {r["length"]: r["count"] for r in windows_of.groupBy("length").count().collect()}  # at most GUARANTEE rows
    marks = items.select(F.explode(fingerprints(F.col("w"))).alias("h")).distinct()
    words = _split(docs, "doc_id", row_key().alias("k"))
    found = []
    for length, rows in sorted(lengths.items()):
        source = words
        if length == GUARANTEE:
            alike = broadcast_if_small(marks, rows, BROADCAST_ROWS)  # a window has one fingerprint at most
            known = written(words.select("doc_id", "k", F.explode(fingerprints(F.col("w"))).alias("h"))
                            .join(alike, "h", "left_semi").select("doc_id", "k").distinct(), "candidates")
            source = words.join(broadcast_if_small(known, known.count(), BROADCAST_ROWS),
                                same_row(words, known), "left_semi")
        spans = (source.select("doc_id", "k", F.explode(windows(F.col("w"), length)).alias("x"))
                 .select("doc_id", "k", F.col("x.g").alias("g"), F.col("x.start").alias("start")))
        found.append(spans.join(broadcast_if_small(windows_of.where(F.col("length") == length), rows, BROADCAST_ROWS), "g")
                     .select("doc_id", "k", "set", "start", "length"))
    if not found:
        return docs.sparkSession.createDataFrame([], words.select("doc_id", "k").schema.add("set", "string")
                                                 .add("start", "integer").add("length", "integer")), sets
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, sets


def _covered(starts: Column) -> Column:
    """Words under the spans (start, length): sorted by start, each adds what reaches past those before."""
    step = lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(a["end"], x["start"]))).alias("n"),
        F.greatest(a["end"], x["start"] + x["length"]).alias("end"))
    return F.aggregate(F.sort_array(starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step,
                       lambda a: a["n"].cast("long"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document with hits: words hit, item ids. One row for rows that repeat."""
    places, sets = hits(docs.select("doc_id", "text"), benchmark)
    found = written(places.groupBy("doc_id", "k").agg(
        _covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"),
        F.sort_array(F.collect_set("set")).alias("sets")), "hits")
    # documents with the same sets have the same items: found once for them all
    kinds = found.select("sets").distinct()
    items = (kinds.select("sets", F.explode("sets").alias("set")).join(sets, "set")
             .select("sets", F.explode("items").alias("item")).groupBy("sets")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    items = written(items, "hit-items")
    return found.join(broadcast_if_small(items, items.count(), BROADCAST_KINDS), "sets").drop("sets")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row per document."""
    words = _split(docs.select("doc_id", "text"), "doc_id", row_key().alias("k"))
    sizes = words.select("doc_id", "k", F.size("w").cast("long").alias("n_words"))
    found = written(contaminated(docs, benchmark), "contaminated")
    n_hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return sizes.join(found, same_row(sizes, found), "left").select(
        sizes["doc_id"], "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows without a hit, with the columns of ``docs``."""
    found = written(contaminated(docs, benchmark).select("doc_id", "k"), "contaminated")
    found = broadcast_if_small(found, found.count(), BROADCAST_ROWS)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"])
                     & (F.xxhash64(docs["doc_id"], docs["text"]) == found["k"]), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_words(name: str, key: str) -> str:
    return (rf"(SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            rf"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {name})")


ORACLE = f"""
WITH d AS {_sql_words('documents', 'doc_id')}, b AS {_sql_words('benchmark', 'item_id')},
iw AS (SELECT DISTINCT item_id::VARCHAR AS item, least(len(w), {GUARANTEE}) AS n,
         array_to_string(w[i:i + least(len(w), {GUARANTEE}) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(1, len(w) - {GUARANTEE} + 1) + 1)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM d, (SELECT DISTINCT n FROM iw) AS l, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
h AS (SELECT doc_id, i, n, item FROM dw JOIN iw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM h, unnest(range(0, n)) AS v(j) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
