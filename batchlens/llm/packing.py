"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Pieces are placed in decreasing order:
into the open bin they leave the least room in, or else into a new bin of the
size that costs least for each token it can still receive (``cost``: a share
for each sequence, one for each token and one that grows with attention). When
all pieces are placed, each bin shrinks to the smallest permitted length that
holds its contents. Documents longer than the largest length are cut. Lengths
are words, not token ids; a word counts once for each ``LONGEST`` characters
begun, so text without blanks has its length too.

Pieces are dealt by a hash of document, piece and row to blocks of about ``BLOCK``
pieces, which are packed independently, each in bounded memory: what is lost is
at most the last bins of a block. The rows of one doc_id go to up to ``SALTS``
tasks, and a block is closed when it is full, so many rows with one key neither
gather in a task nor grow a block.

Defined results: NULL or empty text has one token, the end mark; equal rows are
packed each; ties keep the order of doc_id and piece; an empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import SPACE_WORD, table

LONGEST = 64  #: characters of a word that count as one
CAPACITIES = (512, 1024, 2048, 4096, 8192)
BLOCK = 20_000
SALTS = 1024  #: tasks that the rows of one doc_id are dealt to
SEQUENCE_COST = 64.0  #: tokens' worth of work that every sequence takes
ATTENTION = 32_768.0  #: length at which attention costs as much as the rest
PACKED = ("doc_id string, piece int, start long, length int, bin_id long, bin_offset int, capacity int, "
          "bin_length int")


def cost(capacity: int) -> float:
    return SEQUENCE_COST + capacity * (1 + capacity / ATTENTION)


def new_bin(length: int, left: int, capacities=CAPACITIES) -> int:
    """The size with the least cost for each token it can receive: no more than ``left`` are still to be placed."""
    return min((c for c in capacities if c >= length), key=lambda c: (cost(c) / min(c, left), c))


def pack(lengths: list[int], capacities=CAPACITIES) -> list[tuple[int, int, int, int]]:
    """(bin, offset, capacity, contents) of each piece."""
    left = sum(lengths)
    bins: list[list[int]] = []  # capacity, used
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    placed = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            b, room = len(bins), new_bin(n, left, capacities)
            bins.append([room, 0])
        placed[i] = (b, bins[b][1])
        bins[b][1] += n
        if room > n:
            insort(rooms, (room - n, b))
        left -= n
    size = [min(c for c in capacities if c >= used) for _, used in bins]
    return [(b, offset, size[b], bins[b][1]) for b, offset in placed]


def pieces(docs: DataFrame, capacities=CAPACITIES) -> DataFrame:
    """doc_id, piece, start, length: words (long ones in parts) and an end mark, cut at the largest capacity."""
    most = max(capacities)
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"{SPACE_WORD[:-1]}{{1,{LONGEST}}}")) + 1
    row = [c for c in docs.columns if c == "row"]
    return (docs.select("doc_id", *row, n.cast("long").alias("n"))
            .select("doc_id", *row, "n", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / most).cast("int"))).alias("piece"))
            .select("doc_id", *row, "piece", (F.col("piece").cast("long") * most).alias("start"),
                    F.least(F.lit(most), F.col("n") - F.col("piece") * most).cast("int").alias("length")))


def best_fit(docs: DataFrame, capacities=CAPACITIES) -> DataFrame:
    """Every piece with its bin, its place in it, the bin's contents and its final capacity."""
    cut = pieces(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), capacities)
    blocks = max(1, -(-docs.count() // BLOCK))

    def place(batches):
        from pyspark import TaskContext

        task, block = TaskContext.get().partitionId(), 0

        def closed(held: pd.DataFrame) -> pd.DataFrame:
            found = pack(held.length.tolist(), capacities)
            first = (task << 40) + (block << 20)  # a block has fewer than 2^20 bins
            held = held.assign(bin_id=[first + x[0] for x in found], bin_offset=[x[1] for x in found],
                               capacity=[x[2] for x in found], bin_length=[x[3] for x in found])
            return held

        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            while len(held) >= 2 * BLOCK:
                yield closed(held.iloc[:BLOCK].reset_index(drop=True))
                held, block = held.iloc[BLOCK:].reset_index(drop=True), block + 1
        if held is not None and len(held):
            yield closed(held)

    dealt = (cut.withColumn("doc_id", F.col("doc_id").cast("string"))
             .repartition(blocks, F.xxhash64(F.lit(29), "doc_id", "piece", F.pmod("row", F.lit(SALTS)))).drop("row")
             .sortWithinPartitions("doc_id", "piece", "length"))
    return dealt.mapInPandas(place, PACKED).withColumn("doc_id", F.col("doc_id").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))
