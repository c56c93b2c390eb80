"""Resampling documents towards a target distribution by hashed n-gram weights.

After Xie et al., "Data Selection for Language Models via Importance
Resampling" (2023). The tokenizers library splits the ASCII-lowered text with a
regular expression (nothing is trained) and returns words with offsets. Windows
of 1 to ``GRAM`` neighbouring offset pairs are the features; the CRC of a
window, its words joined by one space, comes from the CRCs of its words
(crc(ab) = crc(a) after len(b) zero bytes, xor crc(b)), so no feature is ever a
string. White space is in no word, so a chunk between blanks is split once and
its words are known when it comes again. Buckets of the CRCs are counted over all documents and all target
texts; a document's weight sums the gains of its buckets, Gumbel noise from a
hash of its id is added, and the highest scores are drawn.

At scale: a task returns at most ``BUCKETS`` rows of its histogram, the driver
holds the two summed histograms and no more. Texts are split twice instead of
keeping their features, which are larger than the texts. The draw range-sorts
narrow rows above a safe cutoff by (score, doc_id, row), so that a repeated id
or score spreads over partitions, and numbers them by offsets of partitions;
what is not drawn is told by the last key drawn, without a join.

Defined results: NULL or empty text has no words and no features, weight 0;
rows that repeat are scored and drawn each; a NULL doc_id is hashed as an empty
one and comes last among ties; texts are split in slices, so any length will do;
without target features the gains come from the documents alone; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.common import PLAIN_WORD, table, written

GRAM = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SLICE = 1 << 18  #: characters that are split and hashed at once
BYTES = 32  #: bytes of a word that are hashed column by column
LENGTHS = 64  #: lengths whose tables are kept as one array
KNOWN, KNOWN_BYTES = 500_000, 32 << 20  #: chunks that a task remembers, and their bytes
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_BLANK = re.compile(rb"[\x09-\x0D\x20]")


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> 1), t >> 1).astype(np.uint32)
    return t


_TABLE = _byte_table()
_SPACE = np.uint32(zlib.crc32(b" "))


def _applied(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map, given as what it makes of each value of each of the four bytes."""
    return (tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24])


_NONE = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
_ONE = _TABLE[_NONE & 255] ^ (_NONE >> 8)


@lru_cache(256)
def _zeros(length: int) -> np.ndarray:
    """Tables of what ``length`` zero bytes do to a CRC."""
    out, power = _NONE, _ONE
    while length:
        if length & 1:
            out = _applied(power, out)
        power, length = _applied(power, power), length >> 1
    return out


_SHIFT = np.concatenate([_zeros(n) for n in range(LENGTHS + 1)]).ravel()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC after as many zero bytes."""
    at = np.minimum(length, LENGTHS) * 1024
    out = (_SHIFT[at + (crc & 255)] ^ _SHIFT[at + 256 + (crc >> 8 & 255)]
           ^ _SHIFT[at + 512 + (crc >> 16 & 255)] ^ _SHIFT[at + 768 + (crc >> 24)])
    long = length > LENGTHS
    if long.any():
        for n in np.unique(length[long]).tolist():
            at = np.flatnonzero(length == n)
            out[at] = _applied(_zeros(n), crc[at])
    return out


def crcs(data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:start + length] for every pair; no length is 0."""
    order = np.argsort(-length, kind="stable")
    first, ordered = start[order], length[order]
    b = np.frombuffer(data, np.uint8)
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for j in range(min(BYTES, int(ordered[0]) if len(ordered) else 0)):
        n = int(np.searchsorted(-ordered, -j, side="left"))  # those longer than j
        x = state[:n]
        state[:n] = _TABLE[(x ^ b[first[:n] + j]) & 255] ^ (x >> 8)
    out = np.empty_like(state)
    out[order] = ~state
    for i in order[:int(np.searchsorted(-ordered, -BYTES, side="left"))]:
        out[i] = zlib.crc32(data[start[i]:start[i] + length[i]])
    return out


def _slices(text: str):
    """A text cut after characters that are in no word; a piece is longer than ``SLICE`` only if it is one word."""
    at = 0
    while len(text) - at > SLICE:
        cut = max((m.end() for m in _GAP.finditer(text, at, at + SLICE)), default=None)
        if cut is None:
            gap = _GAP.search(text, at + SLICE)
            cut = gap.start() if gap else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(PLAIN_WORD), behavior="removed", invert=True)


def word_offsets(split, text: str) -> tuple[bytes, np.ndarray]:
    """The text in UTF-8 and (start, end) bytes of its words."""
    pieces = split.pre_tokenize_str(text) if text else []
    at = np.fromiter(chain.from_iterable(o for _, o in pieces), np.int64, 2 * len(pieces)).reshape(-1, 2)
    data = text.encode()
    if len(data) != len(text):
        starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        at = np.append(starts, len(data))[at]
    return data, at


class Chunks:
    """Words of chunks between ASCII white space, which is in no word: a chunk is split once and then known.

    ``number`` of a chunk leads to its words: ``crc`` and ``length`` from ``start`` on, ``count`` of them."""

    def __init__(self):
        self.split = _splitter()
        self.clear()

    def clear(self) -> None:
        self.number, self.bytes = {}, 0
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, chunks: list[bytes]) -> None:
        whole = [c for c in chunks if len(c) > SLICE]  # too long to hold as offsets: cut at its gaps
        parts = [c.decode() for c in chunks if len(c) <= SLICE]
        at = np.cumsum([0] + [len(c) + 1 for c in chunks if len(c) <= SLICE])
        data, offsets = word_offsets(self.split, " ".join(parts))
        length = offsets[:, 1] - offsets[:, 0]
        found = [(crcs(data, offsets[:, 0], length), length)]
        count = np.diff(np.searchsorted(offsets[:, 0], at)).tolist()
        for c in whole:
            words = [w.encode() for piece in _slices(c.decode()) for w in _words(self.split, piece)]
            found.append((np.array([zlib.crc32(w) for w in words], np.uint32), np.array([len(w) for w in words], np.int64)))
            count.append(len(words))
        base, known = len(self.crc), len(self.number)
        self.number.update((c, known + i) for i, c in enumerate([c for c in chunks if len(c) <= SLICE] + whole))
        self.start = np.concatenate((self.start, base + np.cumsum([0, *count])[:-1]))
        self.count = np.concatenate((self.count, np.array(count, np.int64)))
        self.crc = np.concatenate([self.crc, *(x for x, _ in found)])
        self.length = np.concatenate([self.length, *(x for _, x in found)])
        self.bytes += sum(map(len, chunks))

    def words(self, rows: list[int], texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, CRC, length) of the words of texts that are given as chunks."""
        if self.bytes > KNOWN_BYTES or len(self.number) > KNOWN:
            self.clear()
        new = set().union(*texts).difference(self.number)
        if new:
            self.learn(sorted(new))
        sizes = [len(t) for t in texts]
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, sum(sizes))
        row, count = np.repeat(rows, sizes), self.count[at]
        places = self.start[at]
        if not (count == 1).all():
            row, places = np.repeat(row, count), np.repeat(places, count)
            ends = np.cumsum(count)
            places = places + np.arange(len(places)) - np.repeat(ends - count, count)
        return row, self.crc[places], self.length[places]


@lru_cache(1)
def _known_chunks() -> Chunks:
    """Those of this Python worker."""
    return Chunks()


def _words(split, piece: str) -> list[str]:
    return [piece] if len(piece) > SLICE else [w for w, _ in split.pre_tokenize_str(piece)]


def _blocks(texts):
    """(row, CRC, length) of words, for about ``SLICE`` bytes at once."""
    chunks, rows, held, size = _known_chunks(), [], [], 0
    for r, text in enumerate(texts):
        if not isinstance(text, str):
            continue
        data = text.encode("utf-8", "replace").lower()  # of bytes: A-Z alone
        for piece in _pieces(data):
            rows.append(r)
            held.append(piece.split())
            size += len(piece)
            if size >= SLICE:
                yield chunks.words(rows, held)
                rows, held, size = [], [], 0
    if held:
        yield chunks.words(rows, held)


def _pieces(data: bytes):
    """A long text cut at ASCII white space."""
    at = 0
    while len(data) - at > SLICE:
        gap = _BLANK.search(data, at + SLICE)
        cut = gap.start() if gap else len(data)
        yield data[at:cut]
        at = cut
    yield data[at:]


def features(texts):
    """(words in the window, row, CRC) arrays of all windows of ``GRAM`` words and fewer, block by block."""
    carry = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for block in _blocks(texts):
        old = len(carry[0])
        row, crc, length = (np.concatenate(x) for x in zip(carry, block, strict=True))
        yield 1, row[old:], crc[old:]
        spaced = shifted(np.full(len(crc), _SPACE), length) ^ crc  # of a space and the word
        window = crc
        for k in range(1, GRAM):
            if len(row) <= k:
                break
            # entry i is the window of the words i to i + k
            window = shifted(window[:len(row) - k], length[k:] + 1) ^ spaced[k:]
            new = np.flatnonzero((row[k:] == row[:-k]) & (np.arange(k, len(row)) >= old))
            yield k + 1, row[k:][new], window[new]
        carry = row[1 - GRAM:], crc[1 - GRAM:], length[1 - GRAM:]


def histogram(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of ``texts`` (text)."""

    def count(batches):
        n = np.zeros(buckets, np.int64)
        for pdf in batches:
            for _, _, crc in features(pdf.text):
                n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": n[at]})

    found = texts.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed target share over its source share."""
    n = len(source)
    of_s, of_t = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * of_s / ((s + 1.0) * of_t)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _noise(seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score of every row."""
    buckets = np.uint32(len(gain))

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(text: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(text), 3), np.int64)
        for k, row, crc in features(text):
            n = np.bincount(row, minlength=len(text))
            out[:, 1] += n
            if k == 1:
                out[:, 0] += n
            if len(row):
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))  # rows come in order
                out[row[first], 2] += np.add.reduceat(gain[crc % buckets], first)
        return pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    return docs.select("doc_id", weigh(F.col("text")).alias("w")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "w.n_words", "w.n_features", "w.weight",
        (F.col("w.weight") + _noise(seed)).alias("score"))


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]


def _above(scored: DataFrame, drawn: int, rows: int) -> DataFrame:
    """Rows above a cutoff that at least ``drawn`` rows reach: an approximate quantile, checked by a count."""
    share = min(1.0, drawn / rows + 0.005)
    cutoff = scored.agg(F.percentile_approx("score", 1 - share, 10_000)).first()[0]
    near = scored.where(F.col("score") >= cutoff)
    return near if near.count() >= drawn else scored


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (written in order, with their ``monotonically_increasing_id`` as ``at``) with ``rank`` from 1."""
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("part").alias("_part"), before.alias("_before"))
    return rows.join(F.broadcast(sizes), part == F.col("_part")).withColumn(
        "rank", F.col("_before") + own + 1).drop("_part", "_before", "at")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` (a written table) with ``rank``: 1, 2, 3 for the highest scores, NULL for what is not drawn."""
    able = F.col("n_words") >= least_words
    rows = scored.where(able)
    n = rows.count()
    drawn = n * percent // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = _above(rows, drawn, n).orderBy(*_order()).withColumn("at", F.monotonically_increasing_id())
    high = numbered(written(high, "high-scores")).where(F.col("rank") <= drawn)
    last = high.where(F.col("rank") == drawn).first()

    def key(score: Column, doc_id: Column, row: Column) -> Column:
        return F.struct((-score).alias("a"), doc_id.isNull().alias("b"), doc_id.alias("c"), row.alias("d"))

    id_type = scored.schema["doc_id"].dataType
    end = key(F.lit(last["score"]).cast("long"), F.lit(last["doc_id"]).cast(id_type), F.lit(last["row"]).cast("long"))
    rest = scored.where(~able | (key(F.col("score"), F.col("doc_id"), F.col("row")) > end))
    return high.select(*scored.columns, "rank").unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (NULL where not drawn) of every document."""
    gain = gains(histogram(docs, buckets), histogram(target, buckets))
    scored = written(weighted(docs, gain, seed), "importance")
    return draw(scored, percent, least_words).drop("row")


def query(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")
