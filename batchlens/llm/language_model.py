"""Masked pseudo-likelihood with a bidirectional window network in numpy.

Every word is predicted from the ``SIDE`` words before and after it; the sum of
the conditional log-probabilities scores the document (Wang and Cho, 2019).
Word ids come from counts over the whole table: the ``WORDS`` most frequent
words have ids of their own, the others share ``RARE`` hashed ids. The output
is a two-level softmax over ``CLASSES`` classes of ``WIDTH`` ids. A word that
shares its id has the id's probability times its own part of the id's count,
(n + 1) / (words counted + different words + 1), where n is read from the table
of all counts: by a join, but for the most frequent, at most ``OFTEN`` words,
whose parts the tasks have; the last 1 is for words never counted. Texts are
turned into ids once, and training and scoring read the written ids.
``log_prob`` is the sum over the ids, ``word_log_prob`` and its mean are those of
the words.

Training: each task runs Adam over the documents it reads, predicting every
word of each document from its whole context, ``BATCH`` words a step, and
returns its weights with the number of words they have seen; Spark averages them, weighted,
in one grouped sum. No document is left out, what is gathered grows with the
input, and only the averaged network (a fixed number of floats) reaches the
driver.

Defined results: NULL or empty text has no words, log-probability 0 and NULL
mean; rows that repeat are scored each; texts of any length are scored in
blocks of ``BLOCK`` words; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlens.llm.common import keep_freed_memory, portions, table, written

CLASSES, WIDTH = 64, 64
IDS = CLASSES * WIDTH
RARE = 256
WORDS = IDS - RARE
OFTEN = 1 << 16
SIDE = 2
EMBEDDING, HIDDEN = 16, 32
BATCH, RATE = 8192, 0.005
BLOCK = 1 << 13
PORTION = 4 << 20  #: characters of texts split together
COUNTED = 16 << 20  #: bytes of texts whose words are counted together
TOGETHER = 1 << 19  #: words of documents that are learnt or scored from one array
SHORT = 32  #: bytes of words whose checksums are taken together
KNOWN_LIMIT = 500_000  #: words whose ids a task remembers

SHAPES = {"E": (IDS + 1, EMBEDDING), "W": (2 * SIDE, EMBEDDING, HIDDEN), "b": (HIDDEN,), "C": (HIDDEN, CLASSES),
          "c": (CLASSES,), "D": (CLASSES, HIDDEN, WIDTH), "d": (CLASSES, WIDTH)}
OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


def _sums(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, values, n).astype(np.float64)  # whole numbers where there are no values


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = (x >> 1) ^ (x & 1) * np.uint32(0xEDB88320)
    return x


CRC = _crc_table()


def crc32(words: pa.Array) -> np.ndarray:
    """``zlib.crc32`` of each word: of all words at a time byte after byte, of those over ``SHORT`` bytes one by one."""
    words = words.cast(pa.binary())
    if not len(words):
        return np.empty(0, np.uint32)
    _, cuts, data = words.buffers()
    cuts = np.frombuffer(cuts, np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    size = np.minimum(np.diff(cuts), SHORT + 1)
    order = np.argsort(-size.astype(np.int8), kind="stable")  # the longest first
    longer = np.searchsorted(-size[order], -np.arange(SHORT + 1))  # words of more than 0, 1, ... bytes
    at, found = cuts[:-1][order], np.full(len(words), 0xFFFFFFFF, np.uint32)
    for i, n in enumerate(longer[:SHORT]):
        found[:n] = CRC[(found[:n] ^ data[at[:n] + i]) & 0xFF] ^ (found[:n] >> 8)
    out = np.empty_like(found)
    out[order] = ~found
    for i in order[:longer[SHORT]]:
        out[i] = zlib.crc32(data[cuts[i]:cuts[i + 1]])
    return out


class Vocabulary(dict):
    """Word (bytes) to id; rare words get hashed ids as they come."""

    def __init__(self, words: list[str]):
        super().__init__()
        self.words = words
        self._fill()

    def _fill(self) -> None:
        self.update((w.encode(), i) for i, w in enumerate(self.words))

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_LIMIT:
            self.clear()
            self._fill()
        self[word] = i = WORDS + zlib.crc32(word) % RARE
        return i

    def __reduce__(self):
        return Vocabulary, (self.words,)

    def ids(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def split(self, texts) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """The different words, their ids, which of them all texts hold, and where each text begins and the last
        ends."""
        words, cuts = split_words(texts if isinstance(texts, pa.Array) else pa.array(
            [(t if isinstance(t, str) else "").encode("utf-8", "replace") for t in texts], pa.string()))
        words = words.dictionary_encode()
        kinds = words.dictionary
        at = pc.index_in(kinds, pa.array(self.words, pa.string()))
        ids = at.fill_null(0).to_numpy().copy()
        ids[at.is_null().to_numpy(zero_copy_only=False)] = WORDS + crc32(kinds.filter(pc.is_null(at))) % RARE
        return kinds, ids, words.indices.to_numpy(), cuts

    def number(self, texts, often: pa.Array, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """The ids of the texts' words, where each text begins and the last ends, the summed ``parts`` of its ``often``
        words, and its other words that share an id."""
        kinds, ids, number, cuts = self.split(texts)
        row = np.repeat(np.arange(len(texts)), np.diff(cuts))
        of = pc.index_in(kinds, often).fill_null(len(often)).to_numpy()
        within = _sums(row, np.append(parts, 0)[of][number], len(texts))
        seldom = ((ids >= WORDS) & (of == len(often)))[number]
        before = np.concatenate(([0], np.cumsum(seldom)))[cuts]
        lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), kinds.take(pa.array(number[seldom])))
        return ids[number], cuts, within, [r or None for r in pc.binary_join(lists, " ").to_pylist()]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII white space, A-Z lowered, and where each text begins and the last ends."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, cuts = split.flatten(), split.offsets.to_numpy()
    full = pc.not_equal(words, "")  # white space at a text's ends gives empty ones
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    return words.filter(full), before[cuts - cuts[0]]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents."""

    def count(batches):
        keep_freed_memory()
        for batch in batches:
            texts = batch.column(0)
            for a, b in portions(pc.binary_length(texts).to_pylist(), COUNTED):
                found = split_words(texts.slice(a, b - a))[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    words = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def bucket() -> Column:
    """Which of the shared ids a rare word has, as in ``Vocabulary``."""
    return F.pmod(F.crc32(F.encode("word", "utf-8")), F.lit(RARE)).cast("int")


def rare_counts(counts: DataFrame, words: list[str]) -> DataFrame:
    """(word, n) of the words that share an id."""
    top = counts.sparkSession.createDataFrame([(w,) for w in words], "word string")
    return counts.join(F.broadcast(top), "word", "left_anti")


def shared_counts(rare: DataFrame) -> pd.DataFrame:
    """Of the words that share an id, by id and level of their counts: the sum of the counts, the words, the least
    count."""
    level = F.floor(F.log2("n") * 8)
    return rare.groupBy(bucket().alias("bucket"), level.alias("level")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).toPandas()


def often_and_seldom(rare: DataFrame, sums: pd.DataFrame) -> tuple[pa.Array, np.ndarray, DataFrame, Column]:
    """Of the words that share an id: the most frequent, at most ``OFTEN``, and the logs of their parts of their ids;
    the counts of the others; and the whole of each id. ``sums`` are their ``shared_counts``."""
    whole = np.ones(RARE)
    np.add.at(whole, sums["bucket"].to_numpy(np.int64), (sums["n"] + sums["words"]).to_numpy(np.float64))
    by_level = sums.groupby("level").agg({"words": "sum", "least": "min"}).sort_index(ascending=False)
    fits = by_level["least"][by_level["words"].cumsum() <= OFTEN]
    least = int(fits.iloc[-1]) if len(fits) else 1 << 62
    found = rare.where(F.col("n") >= least).select("word", "n").toPandas()
    often = pa.array(found["word"].tolist(), pa.string())
    parts = np.log((found["n"].to_numpy(np.float64) + 1) / whole[crc32(often) % RARE])
    return often, parts, rare.where(F.col("n") < least), F.array(*[F.lit(float(x)) for x in whole])


def numbered(docs: DataFrame, vocabulary: Vocabulary, often: pa.Array, parts: np.ndarray) -> DataFrame:
    """For each row, with its columns but ``text``: row, n_words, ids (16 bits each), often, rare as ``Vocabulary.number``
    gives them."""
    own = [c for c in docs.columns if c != "text"]

    def number(batches):
        keep_freed_memory()
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            for a, b in portions(pc.binary_length(texts).to_pylist(), PORTION):
                ids, cuts, within, rare = vocabulary.number(texts.slice(a, b - a), often, parts)
                found = pa.BinaryArray.from_buffers(pa.binary(), b - a, [
                    None, pa.py_buffer((2 * cuts).astype(np.int32)), pa.py_buffer(ids.astype(np.int16))])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in own), pa.array(np.diff(cuts), pa.int64()), found,
                     pa.array(within), pa.array(rare, pa.string())], [*own, "n_words", "ids", "often", "rare"])

    schema = T.StructType([docs.schema[c] for c in own])
    for name, kind in (("n_words", T.LongType()), ("ids", T.BinaryType()), ("often", T.DoubleType()), ("rare", T.StringType())):
        schema = schema.add(name, kind)
    found = docs.select(*own, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(number, schema)
    return written(found.select(F.monotonically_increasing_id().alias("row"), "*"), "numbered")


def _numbers(ids: pa.Array):
    """(ids, where each document begins and the last ends) of portions of the documents in a column of ``numbered``."""
    ids = ids.cast(pa.binary())
    for a, b in portions((pc.binary_length(ids).to_numpy() // 2).tolist(), TOGETHER):
        some = ids.slice(a, b - a)
        _, cuts, data = some.buffers()
        cuts = np.frombuffer(cuts, np.int32)[some.offset:some.offset + b - a + 1]
        found = np.frombuffer(data or b"", np.uint8)[cuts[0]:cuts[-1]].view(np.int16)
        yield found.astype(np.int32), (cuts - cuts[0]) // 2


def within_buckets(rows: DataFrame, seldom: DataFrame, whole: Column) -> DataFrame:
    """(row, within): summed log of each seldom word's part of its id, for ``rows`` (row, rare: words between spaces)."""
    words = rows.select("row", F.explode(F.split("rare", " ")).alias("word")).join(seldom, "word", "left")
    part = F.log((F.coalesce("n", F.lit(0)) + 1) / F.get(whole, bucket()))
    return words.select("row", part.alias("part")).groupBy("row").agg(F.sum("part").alias("within"))


def initial(counts: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Random weights; the biases hold the corpus frequencies, so training starts from the unigram model."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.normal(0, 0.1, s) * (k not in "bcd")).astype(np.float32) for k, s in SHAPES.items()}
    n = counts.reshape(CLASSES, WIDTH) + 0.5
    p["c"] = np.log(n.sum(1) / n.sum()).astype(np.float32)
    p["d"] = np.log(n / n.sum(1, keepdims=True)).astype(np.float32)
    p["E"][IDS] = 0
    return p


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The network's arrays, one after another in ``flat``."""
    cuts = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
    return {k: x.reshape(s) for (k, s), x in zip(SHAPES.items(), np.split(flat, cuts), strict=True)}


def _by_target(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by target, and (class, from, to) in that order of each class that occurs."""
    order = np.argsort(target.astype(np.int16), kind="stable")  # 16 bits: sorted by digits
    cuts = np.searchsorted(target[order], WIDTH * np.arange(CLASSES + 1)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]


def _with_biases(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """C and D with the biases as weights of one more input, which is 1."""
    return np.concatenate((p["C"], p["c"][None])), np.concatenate((p["D"], p["d"][:, None]), 1)


def _bounded(weights: np.ndarray) -> bool:
    """Whether no logit of hidden values from -1 to 1 is so large that its exponential in 32 bits is 0 or infinite."""
    return bool(np.abs(weights).sum(-2).max() < 80)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _exp(x: np.ndarray, bounded: bool) -> np.ndarray:
    """Turns logits into their exponentials, up to a factor of each row; the rows' sums."""
    if not bounded:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _logits(p: dict, context: np.ndarray, tops: np.ndarray, lows: np.ndarray, classes: list[tuple[int, int, int]]):
    """The windows' embeddings side by side, the hidden values (and a 1), the logits of the classes and of the ids in
    the target's class, for targets in the order of their classes."""
    n = len(context)
    around = p["E"].take(context.ravel(), axis=0).reshape(n, -1)
    h = np.ones((n, HIDDEN + 1), around.dtype)
    z = around @ p["W"].reshape(-1, HIDDEN)
    z += p["b"]
    np.tanh(z, out=h[:, :HIDDEN])
    low = np.empty((n, WIDTH), h.dtype)
    for k, a, b in classes:
        np.matmul(h[a:b], lows[k], out=low[a:b])
    return around, h, h @ tops, low


def _summed(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the ``rows`` of each id."""
    out = np.zeros((IDS + 1, rows.shape[1]), rows.dtype)
    order = np.argsort(ids.astype(np.int16), kind="stable")  # 16 bits: sorted by digits
    of = ids[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    out[of[first]] = np.add.reduceat(rows.take(order, axis=0), first, axis=0)
    return out


def step(p: dict, context: np.ndarray, target: np.ndarray) -> dict:
    """Gradients of the mean negative log-probability of ``target`` (n) given ``context`` (n, 2 SIDE)."""
    n, kind = len(target), p["E"].dtype
    order, classes = _by_target(target)
    context, target = context[order], target[order]
    tops, lows = _with_biases(p)
    around, h, top, low = _logits(p, context, tops, lows, classes)
    rows = np.arange(n)
    for x, at, weights in ((top, target // WIDTH, tops), (low, target % WIDTH, lows)):
        x *= (1 / (_exp(x, _bounded(weights)) * kind.type(n)))[:, None]
        x[rows, at] -= kind.type(1 / n)
    g = _views(np.zeros(sum(int(np.prod(s)) for s in SHAPES.values()), np.float32))
    both = h.T @ top
    g["C"][:], g["c"][:] = both[:HIDDEN], both[HIDDEN]
    dh = top @ p["C"].T
    for k, a, b in classes:
        both = h[a:b].T @ low[a:b]
        g["D"][k], g["d"][k] = both[:HIDDEN], both[HIDDEN]
        dh[a:b] += low[a:b] @ p["D"][k].T
    h = h[:, :HIDDEN]
    dz = dh
    dz *= 1 - h * h
    g["b"][:], g["W"][:] = dz.sum(0), (around.T @ dz).reshape(SHAPES["W"])
    g["E"][:] = _summed(context.ravel(), (dz @ p["W"].reshape(-1, HIDDEN).T).reshape(-1, EMBEDDING))
    return g


def _padded(ids: np.ndarray) -> np.ndarray:
    return np.concatenate((np.full(SIDE, IDS, ids.dtype), ids, np.full(SIDE, IDS, ids.dtype)))


def _apart(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts (``cuts``: where each begins and the last ends) with ``SIDE`` empty places between any two and
    at both ends, and the place of each id."""
    at = np.arange(len(ids)) + SIDE * np.repeat(np.arange(1, len(cuts)), np.diff(cuts))
    padded = np.full(len(ids) + SIDE * len(cuts), IDS, ids.dtype)
    padded[at] = ids
    return padded, at


def _trainer(start: dict, vocabulary: Vocabulary | None = None):
    """Trains on batches of ids as ``numbered`` has them, or on frames of texts with their ``vocabulary``."""

    def pieces(batch):
        if vocabulary is None:
            yield from _numbers(batch.column("ids"))
            return
        texts = [t if isinstance(t, str) else "" for t in batch.text]
        for a, b in portions(list(map(len, texts)), PORTION):
            _, ids, number, cuts = vocabulary.split(texts[a:b])
            yield ids[number], cuts

    def train(batches):
        keep_freed_memory()
        flat = np.concatenate([start[k].ravel() for k in SHAPES])
        p, m1, m2 = _views(flat), np.zeros_like(flat), np.zeros_like(flat)
        held, size, seen, t = [], 0, 0, 0

        def learn(context, target):
            nonlocal t, seen
            t += 1
            seen += len(target)
            found = step(p, context, target)
            g = np.concatenate([found[k].ravel() for k in SHAPES])
            for m, part, x in ((m1, 0.1, g), (m2, 0.01, g * g)):
                x -= m
                x *= part
                m += x
            np.divide(m2, 1 - 0.99 ** t, out=g)
            np.sqrt(g, out=g)
            g += 1e-6
            np.divide(m1, g, out=g)
            g *= RATE / (1 - 0.9 ** t)
            np.subtract(flat, g, out=flat)

        def contexts(ids, cuts):
            padded, at = _apart(ids, cuts)
            a = 0
            while a < len(at):  # up to the end of a batch
                some = at[a:a + BATCH - size]
                a += len(some)
                yield padded[some[:, None] + np.array(OFFSETS)], padded[some]

        for batch in batches:
            for ids, cuts in pieces(batch):
                for some in contexts(ids, cuts):
                    held.append(some)
                    size += len(some[1])
                    if size == BATCH:
                        learn(*(np.concatenate(x) for x in zip(*held, strict=True)))
                        held, size = [], 0
        if size:
            learn(*(np.concatenate(x) for x in zip(*held, strict=True)))
        if seen:
            yield pd.DataFrame({"i": np.arange(len(flat)), "v": flat.astype(np.float64) * seen, "n": float(seen)})

    return train


def prepared(counts: DataFrame) -> tuple[Vocabulary, dict, DataFrame, pd.DataFrame]:
    """The vocabulary, the network before training, the counts of the words that share an id and their
    ``shared_counts``."""
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    words = [r["word"] for r in top]
    rare = rare_counts(counts, words)
    sums = shared_counts(rare)
    n = np.zeros(IDS)
    n[:len(words)] = [r["n"] for r in top]
    np.add.at(n, WORDS + sums["bucket"].to_numpy(np.int64), sums["n"].to_numpy(np.float64))
    return Vocabulary(words), initial(n), rare, sums


def fitted(rows: DataFrame, start: dict) -> dict:
    """The network averaged over all tasks, for rows that are ``numbered``."""
    learn = _trainer(start)

    def train(batches):
        for found in learn(batches):
            yield pa.RecordBatch.from_pandas(found, pa.schema([("i", pa.int32()), ("v", pa.float64()), ("n", pa.float64())]))

    parts = rows.select("ids").mapInArrow(train, "i int, v double, n double")
    mean = parts.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()
    if not len(mean):
        return start
    flat = np.zeros(len(mean), np.float32)
    flat[mean["i"].to_numpy()] = mean["v"].to_numpy()
    return _views(flat)


def train(docs: DataFrame, counts: DataFrame | None = None) -> tuple[dict, Vocabulary]:
    """The network averaged over all tasks, and the vocabulary."""
    counts = written(count_words(docs), "word-counts") if counts is None else counts
    vocabulary, start, _, _ = prepared(counts)
    rows = numbered(docs.select("text"), vocabulary, pa.array([], pa.string()), np.empty(0))
    return fitted(rows, start), vocabulary


class Scorer:
    def __init__(self, p: dict, vocabulary: Vocabulary):
        self.p, self.vocabulary, self.outer = p, vocabulary, _with_biases(p)
        self.bounded = [_bounded(x) for x in self.outer]

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        order, classes = _by_target(padded[at])
        at = at[order]
        target, rows = padded[at], np.arange(len(at))
        _, _, top, low = _logits(self.p, padded[at[:, None] + np.array(OFFSETS)], *self.outer, classes)
        found = np.zeros(len(at))
        for x, of, bounded in zip((top, low), (target // WIDTH, target % WIDTH), self.bounded, strict=True):
            if bounded:
                own = x[rows, of]
                found += own - np.log(_exp(x, bounded))
            else:
                found += _log_softmax(x)[rows, of]
        out = np.empty(len(at))
        out[order] = found
        return out

    def totals(self, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The summed log-probability of each document's ids (``cuts``: where each begins and the last ends)."""
        padded, at = _apart(ids, cuts)
        order = np.argsort(ids.astype(np.int16), kind="stable")  # few classes in a block
        found = np.empty(len(ids))
        for a in range(0, len(ids), BLOCK):
            some = order[a:a + BLOCK]
            found[some] = self.log_probabilities(padded, at[some])
        return _sums(np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), found, len(cuts) - 1)

    def score(self, texts, often: pa.Array | None = None, parts: np.ndarray | None = None):
        """(words, summed log-probability of their ids, what words that share an id add) of each text; the last are the
        summed ``parts`` of the ``often`` words, and the others themselves."""
        often, parts = pa.array([], pa.string()) if often is None else often, np.empty(0) if parts is None else parts
        n, total, within, rare = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts)), []
        texts = [t if isinstance(t, str) else "" for t in texts]
        for a, b in portions(list(map(len, texts)), PORTION):
            ids, cuts, within[a:b], some = self.vocabulary.number(texts[a:b], often, parts)
            n[a:b], total[a:b] = np.diff(cuts), self.totals(ids, cuts)
            rare += some
        return n, total, (within, rare)


def scores(rows: DataFrame, scorer: Scorer, seldom: DataFrame, whole: Column) -> DataFrame:
    """The result for rows that are ``numbered``."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep_freed_memory()
        for ids in batches:
            found = [scorer.totals(*some) for some in _numbers(pa.array(ids, pa.binary()))]
            yield pd.Series(np.concatenate(found) if found else np.empty(0))

    found = rows.select("row", "doc_id", "n_words", score("ids").alias("log_prob"), "often")
    found = found.join(within_buckets(rows, seldom, whole), "row", "left").drop("row")
    found = found.withColumn("word_log_prob", F.col("log_prob") + F.col("often") + F.coalesce("within", F.lit(0.0)))
    return found.drop("often", "within").withColumn("mean_log_prob", F.expr("try_divide(word_log_prob, n_words)"))


def scored(docs: DataFrame, scorer: Scorer, rare: DataFrame) -> DataFrame:
    """The result for ``docs``; ``rare`` has the counts of the words that share an id."""
    often, parts, seldom, whole = often_and_seldom(rare, shared_counts(rare))
    return scores(numbered(docs.select("doc_id", "text"), scorer.vocabulary, often, parts), scorer, seldom, whole)


def language_model(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_prob (summed over ids), word_log_prob (summed over words), mean_log_prob (a word)."""
    vocabulary, start, rare, sums = prepared(written(count_words(docs), "word-counts"))
    often, parts, seldom, whole = often_and_seldom(rare, sums)
    rows = numbered(docs.select("doc_id", "text"), vocabulary, often, parts)
    return scores(rows, Scorer(fitted(rows, start), vocabulary), seldom, whole)


def query(spark, sf_dir: str) -> DataFrame:
    return language_model(table(spark, sf_dir, "documents"))
