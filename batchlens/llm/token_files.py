"""Token ids in Re-Pair grammar-compressed files with random access.

Documents are dealt to shards by ranges of doc_id, encoded by the tokenizer,
and each file gets a grammar of its own: rounds of counting adjacent id pairs
and replacing the most frequent ones by nonterminals (Larsson and Moffat's
Re-Pair, up to ``PAIRS`` pairs a round) until no pair is used ``LEAST_USES`` times. No rule spans two documents, so an index of
first symbols and the rules' expansion lengths decode any document, or any
place of one, without the rest of the file.

A text's encoding is the concatenation of the encodings of its chunks between
blanks (the tokenizer drops white space and no token of it crosses white
space), so the different chunks of a portion of texts are encoded once each, and
each worker keeps the ids of up to ``CACHE`` of them. Words of small Latin-1
letters go through the tokenizer's model without the steps that leave such words
as they are; marks after a word are tokens of their own.

Files are committed by rename and listed in a manifest. Defined results: NULL
text has only the end id; rows that repeat a doc_id follow one another, by
text; NULL doc_id comes first; an empty table gives no files and an empty
result. A file holds at most about ``FILE_TOKENS`` ids, so neither many rows
with one key nor long texts gather in memory.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import string
import struct
import sys
import types
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.common import portions, table, work_path
from batchlens.llm.shards import RenamedFile, file_system, ranges, shard_of

END = 1
SHARD_BYTES = 8 << 20  #: text bytes of a shard
FILE_TOKENS = 4 << 20
PORTION = 8 << 20  #: characters of texts encoded together
CACHE = 400_000  #: words and chunks kept, besides those of the last portion
PAIRS, LEAST_USES = 4096, 12
SLOT_BITS = 18
GROUP = 1000  #: shards whose files are summed up together
MOST_TASKS = 20_000  #: that read the files back
MAGIC = b"RPAIR001"
HEADER = "<8s5q"  # magic, documents, terminals, rules, symbols, bytes of a symbol
MANIFEST = "shard int, part int, file string, documents long, tokens long, symbols long, bytes long, sha1 string"
SHORT = 64  #: ids of a rule that is expanded once for all its uses in a file
LETTERS = "".join(filter(str.islower, map(chr, range(256))))  #: a run of them is one piece to the tokenizer, as it is
MARKS = string.punctuation


def _runs(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``values[first[i]:first[i] + size[i]]``, one after another."""
    ends = np.cumsum(size)
    return values[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core's work
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.terminals = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.terminals, bool)  # ids that end a piece
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        # chunks, or words and the marks after them, and their ids one after another
        self.known, self.ids, self.sizes = pa.array([""]), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    @staticmethod
    def of(path: str) -> Encoder:
        """The one of this Python worker, which lives as long as the worker does."""
        kept = sys.modules.setdefault("_token_file_encoders", types.ModuleType("_token_file_encoders"))
        if not hasattr(kept, "encoders"):
            kept.encoders = {}
        if path not in kept.encoders:
            kept.encoders[path] = Encoder(path)
        return kept.encoders[path]

    def _learn(self, parts: pa.Array) -> None:
        """Encode parts that are not known."""
        word = pc.match_substring_regex(parts, f"^[{LETTERS}]+$")
        words, others = parts.filter(word), parts.filter(pc.invert(word)).to_pylist()
        if len(words):
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
            (done,) = self.words.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(done.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(words):
                self._keep(words, ids, np.diff(cuts, prepend=0))
            else:  # not a tokenizer that marks the ends of words
                others += words.to_pylist()
        if others:
            done = self.tokenizer.encode(others, is_pretokenized=True, add_special_tokens=False)
            self._keep(pa.array(others), np.array(done.ids, "<u4"),
                       np.bincount(np.array(done.word_ids, np.int64), minlength=len(others)))

    def _keep(self, parts: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, parts])
        self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))

    def encode(self, texts: list[str]) -> list[bytes]:
        # lowered where the tokenizer does just that: fewer kinds of chunks
        plain = pa.array([(t.lower() if _latin(t) else t).replace("\n", " ") for t in texts], pa.string())
        split = pc.split_pattern(plain, " ")
        chunks = split.flatten().dictionary_encode()
        kinds, number = chunks.dictionary, chunks.indices.to_numpy()
        # a word with marks after it is two parts, any other chunk is one
        word = pc.ascii_rtrim(kinds, MARKS)
        two = pc.and_(pc.not_equal(word, kinds), pc.match_substring_regex(word, f"^[{LETTERS}]+$"))
        marks = pc.if_else(two, pc.utf8_ltrim(kinds, LETTERS), "")
        parts = pa.concat_arrays([pc.if_else(two, word, kinds), marks]).dictionary_encode()
        at = pc.index_in(parts.dictionary, self.known)
        if at.null_count:
            new = parts.dictionary.filter(pc.is_null(at))
            self._learn(new)
            at = pc.index_in(parts.dictionary, self.known)
        at = at.to_numpy()
        first = np.cumsum(self.sizes) - self.sizes
        of = at[parts.indices.to_numpy()].reshape(2, -1).T.ravel()  # the two parts of each kind
        ids = _runs(self.ids, first[of], self.sizes[of])
        size = self.sizes[of].reshape(-1, 2).sum(1)
        if len(self.known) > CACHE:
            self.ids, self.sizes, self.known = _runs(self.ids, first[at], self.sizes[at]), self.sizes[at], parts.dictionary
        first = np.cumsum(size) - size
        found = size[number]
        data = _runs(ids, first[number], found).tobytes()
        cuts = (4 * np.concatenate(([0], np.cumsum(found)))[split.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _latin(text: str) -> bool:
    """Latin-1, whose characters have no other normal form and one lower-case letter each."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def _frequent(pair: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(kinds, places, kind of each place) of up to ``PAIRS`` frequent pairs, and the places whose pair is too rare.

    Pairs are counted by hash slots, other ones each ``turn``; each of the fullest slots stands for the pair that comes
    first in it, whose own uses are then counted exactly. A pair that shares a slot with another waits a round."""
    bits = min(SLOT_BITS, len(pair).bit_length() + 1)
    factor = np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) & 0xFFFFFFFFFFFFFFFF)
    slot = pair.view(np.uint64) * factor
    slot >>= np.uint64(64 - bits)
    slot = slot.view(np.int64)
    uses = np.bincount(slot, minlength=1 << bits)
    full = np.flatnonzero(uses >= LEAST_USES)
    taken = full
    if len(full) > 2 * PAIRS:
        taken = full[np.argpartition(-uses[full], 2 * PAIRS)[:2 * PAIRS]]
    rank = np.full(1 << bits, -2, np.int32)  # -2: too few uses
    rank[full] = -1
    rank[taken] = np.arange(len(taken))
    which = rank[slot]
    rare = which == -2
    places = np.flatnonzero(which >= 0)
    which = which[places]
    found = pair[places]
    kinds = np.zeros(len(taken), np.int64)
    kinds[which[::-1]] = found[::-1]  # the first of each slot
    own = found == kinds[which]
    places, which = places[own], which[own]
    count = np.bincount(which, minlength=len(taken))
    best = np.lexsort((kinds, -count))[:PAIRS]
    best = best[count[best] >= LEAST_USES]
    order = np.full(len(taken), -1, np.int32)
    order[best] = np.arange(len(best))
    rare[places[count[which] < LEAST_USES]] = True
    which = order[which]
    chosen = which >= 0
    return kinds[best], places[chosen], which[chosen], rare


def repair(ids: np.ndarray, last: np.ndarray, terminals: int):
    """(symbols, last, rules): rule r is (left, right), its symbol ``terminals + r``.

    ``last`` marks a document's last id; pairs that begin there are not replaced. Rounds go on until no pair is used
    ``LEAST_USES`` times, or until what a round replaces is less than its rules take.

    All uses of a pair arise in one round, that of its newer symbol, and then only grow fewer. So pairs are counted only
    beside a new symbol or where they were not too few in the round before.
    """
    seq, rules = ids.astype(np.int32), []
    after, before = np.arange(1, len(seq) + 1, dtype=np.int32), np.arange(-1, len(seq) - 1, dtype=np.int32)
    ends = last.copy()
    ends[-1:] = True
    after[ends] = -1
    before[1:][ends[:-1]] = -1
    gone, counted = np.zeros(len(seq), bool), ~ends
    for turn in itertools.count():
        live = np.flatnonzero(counted)
        if not len(live):
            break
        pair = seq[live].astype(np.int64)
        pair <<= 32
        pair |= seq[after[live]]
        kinds, at, which, rare = _frequent(pair, turn)
        counted[live[rare]] = False
        if not len(kinds):
            continue
        at = live[at]
        # of pairs that overlap, every second one from the left
        place = np.arange(len(at), dtype=np.int32)
        first = place.copy()
        first[1:][at[1:] == after[at[:-1]]] = 0
        free = (place - np.maximum.accumulate(first)) & 1 == 0
        at, which = at[free], which[free]
        # what overlaps left too few uses of is no rule
        worth = np.bincount(which, minlength=len(kinds)) >= LEAST_USES // 2
        if not worth.any():
            break
        number = np.cumsum(worth) - 1
        kept = worth[which]
        at, which = at[kept], number[which[kept]]
        seq[at] = terminals + len(rules) + which
        rules += [(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in kinds[worth]]
        right = after[at]
        beyond = after[right]
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        gone[right], counted[right] = True, False
        counted[at] = inner
        left = before[at]
        counted[left[left >= 0]] = True
    keep = ~gone
    return seq[keep], after[keep] < 0, np.array(rules, np.int64).reshape(-1, 2)


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    out = [1] * terminals
    for a, b in rules.tolist():
        out.append(out[a] + out[b])
    return np.array(out, np.int64)


def _level(symbols: np.ndarray, inner: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """``symbols`` with both sides of the ``inner`` ones in their place."""
    out = np.repeat(symbols, 1 + inner)
    at = np.flatnonzero(inner) + np.arange(inner.sum())
    out[at], out[at + 1] = rules[symbols[inner] - terminals].T
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids of a run of symbols, one level of the grammar at a time."""
    while len(symbols) and symbols.max() >= terminals:
        symbols = _level(symbols, symbols >= terminals, rules, terminals)
    return symbols


def pack(doc_ids: list[int | None], documents: list[bytes], terminals: int) -> bytes:
    """A file: header, document index, rules with expansion lengths, symbols."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    ends = np.cumsum([len(d) // 4 for d in documents])
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    symbols, last, rules = repair(ids, last, terminals)
    lengths = expansion_lengths(rules, terminals)[terminals:]
    width = 3 if terminals + len(rules) < 1 << 24 else 4
    index = [np.array([0 if d is None else d for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], "u1"),
             np.concatenate(([0], np.flatnonzero(last) + 1)).astype("<i8"),
             np.concatenate(([0], ends)).astype("<i8"), rules.astype("<u4"), lengths.astype("<u4"),
             symbols.astype("<u4").view("u1").reshape(-1, 4)[:, :width]]
    head = struct.pack(HEADER, MAGIC, len(documents), terminals, len(rules), len(symbols), width)
    return head + b"".join(np.ascontiguousarray(x).tobytes() for x in index)


class TokenFile:
    """Random access to a file's documents."""

    def __init__(self, data: bytes):
        magic, n, self.terminals, r, s, width = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEADER)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", n), take("u1", n)
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, null, strict=True)]
        self.first_symbol, self.first_token = take("<i8", n + 1), take("<i8", n + 1)
        self.rules, self.lengths = take("<u4", 2 * r).reshape(-1, 2).astype(np.int64), take("<u4", r)
        packed = np.zeros((s, 4), "u1")
        packed[:, :width] = take("u1", s * width).reshape(-1, width)
        self.symbols = packed.view("<u4").ravel().astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        part = self.symbols[self.first_symbol[i]:self.first_symbol[i + 1]]
        return expand(part, self.rules, self.terminals).astype("<u4")

    def token(self, i: int, place: int) -> int:
        """One id of a document: whole symbols before it are skipped by their expansion lengths."""
        part = self.symbols[self.first_symbol[i]:self.first_symbol[i + 1]]
        sizes = np.ones(len(part), np.int64)
        inner = part >= self.terminals
        sizes[inner] = self.lengths[part[inner] - self.terminals]
        ends = np.cumsum(sizes)
        k = int(np.searchsorted(ends, place, side="right"))
        place -= int(ends[k] - sizes[k])
        symbol = int(part[k])
        while symbol >= self.terminals:
            left, right = self.rules[symbol - self.terminals]
            size = 1 if left < self.terminals else int(self.lengths[left - self.terminals])
            symbol, place = (int(left), place) if place < size else (int(right), place - size)
        return symbol

    def all(self) -> np.ndarray:
        """Ids of all documents: longer rules by levels, down to those of ``SHORT`` ids, which are expanded once."""
        symbols, terminals = self.symbols, self.terminals
        short = np.flatnonzero(self.lengths <= SHORT)
        sizes = self.lengths[short].astype(np.int64)
        ids = np.concatenate((np.arange(terminals), expand(terminals + short, self.rules, terminals))).astype("<u4")
        first, size = np.arange(terminals + len(self.rules)), np.ones(terminals + len(self.rules), np.int64)
        first[terminals + short], size[terminals + short] = terminals + np.cumsum(sizes) - sizes, sizes
        long = np.zeros(terminals + len(self.rules), bool)
        long[terminals:] = self.lengths > SHORT
        while (inner := long[symbols]).any():
            symbols = _level(symbols, inner, self.rules, terminals)
        size = size[symbols]
        ends = np.cumsum(size)
        return ids[np.repeat(first[symbols] - (ends - size), size) + np.arange(size.sum())]


def write(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Write the files; the manifest, as committed below ``folder``/manifest."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = ranges(docs, "doc_id", F.octet_length("text"), SHARD_BYTES)
    dealt = (docs.withColumn("shard", shard_of(F.col("doc_id"), bounds))
             .repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "text")
             .select("shard", F.col("doc_id").cast("string").alias("doc_id"), "text"))

    def save(batches):
        encoder = Encoder.of(tokenizer)
        end = np.array([END], "<u4").tobytes()
        shard, part, ids, held, size = None, 0, [], [], 0

        def close():
            data = pack(ids, held, encoder.terminals)
            name = f"part-{shard:06d}-{part:05d}.rpair"
            out = RenamedFile(folder, name)
            out.write(data)
            out.commit()
            symbols = struct.unpack_from(HEADER, data)[4]
            return pd.DataFrame([(shard, part, name, len(ids), size, symbols, len(data),
                                  hashlib.sha1(data).hexdigest())],
                                columns=["shard", "part", "file", "documents", "tokens", "symbols", "bytes", "sha1"])

        for pdf in batches:
            for first, to in portions(list(map(len, pdf.text)), PORTION):
                few = pdf.iloc[first:to]
                for s, d, b in zip(few.shard, few.doc_id, encoder.encode(list(few.text)), strict=True):
                    if held and (s != shard or size >= FILE_TOKENS):
                        yield close()
                        part = part + 1 if s == shard else 0
                        ids, held, size = [], [], 0
                    shard = s
                    ids.append(int(d) if isinstance(d, str) else None)
                    held.append(b + end)
                    size += len(b) // 4 + 1
        if held:
            yield close()

    dealt.mapInPandas(save, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def starts(manifest: DataFrame) -> DataFrame:
    """(file, base): the ids before each file. Sums over groups of shards, then within them: no list of all files is
    in one place, only one row for each ``GROUP`` shards."""
    rows = manifest.select("file", "part", "shard", "tokens", F.floor(F.col("shard") / GROUP).alias("group"))

    def before(size: str, *order: str, by: tuple = ()):
        over = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(over), F.lit(0))

    groups = rows.groupBy("group").agg(F.sum("tokens").alias("total"))
    groups = groups.select(F.col("group").alias("g"), before("total", "group").alias("first"))
    rows = rows.withColumn("own", before("tokens", "shard", "part", by=("group",)))
    return rows.join(groups, F.col("group") == F.col("g")).select("file", (F.col("first") + F.col("own")).alias("base"))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    files = starts(manifest)

    def load(batches):
        for pdf in batches:
            for name, before in zip(pdf.file, pdf.base, strict=True):
                fs, path = file_system(folder)
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    f = TokenFile(stream.read())
                ids, cuts = f.all(), f.first_token
                if len(ids) != cuts[-1]:
                    raise ValueError(f"{name} decodes to {len(ids)} ids, its index has {cuts[-1]}")
                yield pd.DataFrame({
                    "doc_id": [None if d is None else str(d) for d in f.doc_ids], "start": before + cuts[:-1],
                    "n_tokens": np.diff(cuts),
                    "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})

    found = files.repartition(min(max(manifest.count(), 1), MOST_TASKS), "file").mapInPandas(
        load, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = work_path(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    return read(write(table(spark, sf_dir, "documents"), folder, str(path)), folder)
