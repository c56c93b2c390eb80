"""N-gram Jaccard self-join by parity sketches, and the groups it links.

A document is its set of distinct word shingles. Similar sets have similar
sizes, and their symmetric difference is at most
d = (a + b) (1 - t) / (1 + t) for Jaccard similarity t. Every set is sketched
for its size band: each shingle flips one bit of a sketch of C chunks, so the
chunks in which two sketches differ are no more than the symmetric difference.
With C = d + 1 + spare, linked sets have more than ``spare`` chunks in common
(pigeonhole). Chunks with fewer than ``least`` bits set say little and are
not filed, unless more than ``spare`` chunks of a set are like that; equal
chunks are so in both sets, so no link is lost.

Steps: (1) File (key of a chunk's parity, node) entries; equal sets are one
node. Entries travel as packed arrays; what repeats within a task is known to be
shared, and one entry of each key meets those of other tasks. (2) Nodes that
share a key are compared by their whole sketches (the Hamming distance is a
lower bound of the symmetric difference), keys with the same nodes once, large
groups in blocks; what is close enough comes back as a forest, not as pairs.
The components of these forests are the candidate clusters: every link lies
within one. (3) Clusters are verified on the whole shingle sets, in tiles of at
most about ``TILE`` shingles a side. In a tile a prefix filter finds whom to
compare, what is in one component already is skipped, and again a forest comes
back. (4) The components of these forests are the groups.

So neither a group of copies nor a common shingle makes all pairs of rows
anywhere, and no task holds more than two blocks. Sets are of 64-bit hashes.

Defined results: NULL text and text without words have no shingles and link
with nothing; fewer than ``k`` words are one shingle, the whole sequence; rows
that repeat are linked; a component's id is its smallest doc_id that is not
NULL; an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil, exp, factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import broadcast_if_small, row_key, table, written
from batchlens.llm.components import components, roots

BAND = 1.3  #: ratio of a band's sizes
LEAST_BITS = 4  #: bits that a chunk needs to be filed, where the band's chunks are large enough
GROUP = 2048  #: nodes of a key that are compared in one block
BUCKET_DOCS = 2000  #: documents whose entries fill a bucket of keys
HELD = 500_000  #: entries that a task packs at once
FEW = 250  #: texts that a task hashes at once
TILE = 1 << 20  #: shingles
POSITION_BITS = 24  #: of a chunk: so many that unrelated shingles seldom share one, however few a chunk has
PAIRS = 2000  #: pairs of sketches that are compared at once
SLICE = 1 << 20  #: bytes of text held as arrays at once
BROADCAST_ROWS = 1_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word between ASCII white space."""
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), start
    power = np.full(int((end - start).max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, end - start)
    term = (b[at].astype(np.uint64) + np.uint64(1)) * power[place]
    first = np.cumsum(end - start) - (end - start)
    return mix(np.add.reduceat(term, first) + (end - start).astype(np.uint64)), start


def _pieces(data: bytes):
    """A long text cut between words."""
    at = 0
    while len(data) - at > SLICE:
        cut = at + SLICE
        while cut < len(data) and not _SPACE[data[cut]]:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def word_hashes(texts) -> list[np.ndarray]:
    """Word hashes of each text, A-Z in lower case; short texts are hashed together."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    out: list[list[np.ndarray]] = [[] for _ in data]
    held, size = [], 0

    def flush():
        start = np.cumsum([0] + [len(p) + 1 for _, p in held])
        h, at = _words(b" ".join(p for _, p in held))
        cut = np.searchsorted(at, start)
        for k, (row, _) in enumerate(held):
            out[row].append(h[cut[k]:cut[k + 1]])

    for row, d in enumerate(data):
        for p in _pieces(d):
            if held and size + len(p) > SLICE:
                flush()
                held, size = [], 0
            held.append((row, p))
            size += len(p)
    if held:
        flush()
    return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes."""
    n = min(k, len(words))
    if n == 0:
        return np.zeros(0, np.uint64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        h = mix(h * np.uint64(31) + words[j:len(words) - n + 1 + j])
    return np.unique(h)


class Sketch:
    """Parity sketches for links of 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent = percent
        self.cuts: dict[int, tuple[int, int, int]] = {}
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * BAND)))

    def chunks(self, band: int) -> tuple[int, int, int]:
        """(C, spare, least) of the band in which the larger set of a pair lies.

        ``spare`` covers the chunks that random shingles leave below ``least``
        bits, with four standard deviations to spare; ``least`` is as large as
        keeps ``spare`` small.
        """
        if band not in self.cuts:
            d = self.most(2 * (self.bounds[band + 1] - 1))
            smallest = max(1, self.bounds[band] * self.percent // 100)
            for least in range(LEAST_BITS, 0, -1):
                spare = 0
                for _ in range(20):
                    mean = smallest / (d + 1 + spare)
                    share = exp(-mean) * sum(mean ** j / factorial(j) for j in range(least))
                    light = share * (d + 1 + spare)
                    spare = max(spare, ceil(light + 4 * light ** 0.5))
                if spare <= 2 + 0.15 * (d + 1):
                    break
            else:
                least, spare = 1, 2 + (d + 1) // 8
            self.cuts[band] = d + 1 + spare, spare, least
        return self.cuts[band]

    def most(self, both: int) -> int:
        """Largest symmetric difference of linked sets with ``both`` members together."""
        return both * (100 - self.percent) // (100 + self.percent)

    def bands(self, n: int) -> list[int]:
        """Bands in which a set of ``n`` is the larger or, being similar enough, the smaller of a pair."""
        at = int(np.searchsorted(self.bounds, n, side="right")) - 1
        out = [at]
        while 100 * n >= self.percent * self.bounds[out[-1] + 1]:
            out.append(out[-1] + 1)
        return out

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The keys under which a set is filed."""
        out = []
        for band in self.bands(len(s)):
            count, spare, least = self.chunks(band)
            h = mix(s + np.uint64(band + 1))
            code = np.sort(((h % np.uint64(count)) << np.uint64(POSITION_BITS)) + (h >> np.uint64(64 - POSITION_BITS)))
            # bits flipped an odd number of times are set
            code, times = np.unique(code, return_counts=True)
            code = code[times % 2 == 1]
            chunk = code >> np.uint64(POSITION_BITS)
            filled, first, bits = np.unique(chunk, return_index=True, return_counts=True)
            parity = np.add.reduceat(mix(code + np.uint64(1)), first) if len(code) else np.zeros(0, np.uint64)
            full = bits >= least
            if count - full.sum() <= spare:
                filled, parity = filled[full], parity[full]
            else:
                empty = np.setdiff1d(np.arange(count, dtype=np.uint64), filled)
                filled, parity = np.concatenate((filled, empty)), np.concatenate((parity, np.zeros_like(empty)))
            out.append(mix(mix(parity + np.uint64(band)) + filled))
        return np.concatenate(out)


def node_of(s: np.ndarray) -> int:
    """Id of a set."""
    return int((mix(s).sum(keepdims=True) * _A + mix(s * _B).sum(keepdims=True)).astype(np.int64)[0])


def sketch_of(s: np.ndarray) -> bytes:
    """A parity sketch of 256 2^j bits, at least as many as the set has members."""
    size = 256
    while size < len(s):
        size *= 2
    return np.packbits(np.bincount((mix(s + _A) & np.uint64(size - 1)).astype(np.intp), minlength=size) % 2 == 1,
                       bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded to the length of the other."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _text(x) -> str | None:
    return x if isinstance(x, str) else None


def sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, k, n_shingles, node and sketch (NULL without shingles) of every row."""
    @F.pandas_udf("n long, node long, sketch binary")
    def describe(text: pd.Series) -> pd.DataFrame:
        rows = []
        for at in range(0, len(text), FEW):
            for w in word_hashes(map(_text, text.iloc[at:at + FEW])):
                s = shingles(w, k)
                rows.append((len(s), node_of(s), sketch_of(s)) if len(s) else (0, None, None))
        n, node, sketch = zip(*rows, strict=True) if rows else ((), (), ())
        return pd.DataFrame({"n": n, "node": pd.array(node, "Int64"), "sketch": sketch})

    return docs.select("doc_id", row_key().alias("k"), describe(F.col("text")).alias("s")).select(
        "doc_id", "k", F.col("s.n").alias("n_shingles"), F.col("s.node").alias("node"),
        F.col("s.sketch").alias("sketch"))


def one_of_each(docs: DataFrame, described: DataFrame) -> DataFrame:
    """Documents without those whose set an earlier one has."""
    first = described.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "k")).alias("r"))
    copies = described.where("node IS NOT NULL").join(first, "node").where(
        ~(F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("k") == F.col("r.k"))))
    copies = written(copies.select(F.col("doc_id").alias("id"), F.col("k").alias("rk")).distinct(), "copies")
    return docs.join(broadcast_if_small(copies, copies.count(), BROADCAST_ROWS),
                     docs["doc_id"].eqNullSafe(F.col("id")) & (F.xxhash64(docs["doc_id"], docs["text"])
                                                               == F.col("rk")), "left_anti")


def filed(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """Packed (code, node) entries of every document with shingles. A code is a key's bucket and 32 bits of it.

    ``shared`` rows hold codes that the task met more than once, the others one entry of each code of a bucket.
    """
    sketch = Sketch(percent)

    def packed(bucket: int, shared: bool, code: np.ndarray, node: np.ndarray) -> tuple:
        return bucket, shared, (code & 0xFFFFFFFF).astype("<u4").tobytes(), code.astype("<i8").tobytes() if shared \
            else b"", node.astype("<i8").tobytes()

    def flush(keys: list, nodes: list) -> pd.DataFrame:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        code = ((key % np.uint64(buckets)).astype(np.int64) << 32) | (key >> np.uint64(32)).astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, node = code[order], node[order]
        first = np.concatenate(([True], code[1:] != code[:-1]))
        again = ~first | np.concatenate((~first[1:], [False]))
        rows = []
        for i, at in enumerate(range(0, int(again.sum()), 1 << 16)):
            rows.append(packed(i % buckets, True, code[again][at:at + (1 << 16)], node[again][at:at + (1 << 16)]))
        code, node = code[first], node[first]
        cut = np.searchsorted(code >> 32, np.arange(buckets + 1))
        rows += [packed(b, False, code[cut[b]:cut[b + 1]], node[cut[b]:cut[b + 1]])
                 for b in range(buckets) if cut[b] < cut[b + 1]]
        return pd.DataFrame(rows, columns=["bucket", "shared", "low", "code", "node"])

    def file(batches):
        keys, nodes, size = [], [], 0
        for pdf in batches:
            for at in range(0, len(pdf), FEW):
                for w in word_hashes(map(_text, pdf.text.iloc[at:at + FEW])):
                    s = shingles(w, k)
                    if len(s):
                        keys.append(sketch.keys(s))
                        nodes.append(np.full(len(keys[-1]), node_of(s)))
                        size += len(keys[-1])
                if size > HELD:
                    yield flush(keys, nodes)
                    keys, nodes, size = [], [], 0
        if keys:
            yield flush(keys, nodes)

    return docs.select("text").mapInPandas(
        file, "bucket int, shared boolean, low binary, code binary, node binary")


def _repeated(batches):
    """(key, node) of the codes that more than one entry has; a partition is sorted by bucket."""
    bucket, held, size = None, [], 0
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    seen = empty

    def merged():
        code, node, out = (np.concatenate(x) for x in zip(seen, *held, strict=True))
        order = np.argsort(code, kind="stable")
        code, node, out = code[order], node[order], out[order]
        first = np.concatenate(([True], code[1:] != code[:-1]))
        again = ~first | np.concatenate((~first[1:], [False]))
        new = again & ~out
        return (code[first], node[first], again[first] | out[first]), pd.DataFrame({"key": code[new],
                                                                                    "node": node[new]})

    for pdf in batches:
        for r in pdf.itertuples(index=False):
            node = np.frombuffer(r.node, "<i8")
            if r.shared:
                yield pd.DataFrame({"key": np.frombuffer(r.code, "<i8"), "node": node})
                continue
            if held and (r.bucket != bucket or size > HELD // 4):
                seen, found = merged()
                yield found
                held, size = [], 0
            if r.bucket != bucket:
                bucket, seen = r.bucket, empty
            held.append(((np.int64(r.bucket) << 32) | np.frombuffer(r.low, "<u4").astype(np.int64), node,
                         np.zeros(len(node), bool)))
            size += len(node)
    if held:
        yield merged()[1]


def shared_entries(docs: DataFrame, k: int, percent: int, rows: int) -> DataFrame:
    """(key, node) of the keys that more than one node is filed under."""
    buckets = max(64, -(-rows // BUCKET_DOCS))
    dealt = filed(docs, k, percent, buckets).repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInPandas(_repeated, "key long, node long").distinct()


def folded(long: np.ndarray) -> np.ndarray:
    """Sketches (rows of 64-bit words) folded to half their length."""
    half = long.shape[1] // 2
    return long[:, :half] ^ long[:, half:]


def apart(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Hamming distance of each pair of sketches; of two lengths the longer is folded."""
    out = np.zeros(len(a), np.int64)
    widths = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    for wa, wb in set(map(tuple, widths.tolist())):
        at = np.flatnonzero((widths == (wa, wb)).all(1))
        for few in np.array_split(at, -(-len(at) // PAIRS)):
            x, y = (np.frombuffer(b"".join(side[i] for i in few), "<u8").reshape(len(few), -1) for side in (a, b))
            while x.shape[1] > y.shape[1]:
                x = folded(x)
            while y.shape[1] > x.shape[1]:
                y = folded(y)
            out[few] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def close(sizes: np.ndarray, sketches: list[bytes], left: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest (as positions) of the pairs of similar size whose sketches are close enough for a link: pairs of
    the first ``left`` sets with the rest, or (0) of all."""
    n = len(sizes)
    width = np.array([len(s) for s in sketches])
    of_width = {w: np.flatnonzero(width == w) for w in set(width.tolist())}
    bits = {w: np.stack([np.frombuffer(sketches[i], "<u8") for i in at]) for w, at in of_width.items()}
    root = np.arange(n)
    u, v = [], []
    for w, at in of_width.items():
        others, rows = [at], [bits[w]]
        if 2 * w in bits:  # similar sets differ by one doubling at most: fold the longer sketches
            others.append(of_width[2 * w])
            rows.append(bits[2 * w][:, :w // 8] ^ bits[2 * w][:, w // 8:])
        others, rows = np.concatenate(others), np.concatenate(rows)
        for x, i in enumerate(at):
            if left and i >= left and not (others < left).any():
                continue
            far = (others < left) != (i < left) if left else others != i
            test = np.flatnonzero(far & (root[others] != root[i])
                                  & (100 * np.minimum(sizes[others], sizes[i])
                                     >= percent * np.maximum(sizes[others], sizes[i])))
            if not len(test):
                continue
            apart = np.bitwise_count(rows[test] ^ bits[w][x]).sum(1, dtype=np.int64)
            near = others[test[apart * (100 + percent) <= (sizes[others[test]] + sizes[i]) * (100 - percent)]]
            if len(near):
                u.append(np.full(len(near), i))
                v.append(near)
                root[np.isin(root, root[near])] = root[i]
    if not u:
        return np.zeros(0, np.intp), np.zeros(0, np.intp)
    return np.concatenate(u), np.concatenate(v)


def _tiles(batches, solve):
    """Applies ``solve`` to each tile of a partition sorted by (id, a, b): rows of (node, side, payload)."""
    tile, held = None, []

    def closed():
        node = np.array([r[0] for r in held], np.int64)
        side = np.array([r[1] for r in held])
        order = np.lexsort((node, side))
        order = order[np.concatenate(([True], np.diff(node[order]) != 0))]  # a node may come twice
        left = int((side[order] == 0).sum()) if side.max() else 0
        u, v = solve([held[i][2] for i in order], left)
        return pd.DataFrame({"u": node[order][u], "v": node[order][v]})

    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if (r.id, r.a, r.b) != tile:
                if len(held) > 1:
                    yield closed()
                tile, held = (r.id, r.a, r.b), []
            held.append((r.node, r.side, (r.n, r.s)))
    if len(held) > 1:
        yield closed()


def _tiled(rows: DataFrame, solve) -> DataFrame:
    """(u, v) from rows (id, blocks, node, n, s): the rows of an id meet in tiles of two blocks."""
    own = F.pmod(F.xxhash64(F.lit(31), "node"), F.col("blocks")).cast("int")
    tiles = (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node",
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "n", "s"))
    return (tiles.repartition("id", "a", "b").sortWithinPartitions("id", "a", "b")
            .mapInPandas(lambda batches: _tiles(batches, solve), "u long, v long"))


def candidate_edges(entries: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """(u, v): nodes that share a key and are close enough by their sketches, connected."""
    groups = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"),
                                        F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("x"))
    # copies share most keys: of keys with the same nodes one is enough
    once = written(groups.where("n > 1").groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("id")), "key-groups")
    nodes = described.where("node IS NOT NULL").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.first("sketch").alias("s"))
    large = once.where("n > 2").select("id", F.ceil(F.col("n") / GROUP).cast("int").alias("blocks"))
    rows = entries.join(large, entries["key"] == large["id"]).select("id", "blocks", "node").join(nodes, "node")

    def solve(held, left):
        return close(np.array([x for x, _ in held]), [x for _, x in held], left, percent)

    @F.pandas_udf("long")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(apart(a.tolist(), b.tolist()))

    # most groups are two nodes: no tiles, all pairs of a batch at once
    two = once.where("n = 2").select("lo", "hi")
    for side in ("lo", "hi"):
        two = two.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("s").alias(f"s_{side}")), side)
    two = two.where(100 * F.least("n_lo", "n_hi") >= percent * F.greatest("n_lo", "n_hi"))
    two = two.where(distance("s_lo", "s_hi") * (100 + percent) <= (F.col("n_lo") + F.col("n_hi")) * (100 - percent))
    return two.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(_tiled(rows, solve)).distinct()


def verify(sizes: np.ndarray, flat: np.ndarray, left: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as positions) that join the same sets as all links between the first ``left`` sets and the rest do
    (``left`` 0: among all sets). ``flat`` holds the sets one after the other.

    Linked sets share one of their n - ceil(t n) + 1 rarest shingles, so only sets that do are compared.
    """
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(n), sizes)
    _, ids = np.unique(flat, return_inverse=True)
    uses = np.bincount(ids)
    order = np.lexsort((ids, uses[ids], of))  # within a set, the rarest first
    place = np.arange(len(ids)) - np.repeat(starts, sizes)
    prefix = sizes - -(-sizes * percent // 100) + 1
    head = order[place < np.repeat(prefix, sizes)]
    head = head[uses[ids[head]] > 1]
    head = head[np.argsort(ids[head], kind="stable")]
    token, member = ids[head], of[head]
    cut = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True]))) if len(token) else np.zeros(1, int)
    group = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    by_set = np.argsort(member, kind="stable")
    own_cut = np.searchsorted(member[by_set], np.arange(n + 1))
    commonness = np.add.reduceat(uses[ids], starts) / sizes  # what others are copies of comes first
    root, mark = np.arange(n), np.zeros(len(uses), bool)
    a, b = [], []
    for p in sorted(range(left or n), key=lambda i: (-commonness[i], i)):
        groups = group[by_set[own_cut[p]:own_cut[p + 1]]]
        if not len(groups):
            continue
        near = np.unique(np.concatenate([member[cut[g]:cut[g + 1]] for g in groups]))
        near = near[(near >= left) & (root[near] != root[p]) & (100 * sizes[near] >= percent * sizes[p])
                    & (percent * sizes[near] <= 100 * sizes[p])]
        if not len(near):
            continue
        own = ids[starts[p]:starts[p] + sizes[p]]
        mark[own] = True
        both = np.array([np.count_nonzero(mark[ids[starts[q]:starts[q] + sizes[q]]]) for q in near])
        mark[own] = False
        linked = near[100 * both >= percent * (sizes[near] + sizes[p] - both)]
        if len(linked):
            a.append(np.full(len(linked), p))
            b.append(linked)
            root[np.isin(root, root[linked])] = root[p]
    if not a:
        return np.zeros(0, np.intp), np.zeros(0, np.intp)
    return np.concatenate(a), np.concatenate(b)


def links(docs: DataFrame, described: DataFrame, clusters: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (u, v) that connect what all links within the clusters connect."""
    # one row of each clustered set has its text read again
    keep = (described.join(clusters, "node").groupBy("node", F.col("root").alias("cluster"))
            .agg(F.min(F.struct("doc_id", "k")).alias("r"), F.max("n_shingles").alias("n")))
    keep = written(keep.select("node", "cluster", "n", F.col("r.doc_id").alias("rid"), F.col("r.k").alias("rk")), "sets")
    sizes = keep.groupBy("cluster").agg(F.sum("n").alias("total")).where(F.col("total") > TILE)
    sizes = written(sizes.select("cluster", F.ceil(F.col("total") / TILE).cast("int").alias("blocks")), "large")
    keep = keep.join(broadcast_if_small(sizes, sizes.count(), BROADCAST_ROWS), "cluster", "left")

    @F.pandas_udf("binary")
    def build(text: pd.Series) -> pd.Series:
        return pd.Series([shingles(w, k).tobytes() for at in range(0, len(text), FEW)
                          for w in word_hashes(map(_text, text.iloc[at:at + FEW]))])

    keep = broadcast_if_small(keep, keep.count(), BROADCAST_ROWS)
    rows = docs.select("doc_id", "text", row_key().alias("k")).join(
        keep, F.col("doc_id").eqNullSafe(F.col("rid")) & (F.col("k") == F.col("rk")))
    rows = rows.select(F.col("cluster").alias("id"), F.coalesce("blocks", F.lit(1)).alias("blocks"), "node", "n",
                       build(F.col("text")).alias("s"))

    def solve(held, left):
        parts = [np.frombuffer(x, np.uint64) for _, x in held]
        return verify(np.array([len(x) for x in parts]), np.concatenate(parts), left, percent)

    return _tiled(rows, solve)


def grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, k (tells rows of one doc_id apart), n_shingles, root (of the group; NULL without shingles) of every row."""
    docs = docs.select("doc_id", "text")
    described = written(sets(docs, k), "shingle-sets")
    rows = described.count()
    entries = written(shared_entries(one_of_each(docs, described), k, percent, rows), "shared-keys")
    clusters = components(candidate_edges(entries, described, percent))
    found = components(links(docs, described, clusters, k, percent))
    group = F.coalesce("root", "node")
    return described.join(found, "node", "left").select("doc_id", "k", "n_shingles", group.alias("root"))


def parity_join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, k, n_shingles, component_id (the group's smallest doc_id) of every row."""
    rows = grouped(docs, k, percent)
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "root", "left").select(
        "doc_id", "k", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group stays, that with the smallest doc_id (NULL last), then the smallest k; the columns of
    ``docs``. Rows without shingles stay."""
    found = written(grouped(docs, k, percent).where("root IS NOT NULL").select("doc_id", "k", "root"), "groups")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")).alias("r"),
                                      F.count(F.lit(1)).alias("n")).where("n > 1")
    first = written(first.select("root", F.col("r.doc_id").alias("first_id"), F.col("r.k").alias("first_k")), "first")
    linked = found.join(broadcast_if_small(first, first.count(), BROADCAST_ROWS), "root")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("k") == F.col("first_k"))
    gone = linked.where(~is_first).select(F.col("doc_id").alias("gone_id"), F.col("k").alias("gone_k")).distinct()
    gone = broadcast_if_small(gone, gone.count(), BROADCAST_ROWS)
    key = F.xxhash64(docs["doc_id"], docs["text"])
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (key == gone["gone_k"]), "left_anti")
    again = linked.where(is_first).groupBy(F.col("doc_id").alias("one_id"), F.col("k").alias("one_k")).agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    # the row that stays, several times
    return left if again.isEmpty() else _one_each(left, written(again, "again"))


def _one_each(docs: DataFrame, again: DataFrame) -> DataFrame:
    same = docs["doc_id"].eqNullSafe(again["one_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == again["one_k"])
    first = docs.join(again, same, "left_semi")
    return docs.join(again, same, "left_anti").unionByName(first.dropDuplicates(["doc_id", "text"]))


def query(spark, sf_dir: str) -> DataFrame:
    return parity_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
