"""Centroid clustering, exact top-k and importance resampling against plain versions, and on awkward rows."""
import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pytest

from batchlens.llm import centroids, importance, topk
from batchlens.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
VECTORS = "vec_id long, embedding array<double>, label int, v string, class string, row string, query string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "y", "z", "q") for i, v in rows], VECTORS)


def awkward_vectors(width):
    rng = np.random.default_rng(2)
    same = rng.normal(0, 0.2, width).tolist()
    rows = [(i, rng.normal(0, 0.2, width).tolist()) for i in range(60)]
    rows += [(1000 + i, same) for i in range(200)]  # copies
    rows += [(50, same), (50, same), (None, same), (None, [0.0] * width), (2000, [0.0] * width), (2050, [-0.5] * width)]
    rows += [(3000, None), (3050, []), (3100, [0.1] * (width - 1)), (3150, [None] + [0.1] * (width - 1)),
             (3200, [float("nan")] * width), (3250, [float("inf")] * width), (3300, [1e300] + [-1e300] * (width - 1))]
    return rows


def ints(v, scale, bound):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(min(max(x * scale, -bound), bound)) for x in v]


def brute_clusters(rows):
    """Lloyd's rounds with every distance anew."""
    keep = [(i, ints(v, 1024, centroids.BOUND)) for i, v in rows if v is not None and len(v) == 64]
    keep = [(i, v) for i, v in keep if v is not None]
    order = sorted(keep, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:8]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c)) for _, v in keep]

    for _ in range(10):
        near = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, k) in zip(keep, near, strict=True) if k == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    total = collections.Counter()
    for d, j in near:
        total[j] += d
    return collections.Counter(
        (i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(keep, near, strict=True))


def test_centroids(spark):
    rows = [(i, v) for i, v in awkward_vectors(64) if i != 3300]
    got = centroids.clustered(vectors(spark, rows).repartition(5))
    assert collections.Counter(map(tuple, got.collect())) == brute_clusters(rows)
    few = rows[:3]
    assert collections.Counter(map(tuple, centroids.clustered(vectors(spark, few)).collect())) == brute_clusters(few)
    assert centroids.clustered(vectors(spark, [])).count() == 0
    huge = centroids.clustered(vectors(spark, awkward_vectors(64)))
    assert huge.count() == len(rows) - 6 + 1 and huge.where("distance < 0").count() == 0


def test_updated_products_equal_new_ones():
    rng = np.random.default_rng(3)
    v = rng.integers(-1 << 27, 1 << 27, (40, 64)).astype("<i4")
    c = rng.integers(-1 << 27, 1 << 27, (8, 64))
    dots = v.astype(np.int64) @ c.T
    for _ in range(5):
        change = rng.integers(-50, 50, c.shape) * (rng.random(c.shape) < 0.1)
        dots, c = centroids.updated(dots, v, change), c + change
        assert (dots == v.astype(np.int64) @ c.T).all()


def brute_top(rows, k=5):
    keep = [(i, ints(v, 256, topk.BOUND)) for i, v in rows]
    keep = [(i, v) for i, v in keep if v is not None]
    out = collections.Counter()
    for n, (q, x) in enumerate(keep):
        if q is not None and q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i is None, i or 0, m)
                           for m, (i, y) in enumerate(keep) if m != n)
            for rank, (s, none, i, _) in enumerate(found[:k], 1):
                out[q, rank, None if none else i, -s] += 1
    return out


@pytest.mark.parametrize("blocks", [(4096, 2048, 64), (16, 4, 3)])
def test_topk(spark, monkeypatch, blocks):
    for name, n in zip(("BLOCK", "QUERY_BLOCK", "AT_ONCE"), blocks, strict=True):
        monkeypatch.setattr(topk, name, n)
    for rows in (awkward_vectors(12), awkward_vectors(3), awkward_vectors(12)[:4]):
        df = vectors(spark, rows).repartition(3)
        got = topk.search(df, F.col("vec_id") % 50 == 0).collect()
        assert collections.Counter(map(tuple, got)) == brute_top(rows)
    assert topk.search(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_loses_nothing():
    """The entries that pass the cutoff are all those whose score reaches it, for scores of either sign."""
    rng = np.random.default_rng(5)
    for shift in (-40, 0, 40):
        q, v = rng.integers(-9, 9, (7, 10)), rng.integers(-9, 9, (300, 10)) + shift
        local = topk.local_scores(q, v)
        score = q @ v.T
        assert (sum(local) == score).all()
        row, s = topk.gathered(local, 6)
        cutoff = np.array([np.sort(s[row == i])[-6] for i in range(7)])
        assert all((score[i] >= cutoff[i]).sum() >= 6 for i in range(7))
        a, b, s = topk.sufficient(local, cutoff)
        assert set(zip(a, b, strict=True)) == set(zip(*np.nonzero(score >= cutoff[:, None]), strict=True))
        assert (s == score[a, b]).all()
    big = np.full((1, 64), 1 << 23)
    assert sum(topk.local_scores(big, -big))[0, 0] == -64 << 46


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))


def brute_features(t):
    w = brute_words(t)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_draw(rows, items):
    """Contract of the query in plain Python: rows of (doc_id, text)."""
    def count(texts):
        return collections.Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in brute_features(t))

    s, t = count(x for _, x in rows), count(items)
    of_s, of_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for n, (i, text) in enumerate(rows):
        f = brute_features(text)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * of_s / ((s[b] + 1) * of_t)))
                for b in (zlib.crc32(x.encode()) % 10000 for x in f))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute_words(text)), n))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {r[5]: k for k, r in enumerate(able[:5 * len(able) // 100], 1)}
    return collections.Counter((i, n, w, sc, rank.get(at)) for i, n, w, sc, _, at in out)


def test_importance_query(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = collections.Counter(map(tuple, importance.query(spark, SF).collect()))
    assert got == brute_draw([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert sum(n for r, n in got.items() if r[4] is not None) > 0


@pytest.fixture
def awkward_texts():
    long = " ".join(f"Word{i % 97}x{i % 1013}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n,;"), (None, " ".join(f"no id {i}" for i in range(15))), (5, long),
            (6, "Ünïcode \U0001F600 naïve-ÉTÉ ßß x y " * 9), (7, "y" * 70_000 + " z " + "w" * 65 + " " + "v" * 64),
            (8, "A a 0 9 _ ` { ~ \x7f \x00 b"), (9, "nospace"), (10, "two words")]
    rows += [(11, "the same text for many rows " * 8)] * 90  # one id, a third of the rows and more
    return rows + [(100 + i, f"document {i} with words of its own " * 6) for i in range(150)]


@pytest.mark.parametrize("piece", [1 << 18, 1000, 40])
def test_importance_awkward(spark, monkeypatch, awkward_texts, piece):
    monkeypatch.setattr(importance, "SLICE", piece)
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2, 3) for i, t in awkward_texts],
                                 "doc_id long, text string, row string, score int, rank string, n_words int, at int")
    items = spark.createDataFrame([(1, "words of its own"), (2, None), (3, "")], "item_id long, text string")
    got = importance.resample(docs.repartition(6), items).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert collections.Counter(map(tuple, got)) == brute_draw(awkward_texts, ["words of its own", None, ""])
    if piece == 40:
        assert importance.resample(docs.limit(0), items).count() == 0
        none = importance.resample(docs, items.limit(0)).collect()
        assert len(none) == len(awkward_texts)


def test_crc_of_windows():
    rng = np.random.default_rng(7)
    for size in (0, 1, 5, 31, 32, 33, 64, 65, 200, 5000):
        data = rng.bytes(size * 3 + 8)
        at = np.array([0, 3, 5]), np.array([size, size // 2, size * 2])
        want = [zlib.crc32(data[s:s + n]) for s, n in zip(*at, strict=True)]
        assert importance.crcs(data, *at).tolist() == want
        b = rng.bytes(size)
        a = np.array([zlib.crc32(b"head")], np.uint32)
        joined = importance.shifted(a, np.array([size])) ^ np.uint32(zlib.crc32(b))
        assert joined.tolist() == [zlib.crc32(b"head" + b)]
