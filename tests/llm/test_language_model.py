"""Word splitting, what is joined, and both ways to take exponentials of the language model."""

from __future__ import annotations

import collections
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from batchlens.llm import language_model as lm
from batchlens.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", " A b\tc\n\nD\x0be\x0cf\rg ", "É\x1cü\x85 x\xa0y ÀB", "\n", "x" * 50, "İ ﬁ 가 　 Z"]


def test_words_are_those_between_ascii_white_space(spark):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("aB é\t\n\x0b\x1c\xa0") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    want = [t.encode().lower().split() for t in texts]
    for some, of in ((pa.array(texts), want), (pa.array(texts).slice(3, 200), want[3:203])):
        words, cuts = lm.split_words(some)
        assert [w.encode() for w in words.to_pylist()] == sum(of, []) and np.diff(cuts).tolist() == [len(w) for w in of]
    docs = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    got = {r.word.encode(): r.n for r in lm.count_words(docs).collect()}
    assert got == collections.Counter(sum(want, []))
    vocabulary = lm.Vocabulary(["a", "é", "ab"])
    kinds, ids, number, cuts = vocabulary.split(texts)
    for t, a, b in zip(texts, cuts, cuts[1:], strict=False):
        assert ids[number[a:b]].tolist() == vocabulary.ids(t).tolist()


def test_only_seldom_words_are_joined(spark, monkeypatch):
    """The words whose parts the tasks have are not written for the join, and scores are the same for any number."""
    docs = table(spark, SF, "documents")
    counts = lm.written(lm.count_words(docs), "word-counts")
    words = [r.word for r in counts.orderBy("word").collect()][::3][:lm.WORDS]
    vocabulary, rare = lm.Vocabulary(words), lm.rare_counts(counts, words)
    rng = np.random.default_rng(6)
    p = {k: rng.normal(0, 0.2, s).astype(np.float32) for k, s in lm.SHAPES.items()}
    kept, written = [], lm.written

    def keep(df, name):
        out = written(df, name)
        kept.append(sum(len(r.rare.split(" ")) for r in out.where("rare is not null").collect()))
        return out

    monkeypatch.setattr(lm, "written", keep)
    scores = []
    for often in (1 << 16, 100, 0):
        monkeypatch.setattr(lm, "OFTEN", often, raising=False)
        scores.append({r.doc_id: r for r in lm.scored(docs, lm.Scorer(p, vocabulary), rare).collect()})
    total = rare.groupBy().sum("n").first()[0]
    assert kept[0] == 0 < kept[1] < kept[2] == total
    for i, r in scores[0].items():
        assert all(abs(r.word_log_prob - s[i].word_log_prob) < 1e-6 * max(1, abs(r.word_log_prob)) for s in scores[1:])


def test_large_logits():
    """Logits whose exponentials are too large or small for 32 bits are shifted; others give the same either way."""
    rng = np.random.default_rng(9)
    context, target = rng.integers(0, lm.IDS, (300, 2 * lm.SIDE)), rng.integers(0, lm.IDS, 300)
    for size in (0.1, 40.0):
        p = {k: (rng.normal(0, size, s) if k in "CDcd" else rng.normal(0, 0.1, s)).astype(np.float32)
             for k, s in lm.SHAPES.items()}
        assert all(lm._bounded(x) == (size < 1) for x in lm._with_biases(p))
        padded = np.concatenate([np.insert(c, lm.SIDE, t) for c, t in zip(context, target, strict=True)])
        got = lm.Scorer(p, lm.Vocabulary([])).log_probabilities(padded, np.arange(300) * (2 * lm.SIDE + 1) + lm.SIDE)
        q = {k: v.astype(np.float64) for k, v in p.items()}
        h = np.tanh(sum(q["E"][context[:, k]] @ q["W"][k] for k in range(2 * lm.SIDE)) + q["b"])
        of, within = target // lm.WIDTH, target % lm.WIDTH
        want = lm._log_softmax(h @ q["C"] + q["c"])[np.arange(300), of]
        want += lm._log_softmax(np.einsum("nh,nhw->nw", h, q["D"][of]) + q["d"][of])[np.arange(300), within]
        np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-4)
        assert all(np.isfinite(g).all() for g in lm.step(p, context, target).values())


def test_portions_change_nothing(monkeypatch):
    texts = [" ".join(f"w{i * i % 89}" for i in range(n)) for n in (1, 7, 300, 64)] + [None, ""]
    vocabulary, start = lm.Vocabulary([f"w{i}" for i in range(60)]), lm.initial(np.ones(lm.IDS))
    monkeypatch.setattr(lm, "BATCH", 64)
    found = []
    for portion in (1 << 20, 10):
        monkeypatch.setattr(lm, "PORTION", portion)
        (out,) = lm._trainer(start, vocabulary)([pd.DataFrame({"text": texts})])
        n, total, (_, rare) = lm.Scorer(start, vocabulary).score(texts)
        found.append((out.v.to_numpy(), n, total, rare))
    for a, b in zip(*found, strict=True):
        assert list(a) == list(b) if isinstance(a, list) else np.allclose(a, b)


def test_checksums_of_many_words():
    rng = random.Random(3)
    words = ["", "é", "a" * lm.SHORT, "b" * (lm.SHORT + 1), "가" * 400]
    words += ["".join(rng.choice("aé가 z") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for some in (pa.array(words), pa.array(words).slice(7, 90), pa.array(words[:1]), pa.array([], pa.string())):
        assert lm.crc32(some).tolist() == [zlib.crc32(w.encode()) for w in some.to_pylist()]


def test_written_ids_train_and_score_as_texts(spark, monkeypatch):
    """Texts are split for ids once; what is learnt from and scored by the written ids is what the texts give."""
    texts = ODD + [None] + [" ".join(f"w{i * i % 89} {'x' * (i % 40)}" for i in range(n)) for n in (300, 1, 64)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    vocabulary, start = lm.Vocabulary([f"w{i}" for i in range(60)]), lm.initial(np.ones(lm.IDS))
    rows = lm.numbered(docs, vocabulary, pa.array(["w70", "x"]), np.array([-1.5, -2.0]))
    got = {r.doc_id: r for r in rows.collect()}
    assert "text" not in rows.columns and len(got) == len(texts)
    n, total, (within, rare) = lm.Scorer(start, vocabulary).score(texts, pa.array(["w70", "x"]), np.array([-1.5, -2.0]))
    for i, t in enumerate(texts):
        assert np.frombuffer(got[i].ids, np.int16).tolist() == vocabulary.ids(t).tolist()
        assert (got[i].n_words, got[i].rare) == (n[i], rare[i]) and abs(got[i].often - within[i]) < 1e-9
    monkeypatch.setattr(lm, "BATCH", 64)
    monkeypatch.setattr(lm, "TOGETHER", 50)
    ids = pa.array([got[i].ids for i in range(len(texts))], pa.binary())
    (a,) = lm._trainer(start, vocabulary)([pd.DataFrame({"text": texts})])
    (b,) = lm._trainer(start)([pa.RecordBatch.from_arrays([ids.slice(0, 9)], ["ids"]),
                               pa.RecordBatch.from_arrays([ids.slice(9)], ["ids"])])
    assert np.allclose(a.v, b.v) and a.n[0] == b.n[0] == n.sum()
    scores = np.concatenate([lm.Scorer(start, vocabulary).totals(*x) for x in lm._numbers(ids)])
    assert np.allclose(scores, total)


def test_training_and_scoring_reuse_memory():
    """A new process does not give the memory of each step back to the system to get it again page by page."""
    code = """
import resource, numpy as np, pandas as pd
from batchlens.llm import language_model as lm
rng = np.random.default_rng(2)
words = [f"w{i}" for i in range(lm.WORDS)]
vocabulary, start = lm.Vocabulary(words), lm.initial(np.ones(lm.IDS))
texts = [" ".join(words[i] for i in rng.integers(0, lm.WORDS, 2048)) for _ in range(160)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
list(lm._trainer(start, vocabulary)([pd.DataFrame({"text": texts})]))
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path), "OMP_NUM_THREADS": "1"})
    assert int(out.stdout) < 40 * 700  # of a step's arrays, about 2,000 pages and more
