"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded
(frequencies of character-class bigrams, word length, novelty of its words and
word pairs within the document, then a tanh layer), gated attention weights
are learned from document labels alone (Ilse, Tomczak and Welling, 2018), and
the weighted sum of the encodings is scored.

Training is numpy on about ``SAMPLE_PER_LABEL`` documents a label (an id that
repeats counts once). A training document is read whole: beyond ``BAG`` passages
neighbouring ones are averaged, so its bag has at most ``BAG`` rows. Scoring reads
every passage of every text with a running softmax, so memory does not grow
with a text.

Defined results: NULL text counts as empty and scores as a bag of one empty
passage; without labelled rows of both labels every score is 0.5; several
labels for one id count as the largest; equal rows get equal scores; an empty
table gives an empty result. Each row is scored by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import sampled, table
from batchlens.llm.language_id import held_out

PASSAGE = 512
BAG = 64
SAMPLE_PER_LABEL = 800
HIDDEN, GATE = 24, 12
STEPS, RATE = 250, 0.01
BLOCK = 2048  #: passages encoded at once

# Character classes of a byte: bytes of non-ASCII letters count as lower-case letters.
CLASSES = 14
_marks = {"\n": 4, ".": 5, ",": 6, "!": 7, "?": 8, "#": 9, "*": 9, "$": 9, "%": 9, "&": 9, "|": 10, "<": 10, ">": 10,
          "-": 11, "'": 11, '"': 11, ":": 12, "/": 12, "@": 12}
CLASS = np.array([_marks[chr(b)] if chr(b) in _marks else 0 if 97 <= b <= 122 or b >= 128 else 1 if 65 <= b <= 90
                  else 2 if 48 <= b <= 57 else 3 if b <= 32 else 13 for b in range(256)], np.intp)
FEATURES = CLASSES * CLASSES + 4


def passages(text: str | None):
    """Blocks of passage features of one text."""
    b = (text or "").encode("utf-8", "replace")
    cuts = range(0, max(len(b), 1), PASSAGE)
    seen_words, seen_pairs, held = set(), set(), []
    for at in cuts:
        part = b[at:at + PASSAGE]
        words = part.split()
        kinds, pairs = set(words), set(zip(words, words[1:], strict=False))
        n = max(len(words), 1)
        held.append((part, (sum(map(len, words)) / n / 10, len(kinds) / n,
                            len(kinds - seen_words) / max(len(kinds), 1),
                            len(pairs - seen_pairs) / max(len(pairs), 1))))
        seen_words |= kinds
        seen_pairs |= pairs
        if len(held) == BLOCK:
            yield _features(held)
            held = []
    if held:
        yield _features(held)


def bag(text: str | None, most: int = BAG) -> np.ndarray:
    """All passages of a text in at most ``most`` rows, each the mean of neighbouring passages."""
    n = max(1, -(-len((text or "").encode("utf-8", "replace")) // PASSAGE))
    rows, at = min(n, most), 0
    total = np.zeros((rows, FEATURES))
    for x in passages(text):
        np.add.at(total, np.arange(at, at + len(x)) * rows // n, x)
        at += len(x)
    return (total / np.bincount(np.arange(n) * rows // n)[:, None]).astype(np.float32)


def _features(held) -> np.ndarray:
    c = [CLASS[np.frombuffer(p, np.uint8)] for p, _ in held]
    pair = np.concatenate([i * CLASSES * CLASSES + x[:-1] * CLASSES + x[1:] for i, x in enumerate(c)])
    out = np.bincount(pair, minlength=len(held) * CLASSES * CLASSES).reshape(len(held), -1)
    out = np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))
    return np.hstack([out, np.array([x for _, x in held])]).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """h = tanh(xE + e); a = softmax over passages of w (tanh(hV) * sigmoid(hU)); score = sigmoid(sum(a h) c + d)."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        x = np.vstack(bags).astype(np.float64)
        self.mean, self.scale = x.mean(0), 1 / (x.std(0) + 0.05)
        x = (x - self.mean) * self.scale
        sizes = np.array([len(b) for b in bags])
        starts, of = np.concatenate(([0], np.cumsum(sizes)[:-1])), np.repeat(np.arange(len(bags)), sizes)
        weight = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
        shapes = {"E": (FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,),
                  "c": (HIDDEN,), "d": ()}
        self.p = p = {k: rng.normal(0, 1 / np.sqrt(max(s[0], 1) if s else 1), s) * (k not in "ed")
                      for k, s in shapes.items()}
        m1, m2 = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
        for t in range(1, STEPS + 1):
            h = np.tanh(x @ p["E"] + p["e"])
            v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
            gate = (v * u) @ p["w"]
            a = np.exp(gate - np.maximum.reduceat(gate, starts)[of])
            a /= np.add.reduceat(a, starts)[of]
            z = np.add.reduceat(a[:, None] * h, starts)
            err = (_sigmoid(z @ p["c"] + p["d"]) - labels) * weight
            dz = err[:, None] * p["c"]
            da = (dz[of] * h).sum(1)
            dgate = a * (da - np.add.reduceat(a * da, starts)[of])
            dv, du = dgate[:, None] * p["w"] * u * (1 - v * v), dgate[:, None] * p["w"] * v * u * (1 - u)
            dh = (a[:, None] * dz[of] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
            g = {"E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ dgate,
                 "c": z.T @ err, "d": err.sum()}
            for k in p:  # Adam with weight decay
                g[k] = g[k] + 1e-4 * p[k]
                m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g[k], 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)

    def score(self, text: str | None) -> float:
        """Running softmax over blocks of passages."""
        p, top, mass, total = self.p, -np.inf, 0.0, 0.0
        for x in passages(text):
            h = np.tanh((x - self.mean) * self.scale @ p["E"] + p["e"])
            gate = (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["w"]
            now = max(top, gate.max())
            a, old = np.exp(gate - now), np.exp(top - now)
            mass, total, top = mass * old + a.sum(), total * old + a @ h, now
        return float(_sigmoid(total / mass @ p["c"] + p["d"]))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on labelled rows of the training fold; None unless both labels occur."""
    known = (labels.select("doc_id", F.col("quality").alias("_quality"))
             .where(F.col("_quality").isin(0, 1) & ~held_out(3, 1))
             .groupBy("doc_id").agg(F.max("_quality").alias("_quality")))
    counts = {r["_quality"]: r["count"] for r in known.groupBy("_quality").count().collect()}
    if len(counts) < 2:
        return None
    few = known.where(F.when(F.col("_quality") == 1, sampled(5, "doc_id", wanted=SAMPLE_PER_LABEL, rows=counts[1]))
                      .otherwise(sampled(5, "doc_id", wanted=SAMPLE_PER_LABEL, rows=counts[0])))

    def bags(batches):
        for pdf in batches:
            x = [bag(t if isinstance(t, str) else None) for t in pdf.text]
            yield pd.DataFrame({"quality": pdf["_quality"], "x": [v.tobytes() for v in x]})

    # an id that repeats gives one text, so that the sample has SAMPLE_PER_LABEL rows a label, whatever the input
    sample = (docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "_quality")
              .agg(F.min("text").alias("text")).select("_quality", "text").mapInPandas(bags, "quality int, x binary"))
    rows = sorted((r["quality"], bytes(r["x"])) for r in sample.collect())
    if len({q for q, _ in rows}) < 2:
        return None
    return Model([np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, x in rows],
                 np.array([q for q, _ in rows], np.float64))


def quality_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document."""
    model = train(docs, labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([0.5 if model is None else model.score(t if isinstance(t, str) else None) for t in text],
                         dtype="float64")

    return docs.select("doc_id", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    return quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
