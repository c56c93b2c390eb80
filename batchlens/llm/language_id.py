"""Hierarchical language identification with linear support vector machines.

A text's family is predicted first (one machine for each family against the
rest), then its language within that family by one-versus-one machines, each
pair voting. All read relative frequencies of hashed byte trigrams, so a
margin is a mean over the text's positions: texts of any length are scored
whole, in slices, in one pass.

Training fits in numpy on at most ``SAMPLE_PER_LANGUAGE`` labelled documents a
language (chosen by a hash of the row); of those only the fixed-size frequency
vectors reach the driver. Languages missing from ``FAMILIES`` form a family of
their own; the languages are those that occur in the labelled rows.

The filter also asks how well a text's trigrams fit the language found, as no
machine has seen text of other languages: their mean log frequency in the
language's training rows must come closer to the median of these rows than to
random trigrams, or at least reach the lowest hundredth of these rows.

Defined results: NULL text or text without a letter is ``und`` with score 0;
without labelled rows every text is; ties go to the language that sorts first;
equal rows get equal results; an empty table gives an empty result. Each row is
scored by itself, so no key gathers rows in one task.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import sampled, table

FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg"),
}
SAMPLE_PER_LANGUAGE = 500
DIMENSIONS = 4096
SLICE = 1 << 16  #: bytes of text held as arrays at once
FEW = 256  #: sample rows whose frequencies are held at once
UNKNOWN = "und"
#: Documents below this score are rejected by the filter.
MIN_SCORE = 0.2
#: Added to a trigram's frequency in a language.
FLOOR = 1e-6
LETTER = regex.compile(r"\p{L}")

#: Bytes to bytes: ASCII letters in lower case, other ASCII as spaces, the rest as it is.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def _slices(texts):
    """Lists of (row, bytes) with at most SLICE bytes in all; a longer text comes in pieces that overlap by two."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(len(text) - 2, 1), SLICE):
            piece = text[at:at + SLICE + 2]
            if held and size + len(piece) > SLICE:
                yield held
                held, size = [], 0
            held.append((row, piece))
            size += len(piece)
    if held:
        yield held


def trigrams(texts: list[str]):
    """Yields (rows, bucket of each trigram, first trigram of each row) slice by slice."""
    folded = (b" " + re.sub(rb" +", b" ", t.encode("utf-8", "replace").translate(FOLD)) + b" " for t in texts)
    for held in _slices(folded):
        b = np.frombuffer(b"".join(p + b"\0\0" for _, p in held), np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        bucket = (h >> np.uint32(20)).astype(np.intp)  # 12 bits: DIMENSIONS
        ends = np.cumsum([len(p) + 2 for _, p in held])
        bucket = np.append(bucket, [0, 0])
        for back in range(1, 5):
            bucket[ends - back] = DIMENSIONS  # windows that leave the text
        yield [r for r, _ in held], bucket, np.concatenate(([0], ends[:-1]))


def margins(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean weight of a text's trigrams for each column of ``weights``."""
    padded = np.vstack([weights, np.zeros((1, weights.shape[1]), weights.dtype)])
    total = np.zeros((len(texts), weights.shape[1]))
    count = np.zeros(len(texts))
    for rows, bucket, starts in trigrams(texts):
        np.add.at(total, rows, np.add.reduceat(padded[bucket], starts, axis=0, dtype=np.float64))
        np.add.at(count, rows, np.add.reduceat(bucket != DIMENSIONS, starts, dtype=np.int64))
    return total / np.maximum(count, 1)[:, None]


def frequencies(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS + 1))
    for rows, bucket, starts in trigrams(texts):
        lengths = np.diff(np.append(starts, len(bucket)))
        np.add.at(out, (np.repeat(rows, lengths), bucket), 1)
    out = out[:, :-1]
    return (out / np.maximum(out.sum(1, keepdims=True), 1)).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine by accelerated gradient steps; y is -1 or 1, classes weigh the same."""
    n, d = x.shape
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    bound = 2 * float((share[:, None] * x * x).sum()) + 2 + l2  # of the gradient's slope
    w, b = np.zeros(d), 0.0
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ vw + vb)) * y * share
        nw, nb = vw + (2 * x.T @ slack - l2 * vw) / bound, vb + 2 * slack.sum() / bound
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


class Model:
    """Columns of ``weights``: one machine a family, then one a pair of languages of the same family."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.languages = sorted(set(labels))
        self.families = sorted({family_of(a) for a in self.languages})
        members = {f: [a for a in self.languages if family_of(a) == f] for f in self.families}
        self.pairs = [(a, b) for f in self.families for i, a in enumerate(members[f]) for b in members[f][i + 1:]]
        self.members = members
        label = np.array(labels)
        family = np.array([family_of(a) for a in labels])
        scale = 1 / np.sqrt(x.mean(0) + 1e-4)
        z = (x * scale).astype(np.float64)
        fits = []
        for f in self.families:
            one = len(self.families) == 1
            fits.append((np.zeros(x.shape[1]), 1.0) if one else linear_svm(z, np.where(family == f, 1, -1)))
        for a, b in self.pairs:
            on = (label == a) | (label == b)
            fits.append(linear_svm(z[on], np.where(label[on] == a, 1, -1)))
        self.weights = np.stack([w * scale for w, _ in fits], 1).astype(np.float32)
        self.bias = np.array([b for _, b in fits])
        self.fit = np.stack([np.log(x[label == a].mean(0) + FLOOR) for a in self.languages], 1).astype(np.float32)
        #: Lowest mean log frequency that the filter accepts for each language.
        self.least = []
        for i, a in enumerate(self.languages):
            own = x[label == a] @ self.fit[:, i]
            self.least.append(min((np.median(own) + self.fit[:, i].mean()) / 2, np.quantile(own, 0.01)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        plain = self._plain(texts)
        return self._named(plain, margins(plain, self.weights) + self.bias)

    def accepts(self, texts: list[str | None]) -> np.ndarray:
        """Whether each text has a language, a score of MIN_SCORE and trigrams that fit the language."""
        plain = self._plain(texts)
        m = margins(plain, np.hstack([self.weights, self.fit]))
        n = len(self.bias)
        names, scores = self._named(plain, m[:, :n] + self.bias)
        at = [self.languages.index(a) if a != UNKNOWN else -1 for a in names]
        return np.array([k >= 0 and scores[i] >= MIN_SCORE and m[i, n + k] >= self.least[k] for i, k in enumerate(at)],
                        bool)

    @staticmethod
    def _plain(texts: list[str | None]) -> list[str]:
        return [t if t is not None and LETTER.search(t) else "" for t in texts]

    def _named(self, plain: list[str], m: np.ndarray) -> tuple[list[str], np.ndarray]:
        sure = 1 / (1 + np.exp(-4 * np.clip(m, -20, 20)))
        n = len(self.families)
        best = m[:, :n].argmax(1)
        names, scores = [], np.zeros(len(plain))
        for i, text in enumerate(plain):
            if not text:
                names.append(UNKNOWN)
                continue
            of = self.members[self.families[best[i]]]
            votes = {a: (0, 0.0) for a in of}
            least = {a: 1.0 for a in of}
            for k, (a, b) in enumerate(self.pairs):
                if a in votes:
                    p = sure[i, n + k]
                    for c, q in ((a, p), (b, 1 - p)):
                        votes[c] = (votes[c][0] + (q > 0.5), votes[c][1] + q)
                        least[c] = min(least[c], q)
            name = max(sorted(votes), key=lambda c: votes[c])
            names.append(name)
            scores[i] = sure[i, best[i]] * least[name]
        return names, scores


def held_out(modulus: int, remainder: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def train(docs: DataFrame) -> Model | None:
    """Fit on labelled rows of the training fold; None without any."""
    labelled = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(4, 2))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    drawn = F.lit(False)
    for lang, n in counts.items():
        drawn = drawn | ((F.col("lang") == lang) & sampled(3, "doc_id", "text", wanted=SAMPLE_PER_LANGUAGE, rows=n))

    def vectors(batches):
        for pdf in batches:
            pdf = pdf[[bool(LETTER.search(t)) for t in pdf.text]] if len(pdf) else pdf
            for at in range(0, len(pdf), FEW):
                few = pdf.iloc[at:at + FEW]
                yield pd.DataFrame({"lang": few.lang, "x": [v.tobytes() for v in frequencies(list(few.text))]})

    # of rows that repeat one is enough, so that the sample stays as small as stated
    sample = labelled.where(drawn).select("lang", "text").distinct().mapInPandas(vectors, "lang string, x binary")
    rows = sorted(((r["lang"], bytes(r["x"])) for r in sample.collect()))
    if not rows:
        return None
    return Model(np.stack([np.frombuffer(x, np.float32) for _, x in rows]), [a for a, _ in rows])


def predictor(model: Model | None):
    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        if model is None:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(text), "score": 0.0})
        names, scores = model.predict([t if isinstance(t, str) else None for t in text])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def language_id(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    predict = predictor(train(docs))
    found = docs.select("doc_id", F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"),
                        predict(F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def filter_documents(docs: DataFrame) -> DataFrame:
    """Rows whose language is recognised, with the columns of ``docs``."""
    model = train(docs)

    @F.pandas_udf("boolean")
    def accepted(text: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.zeros(len(text), bool))
        return pd.Series(model.accepts([t if isinstance(t, str) else None for t in text]))

    return docs.where(accepted(docs["text"]))


def query(spark, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
