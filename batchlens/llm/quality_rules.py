"""Quality rules as a short-circuit cascade.

Every rule is one column expression that is true where it rejects a text.
``estimate`` measures on a sample what each rule costs and how much it
rejects; ``cascade`` tries the rules in order of rejections per cost, and a
text that one rule rejects is not shown to the next (CASE WHEN evaluates its
branches lazily). The verdict does not depend on the order, so the sample
only decides how much work is saved.

Defined results: NULL text counts as empty; a text with fewer than
``MIN_WORDS`` words is rejected; repeated rows get the same verdict each; an
empty table gives an empty result. All work is within a row, so neither hot
sources nor groups of copies gather in one task.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import SPACE_WORD, let, sampled, words_of, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUP_LINE_SHARE = 0.5
MIN_DUP_LINES = 3
MAX_UPPER_SHARE = 0.3
WORD_LENGTH = (2.0, 14.0)
MIN_LETTER_WORDS = 0.5
MAX_ELLIPSIS_LINES = 0.3
MAX_BULLET_LINES = 0.9
#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 1000


def _n(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def n_symbols(text: Column) -> Column:
    return _n(text, r"[#*$%&|<>]")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _neighbours_equal(a: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Items of a sorted array that equal the one before or after."""
    return F.filter(a, lambda x, i: F.coalesce(same(x, F.get(a, i + 1)), F.lit(False))
                    | F.coalesce(same(x, F.get(a, i - 1)), F.lit(False)))


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Hash and position of each window are packed into one long, as many low
    bits for the position as the text needs; windows whose truncated hash
    stands alone in the sorted array cannot repeat. The others are compared
    as text, so the count is exact.
    """
    def positions(w: Column, bits: Column) -> Column:
        def hashed(i: Column) -> Column:
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.call_function("shiftleft", F.call_function("shiftright", h, bits), bits) + i

        packed = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), hashed))
        alike = let(packed, lambda p: _neighbours_equal(
            p, lambda x, y: F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        return F.transform(alike, lambda x: x.bitwiseAND(mask).cast("int"))

    def window(w: Column, i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))

    def covered(w: Column) -> Column:
        bits = F.ceil(F.log2(F.size(w).cast("double") + 1)).cast("int")
        found = let(positions(w, bits), lambda p: F.transform(p, lambda i: window(w, i)))
        equal = let(F.sort_array(found), lambda s: _neighbours_equal(s, lambda x, y: x["g"] == y["g"]))
        starts = F.sort_array(F.transform(equal, lambda x: x["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(covered(words))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column, Column], Column]  #: of text and words


RULES = (
    Rule("too_short", lambda t, w: F.size(w) < MIN_WORDS),
    Rule("repeated_windows", lambda t, w: 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w)),
    Rule("symbols", lambda t, w: _share(n_symbols(t), F.size(w)) > MAX_SYMBOLS_PER_WORD),
    Rule("upper_case", lambda t, w: _share(_n(t, r"\p{Lu}"), F.char_length(t)) > MAX_UPPER_SHARE),
    Rule("word_length", lambda t, w: ~_share(word_chars(t), F.size(w)).between(*WORD_LENGTH)),
    Rule("few_letters", lambda t, w: _share(
        _n(t, r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]*+\p{L}"), F.size(w)) < MIN_LETTER_WORDS),
    Rule("duplicate_lines", lambda t, w: let(lines_with_words(t), lambda x: (
        (F.size(x) - F.size(F.array_distinct(x)) >= MIN_DUP_LINES)
        & (F.size(x) - F.size(F.array_distinct(x)) > MAX_DUP_LINE_SHARE * F.size(x))))),
    Rule("ellipsis_lines", lambda t, w: let(lines_with_words(t), lambda x: F.size(
        F.filter(x, lambda y: y.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))) > MAX_ELLIPSIS_LINES * F.size(x))),
    Rule("bullet_lines", lambda t, w: let(lines_with_words(t), lambda x: F.size(
        F.filter(x, lambda y: y.rlike(r"^[\x20\x09-\x0D]*[•*-]"))) > MAX_BULLET_LINES * F.size(x))),
)


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float  #: for the sample, over what splitting into words takes
    rejected: float  #: share of the sample

    @property
    def rank(self) -> float:
        return self.rejected / self.seconds


def with_words(docs: DataFrame) -> DataFrame:
    """Adds ``_text`` (never NULL) and ``_words``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"_text": text, "_words": words_of(F.col("text"), SPACE_WORD)})


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on about ``sample_rows`` rows, chosen by a hash of the row."""
    rows = docs.count()
    sample = written(docs.where(sampled(17, "doc_id", "text", wanted=sample_rows, rows=rows)).select("text"),
                     "rule-sample")
    split = with_words(sample)

    def timed(c: Column) -> tuple[float, float]:
        began = time.monotonic()
        hit, n = split.agg(F.sum(c.cast("int")), F.count(F.lit(1))).first()
        return time.monotonic() - began, (hit or 0) / max(n, 1)

    plain = F.size("_words") < 0
    timed(plain)
    floor = min(timed(plain)[0] for _ in range(2))
    found = []
    for r in rules:
        seconds, rejected = timed(r.rejects(F.col("_text"), F.col("_words")))
        found.append(Estimate(r.name, max(seconds - floor, 1e-3), rejected))
    return found


def ordered(rules, estimates: list[Estimate]) -> list[Rule]:
    """By rejections per cost, the highest first; ties keep the order given."""
    rank = {e.name: e.rank for e in estimates}
    return sorted(rules, key=lambda r: -rank[r.name])


def cascade(text: Column, words: Column, rules) -> Column:
    """Name of the first rule, in this order, that rejects; NULL where none does."""
    out = F.when(rules[0].rejects(text, words), F.lit(rules[0].name))
    for r in rules[1:]:
        out = out.when(r.rejects(text, words), F.lit(r.name))
    return out


def filter_documents(docs: DataFrame, rules=RULES) -> DataFrame:
    """Rows that no rule rejects, with the columns of ``docs``."""
    plan = ordered(rules, estimate(docs, rules))
    text = F.coalesce(docs["text"], F.lit(""))
    # one lambda binds the words, so that no helper column can clash with one of docs
    rejected = let(words_of(docs["text"], SPACE_WORD), lambda w: cascade(text, w, plan))
    return docs.where(rejected.isNull())


def quality_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """Base counts and the verdict of the cascade for each row of ``docs``."""
    plan = ordered(rules, estimate(docs, rules))
    split = with_words(docs.select("doc_id", "text"))
    text, words = F.col("_text"), F.col("_words")
    counted = split.select(
        "doc_id", "_text", "_words",
        F.size(words).cast("long").alias("n_words"), word_chars(text).cast("long").alias("word_chars"),
        n_symbols(text).cast("long").alias("n_symbols"), n_dup_lines(text).cast("long").alias("n_dup_lines"),
        n_repeat_words(words).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # what is counted already is not counted again
    known = {"too_short": F.col("n_words") < MIN_WORDS,
             "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
             "symbols": _share(F.col("n_symbols"), F.col("n_words")) > MAX_SYMBOLS_PER_WORD,
             "word_length": ~_share(F.col("word_chars"), F.col("n_words")).between(*WORD_LENGTH)}
    reused = [Rule(r.name, (lambda t, w, c=known[r.name]: c)) if r.name in known else r for r in plan]
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & cascade(text, words, reused).isNull()).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    from batchlens.llm.common import table

    return quality_rules(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
      FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g) WHERE c > 1),
n AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, unnest([0, 1, 2]) AS v(k) GROUP BY doc_id),
f AS (SELECT d.*, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n.n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN n USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed
       OR n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words
       OR len(regexp_extract_all(t, '\p{{Lu}}')) > {MAX_UPPER_SHARE} * length(t)
       OR word_chars / n_words < {WORD_LENGTH[0]} OR word_chars / n_words > {WORD_LENGTH[1]}
       OR len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) < {MIN_LETTER_WORDS} * n_words
       OR n_dup_lines >= {MIN_DUP_LINES} AND n_dup_lines > {MAX_DUP_LINE_SHARE} * len(l)
       OR len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > {MAX_ELLIPSIS_LINES} * len(l)
       OR len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•*-]'))) > {MAX_BULLET_LINES} * len(l)
  ) AS kept
FROM b
"""
