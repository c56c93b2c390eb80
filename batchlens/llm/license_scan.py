"""License notices by an exact set-similarity (containment) join.

Templates are token sets: the base phrases, of which a block must contain
all tokens, and longer notices, of which it must contain ``THRESHOLD``. A
text's blocks are windows of ``BLOCK`` words, one every ``STEP`` words, so any
passage of up to ``BLOCK - STEP + 1`` words lies whole in some block. Texts are
split once: what is kept of them is the template tokens they hold, with their
places, in cells of ``STEP`` words; a block is its cells.

* Order: template tokens are sorted by their frequency in the whole table,
  the rarest first.
* Prefix filter: a block that holds ``need`` of a template's ``size`` tokens
  holds one of its ``size - need + 1`` rarest; only those are joined.
* Positional filter: a first match at place j of the template (from 0) leaves
  ``size - j`` tokens at most; and only the first matching prefix token of a
  block starts a candidate.
* Length filter: a block needs ``need`` distinct template tokens.
* Verification: the overlap itself; for base phrases, also the places where
  the words stand one after the other.

Candidates are rows (document, block, template) and the templates are the
small side whatever the input, so no group of documents meets in one task.
Defined results: NULL or empty text has no words, no labels, score 0; rows
that repeat a doc_id are told apart by their text, and equal rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import PLAIN_WORD, ascii_lower, row_key, same_row, table, words_of, written

# The phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Opening sentences of public license notices.
NOTICES = (
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance"
     " with the license", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", "mit"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted", "isc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
THRESHOLD = 0.8
BLOCK, STEP = 64, 32


def templates() -> list[dict]:
    """Base phrases need all their tokens, notices the share THRESHOLD."""
    out = []
    for text, label, base in [(*p, True) for p in PHRASES] + [(*n, False) for n in NOTICES]:
        tokens = list(dict.fromkeys(text.split()))
        need = len(tokens) if base else ceil(THRESHOLD * len(tokens) - 1e-9)
        out.append({"template": len(out), "phrase": text.split() if base else [], "label": label, "base": base,
                    "tokens": tokens, "need": need})
    return out


VOCABULARY = sorted({t for s in templates() for t in s["tokens"]})


def marked(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, k, n_words and the cells: of each ``STEP`` words the template tokens, with their places."""
    words = docs.select("doc_id", row_key().alias("k"),
                        words_of(ascii_lower(F.coalesce("text", F.lit(""))), PLAIN_WORD).alias("w"))

    def cell(c: Column) -> Column:
        tokens = F.transform(F.slice("w", c * STEP + 1, STEP), lambda x, i: F.when(
            x.isin(vocabulary), F.struct((i + c * STEP).alias("at"), x.alias("token"))))
        return F.filter(tokens, lambda m: m.isNotNull())

    last = F.greatest(F.lit(0), F.ceil(F.size("w") / F.lit(STEP)).cast("int") - 1)
    return words.select("doc_id", "k", F.size("w").alias("n_words"),
                        F.transform(F.sequence(F.lit(0), last), cell).alias("cells"))


def token_frequency(marks: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each template token occurs in the whole table; the result is as small as the templates."""
    seen = marks.select(F.explode(F.flatten("cells")).alias("m")).select("m.token")
    found = {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {t: found.get(t, 0) for t in vocabulary}


def prefix_table(spark, spec: list[dict], frequency: dict[str, int]) -> DataFrame:
    """One row for each template and each of its prefix tokens, in the global order."""
    rows = []
    for t in spec:
        order = sorted(t["tokens"], key=lambda x: (frequency[x], x))
        for place, token in enumerate(order[:len(order) - t["need"] + 1]):
            rows.append((token, t["template"], place, order, t["need"], t["phrase"], t["label"], t["base"]))
    return spark.createDataFrame(rows, "token string, template int, place int, tokens array<string>, need int, "
                                       "phrase array<string>, label string, base boolean")


def candidates(marks: DataFrame, prefixes: DataFrame, tokens: list[str]) -> DataFrame:
    """(document, block, template) rows that pass the prefix, positional and length filters."""
    last = F.greatest(F.lit(0), F.ceil((F.col("n_words") - BLOCK) / F.lit(STEP)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(
        b.alias("b"), F.flatten(F.slice("cells", b + 1, BLOCK // STEP)).alias("block")))
    # blocks without a prefix token end here
    cut = F.filter(cut, lambda x: F.exists(x["block"], lambda m: m["token"].isin(tokens)))
    block = marks.select("doc_id", "k", F.inline(cut))
    held = F.col("block.token")
    matched = block.withColumn("token", F.explode(F.array_intersect(held, F.array(*[F.lit(t) for t in tokens]))))
    return (matched.join(F.broadcast(prefixes), "token")  # as small as the templates are
            .where(F.col("need") <= F.size("tokens") - F.col("place"))
            .where(F.size(F.array_intersect(F.slice("tokens", 1, F.col("place")), held)) == 0)
            .where(F.size(F.array_distinct(held)) >= F.col("need")))


def verify(found: DataFrame) -> DataFrame:
    """Blocks that reach the threshold, with the places of base phrases; ``share`` of the template they hold."""
    held, at = F.col("block.token"), F.col("block.at")
    overlap = F.size(F.array_intersect("tokens", held))
    length = F.size("phrase")

    def stands(i: Column) -> Column:
        return (F.slice(held, i + 1, length) == F.col("phrase")) & (
            F.get(at, i + length - 1) - F.get(at, i) == length - 1)

    starts = F.transform(F.filter(F.sequence(F.lit(0), F.size("block") - 1), stands), lambda i: F.get(at, i))
    return (found.withColumn("overlap", overlap).where("overlap >= need")
            .withColumn("starts", F.when(F.col("base"), starts).otherwise(F.array().cast("array<int>")))
            .where("NOT base OR size(starts) > 0")
            .select("doc_id", "k", "b", "template", "label", "base", "starts",
                    (F.col("overlap") / F.size("tokens")).alias("share")))


def matches(marks: DataFrame) -> DataFrame:
    """Every text block that meets a template."""
    spec = templates()
    frequency = token_frequency(marks, VOCABULARY)
    prefixes = prefix_table(marks.sparkSession, spec, frequency)
    tokens = sorted({t for s in spec for t in sorted(s["tokens"], key=lambda x: (frequency[x], x))
                     [:len(s["tokens"]) - s["need"] + 1]})
    return verify(candidates(marks, prefixes, tokens))


def license_scan(docs: DataFrame) -> DataFrame:
    """Per document: word count, places of the base phrases, labels and the best containment."""
    marks = written(marked(docs.select("doc_id", "text"), VOCABULARY), "license-marks")
    found = matches(marks)
    place = F.explode_outer(F.when(F.size("starts") > 0, F.col("starts")))
    # a place may lie in two blocks and a row may repeat: distinct before counting
    per_place = (found.select("doc_id", "k", "template", "label", "base", "share", place.alias("start"))
                 .groupBy("doc_id", "k", "template", "label", "base", "start").agg(F.max("share").alias("share")))
    joined = F.array_join  # labels are few: as many as the templates have
    hits = per_place.groupBy("doc_id", "k").agg(
        F.count("start").alias("n_base"), F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        joined(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        joined(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    sizes = marks.select("doc_id", "k", F.col("n_words").cast("long").alias("n_words"))
    found = written(hits, "license-hits")
    return sizes.join(found, same_row(sizes, found), "left").select(
        sizes["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    spec = templates()
    case = " ".join(f"WHEN {t['template']} THEN '{t['label']}'" for t in spec)
    sets = ", ".join(f"({t['template']}, {t['tokens']}, {t['need']})" for t in spec if not t["base"])
    phrases = ", ".join(f"({t['template']}, {t['phrase']})" for t in spec if t["base"])
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p(template, phrase) AS (VALUES {phrases}),
s(template, tokens, need) AS (VALUES {sets}),
b AS (SELECT doc_id, template, i - 1 AS start, 1.0::DOUBLE AS share
      FROM d, p, unnest(range(1, len(w) + 1)) AS u(i)
      WHERE w[i] = phrase[1] AND w[i:i + len(phrase) - 1] = phrase),
m AS (SELECT doc_id, template, NULL AS start,
        len(list_intersect(tokens, w[i * {STEP} + 1:i * {STEP} + {BLOCK}])) / len(tokens) AS share
      FROM d, s, unnest(range(0, 1 + greatest(0, ceil((len(w) - {BLOCK}) / {STEP}))::BIGINT)) AS u(i)
      WHERE len(list_intersect(tokens, w[i * {STEP} + 1:i * {STEP} + {BLOCK}])) >= need),
h AS (SELECT *, CASE template {case} END AS label FROM (SELECT * FROM b UNION ALL SELECT * FROM m)),
a AS (SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT CASE WHEN start IS NOT NULL THEN label END, ',' ORDER BY CASE WHEN start IS NOT NULL
        THEN label END) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN a USING (doc_id)
"""
