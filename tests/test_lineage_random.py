"""Randomized check of JOB-20 against a brute-force Python evaluation of the
LIN-1 rules (SURVEY §2.9) with Python's ``re`` -- the engine the rules were
written for -- over a few hundred generated SQL-like texts, including
non-ASCII word characters and mixed case."""
import random
import re
from collections import Counter

from batchlens.operators.lineage import COLUMN_PATTERN, TABLE_PATTERN, extract_references

TOKENS = ["SELECT", "select", "FROM", "from", "JOIN", "Join", ",", ", ", " ", "  ", "\n", "AS", "as",
          "a", "b.c", "t1", "T1.x", "[Edw].[Dbo].[T9]", "Edw.Dbo.T9", "Edw.U5", "u5.col", "db.sch.tb",
          "Café", "Über.Straße", "x_1", "COUNT(x)", "(", ")", "last", "t9.y"]


def brute(text):
    if not text:
        return []
    tables = {}
    for m in re.finditer(TABLE_PATTERN, text, re.IGNORECASE):
        db, sch, tbl = m.group(1), m.group(2), m.group(3)
        tables[tbl.lower()] = (db, sch, tbl)          # later matches replace earlier ones
    rows = []
    for m in re.finditer(COLUMN_PATTERN, text, re.IGNORECASE):
        q1, q2, col, alias = m.groups()
        if q1 is not None and q1.lower() in tables:
            db, sch, tbl = tables[q1.lower()]
        elif q2 is not None:
            db, sch, tbl = None, q1, q2
        else:
            db = sch = tbl = None
        rows.append((db, sch, tbl, col, alias))
    return rows


def test_random_texts_match_python_semantics(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(TOKENS) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, 18)))
             for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "DestinationBindingID bigint, AttributeValueLongTXT string")
    got = Counter((r[0], *r[1:]) for r in map(tuple, extract_references(df).collect()))
    want = Counter((i, *row) for i, t in enumerate(texts) for row in brute(t))
    assert sum(want.values()) > 150
    assert got == want
