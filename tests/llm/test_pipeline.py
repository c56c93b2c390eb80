"""Each stage against a plain version on its own input."""
import os

import pytest

import corpus_pipeline
from batchlens.llm.common import table
from test_operators import SF, brute_components

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        found = corpus_pipeline.written(stage(spark, docs, SF), name)
        left = {r.doc_id for r in found.collect()}
        if name == "quality_rules":
            assert all(len((r.text or "").split()) >= 50 for r in rows if r.doc_id in left) and 0 < len(left) < len(rows)
        elif name == "language_id":
            assert left == {r.doc_id for r in rows if any(c.isalpha() for c in r.text or "")}
        elif name == "near_copies":
            assert left == {c if n else d for d, n, c in brute_components(rows, 5, 80)}
        elif name == "packing":
            assert left == {r.doc_id for r in rows}
        if name != "packing":
            assert found.columns == columns
        docs = found
