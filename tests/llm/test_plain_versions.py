"""Models and stages against plain versions of their rules, and samples of very large tables."""
import collections
import os
import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from batchlens.llm import language_id, language_model, quality_model, token_files
from batchlens.llm.common import sampled, table
from test_operators import SF, awkward, brute_components, empty  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_samples_of_very_large_tables(spark):
    """A thousand of 10^10 rows are still drawn, about as many as asked for."""
    ids = spark.range(50_000_000)
    assert 1 <= ids.where(sampled(3, "id", wanted=1000, rows=10 ** 10)).count() <= 20
    n = spark.range(100_000).where(sampled(3, "id", wanted=1000, rows=100_000)).count()
    assert 900 <= n <= 1100
    assert spark.range(100).where(sampled(3, "id", wanted=1000, rows=100)).count() == 100


def test_sample_of_repeated_rows_stays_small(spark, monkeypatch):
    """A row that repeats, or an id with many texts, counts once in what a model is fitted on."""
    sizes = []
    monkeypatch.setattr(language_id, "Model", lambda x, labels: sizes.append(len(labels)))
    monkeypatch.setattr(quality_model, "Model", lambda bags, labels: sizes.append(len(labels)))
    rows = [(3, "the same text", "en")] * 400 + [(i, f"text number {i}", "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.train(docs)
    rows = [(3, f"one id {i}") for i in range(400)] + [(i, f"text {i}") for i in range(4, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    quality_model.train(docs, labels)
    assert sizes[0] <= 41 and sizes[1] <= 40


def plain_trigrams(text):
    b = b" " + re.sub(rb" +", b" ", text.encode().translate(language_id.FOLD)) + b" "
    out = np.zeros(language_id.DIMENSIONS)
    for x, y, z in zip(b, b[1:], b[2:], strict=False):
        h = (x * 0x9E3779B1 ^ y * 0x85EBCA77 ^ z * 0xC2B2AE3D) & 0xFFFFFFFF
        h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
        out[h >> 20] += 1
    return out / max(out.sum(), 1)


def test_language_scores_equal_a_plain_version(spark):
    docs = table(spark, SF, "documents")
    model = language_id.train(docs)
    texts = [r.text or "" for r in docs.limit(40).collect()] + ["½ ² Ⅷ ① 12", "", "Straße ÉTÉ", "a"]
    names, scores = model.predict(texts)
    n = len(model.families)
    for text, name, score in zip(texts, names, scores, strict=True):
        if not regex.search(r"\p{L}", text):
            assert (name, score) == ("und", 0)
            continue
        m = plain_trigrams(text) @ model.weights.astype(np.float64) + model.bias
        sure = 1 / (1 + np.exp(-4 * m))
        family = int(np.argmax(m[:n]))
        votes = collections.Counter({a: 0 for a in model.members[model.families[family]]})
        least = dict.fromkeys(votes, 1.0)
        for (a, b), p in zip(model.pairs, sure[n:], strict=True):
            if a in votes:
                votes[a if p > 0.5 else b] += 1
                least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        assert votes[name] == max(votes.values())
        assert abs(score - sure[family] * least[name]) < 1e-4


def test_quality_scores_equal_a_plain_version(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality_model.train(docs, labels)
    p = model.p
    for text in [r.text for r in docs.limit(25).collect()] + [None, "", "x" * 3_000_000]:
        x = np.vstack(list(quality_model.passages(text)))
        h = np.tanh((x - model.mean) * model.scale @ p["E"] + p["e"])
        gate = (np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]
        a = np.exp(gate - gate.max())
        want = 1 / (1 + np.exp(-((a / a.sum()) @ h @ p["c"] + p["d"])))
        assert abs(model.score(text) - want) < 1e-6


def test_bag_reads_the_whole_text():
    """A long text's bag has as many rows as allowed, and their mean is that of all its passages."""
    for n in (10, 512 * 64, 512 * 64 + 1, 512 * 1000 + 7):
        text = "".join(f"w{i * i % 1013} " for i in range(n // 4))
        whole = np.vstack(list(quality_model.passages(text)))
        bag = quality_model.bag(text)
        assert len(bag) == min(len(whole), quality_model.BAG)
        weight = np.bincount(np.arange(len(whole)) * len(bag) // len(whole))
        np.testing.assert_allclose((bag * weight[:, None]).sum(0) / len(whole), whole.mean(0), atol=1e-4)


def test_log_prob_is_the_sum_of_conditionals(spark):
    docs = table(spark, SF, "documents")
    p, vocabulary = language_model.train(docs)
    scorer = language_model.Scorer(p, vocabulary)
    side = language_model.SIDE
    texts = [r.text for r in docs.limit(6).collect()] + ["one", "two words", None]
    _, total, _ = scorer.score(texts)
    for text, got in zip(texts, total, strict=True):
        ids = [vocabulary[w] for w in (text or "").encode().lower().split()]
        x = [language_model.IDS] * side + ids + [language_model.IDS] * side
        want = 0.0
        for i in range(side, len(x) - side):
            z = p["b"].astype(np.float64)
            for k, o in enumerate(language_model.OFFSETS):
                z = z + p["E"][x[i + o]].astype(np.float64) @ p["W"][k]
            h = np.tanh(z)
            c, d = divmod(x[i], language_model.WIDTH)
            for logits, at in ((h @ p["C"] + p["c"], c), (h @ p["D"][c] + p["d"][c], d)):
                want += logits[at] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
        assert abs(got - want) < 1e-3 + 1e-5 * abs(want)


def test_pairs_are_replaced_to_the_end():
    """No pair that is used often enough is left, and what is written expands to what was read."""
    rng = np.random.default_rng(8)
    phrase = rng.integers(0, 40, 300)
    docs = [np.concatenate([phrase[int(rng.integers(0, 200)):], rng.integers(0, 40, int(rng.integers(1, 30)))]) for _ in range(150)]
    ids = np.concatenate(docs)
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    symbols, ends, rules = token_files.repair(ids, last.copy(), 50)
    assert (token_files.expand(symbols, rules, 50) == ids).all() and ends.sum() == 150
    pairs = collections.Counter(zip(symbols[:-1][~ends[:-1]].tolist(), symbols[1:][~ends[:-1]].tolist(), strict=True))
    assert max(pairs.values()) < 2 * token_files.LEAST_USES
    assert token_files.expansion_lengths(rules, 50).max() > 16 and len(symbols) < len(ids) / 8
    sizes = token_files.expansion_lengths(rules, 50)[symbols]
    assert (np.cumsum(sizes)[ends] == np.cumsum([len(d) for d in docs])).all()


SPACE = r"[\x20\x09-\x0D]"


def plain_rejects(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = max(len(w), 1)
    grams = collections.defaultdict(list)
    for i in range(len(w) - 2):
        grams[tuple(w[i:i + 3])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = len(lines) - len(set(lines))
    return (len(w) < 50 or 100 * len(covered) > 50 * len(w) or len(re.findall(r"[#*$%&|<>]", t)) / n > 0.1
            or len(regex.findall(r"\p{Lu}", t)) / max(len(t), 1) > 0.3 or not 2 <= sum(map(len, w)) / n <= 14
            or sum(bool(regex.search(r"\p{L}", x)) for x in w) / n < 0.5 or (again >= 3 and again > 0.5 * len(lines))
            or sum(bool(re.search(rf"(\.\.\.|…){SPACE}*$", x)) for x in lines) > 0.3 * len(lines)
            or sum(bool(re.search(rf"^{SPACE}*[•*-]", x)) for x in lines) > 0.9 * len(lines))


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contaminated(text, items):
    w = plain_words(text)
    for item in items:
        n = min(10, len(item))
        if n and {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} & {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}:
            return True
    return False


def test_pipeline_equals_plain_stages(spark):
    """run() and each of its stages keep the rows that plain versions keep on the same input."""
    items = [plain_words(r.text) for r in table(spark, SF, "benchmark").collect()]
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        rows = docs.collect()
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        left = sorted(r.doc_id for r in docs.select("doc_id").distinct().collect())
        if name == "quality_rules":
            want = [r.doc_id for r in rows if not plain_rejects(r.text)]
        elif name == "language_id":
            model = language_id.train(spark.createDataFrame(rows, docs.schema))
            want = [r.doc_id for r, ok in zip(rows, model.accepts([r.text for r in rows]), strict=True) if ok]
        elif name == "near_copies":
            want = {c if n else d for d, n, c in brute_components(rows, 5, 80)}
        elif name == "decontamination":
            want = [r.doc_id for r in rows if not plain_contaminated(r.text, items)]
        else:
            want = [r.doc_id for r in rows]
            total = collections.Counter()
            for r in docs.collect():
                total[r.doc_id] += r.length
            assert total == {r.doc_id: sum(-(-len(x) // 64) for x in re.findall(r"[^\x20\x09-\x0D]+", r.text)) + 1 for r in rows}
        assert left == sorted(want) and 0 < len(left) <= len(rows)
    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))


def test_pipeline_of_awkward_and_empty_tables(spark, awkward, empty):  # noqa: F811
    for docs in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.written(stage(spark, docs, SF), name)
            assert name == "packing" or docs.columns == columns
        assert docs.where(F.col("length") < 1).count() == 0


def test_extra_columns_of_pages(spark):
    """Columns of the same names as those that the writer makes are not read."""
    from batchlens.llm import warc
    pages = spark.createDataFrame([(i, "u", "<p>" + "x" * 2000, "s", 7, "d", "r") for i in range(3)],
                                  "page_id long, url string, html string, shard string, payload_bytes int, payload_digest string, refers string")
    folder = warc.work_path(spark, "warc-extra")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(warc.write(pages, folder), folder).collect()}
    assert got == {0: ("revisit", 2), 1: ("revisit", 2), 2: ("response", None)}


def test_one_id_is_packed_by_many_tasks(spark, monkeypatch):
    """Rows of one doc_id, equal or not, spread over the tasks; every piece is placed once."""
    from batchlens.llm import packing
    monkeypatch.setattr(packing, "BLOCK", 100)
    docs = spark.createDataFrame([(7, "a b c")] * 600 + [(7, "x " * i) for i in range(300)] + [(8, "y")], "doc_id long, text string")
    rows = packing.best_fit(docs).collect()
    tasks = collections.Counter(r.bin_id >> 40 for r in rows if r.doc_id == 7)
    assert len(rows) == 901 and len(tasks) >= 6 and max(tasks.values()) < 300
    assert sorted(r.length for r in rows) == sorted([4] * 600 + [i + 1 for i in range(300)] + [2])


def test_items_that_share_windows(spark):
    """A window of many items is met once a place, and still counts for all of them."""
    from batchlens.llm import winnowing
    phrase = " ".join(f"p{i}" for i in range(14))
    items = [(i, f"{phrase} own{i} words{i}" if i % 3 else f"{phrase} {' '.join(f'q{i}x{k}' for k in range(12))}") for i in range(60)]
    items += [(100, "short one"), (101, "short one"), (100, "another text of ten words that stands here by itself alone")]
    texts = [phrase, f"a {phrase} b", f"{phrase} own1 words1", "short one here", items[3][1], "nothing", None,
             f"short one {phrase} own1 words1"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    places, sets = winnowing.hits(docs, bench)
    # fourteen words are five windows, met once each although sixty items have them
    assert places.count() == places.distinct().count() and places.where("doc_id = 0").count() == 5
    assert sets.groupBy("set").count().where("count > 1").count() == 0
    got = {r.doc_id: (r.n_items, r.contaminated) for r in winnowing.decontaminate(docs, bench).collect()}
    for i, text in enumerate(texts):
        want = {k for k, t in items if plain_contaminated(text, [plain_words(t)])}
        assert got[i] == (len(want), bool(want))


def test_starts_of_files_are_summed_in_groups(spark, monkeypatch):
    monkeypatch.setattr(token_files, "GROUP", 3)
    rows = [(s, p, f"f{s}-{p}", 1, 10 * s + p + 1, 1, 1, "x") for s in range(11) for p in range(s % 3 + 1)]
    manifest = spark.createDataFrame(rows, token_files.MANIFEST).repartition(4)
    got = {r.file: r.base for r in token_files.starts(manifest).collect()}
    base = 0
    for r in sorted(rows):
        assert got[r[2]] == base
        base += r[4]
