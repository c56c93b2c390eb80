"""The operators against brute force, exact round trips and held-out accuracy, and on awkward rows."""
import collections
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from batchlens.llm import (language_id, language_model, license_scan, packing, parity_join, quality_model,
                           quality_rules, queries, token_files, warc, winnowing)
from batchlens.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, k string, node long"


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs in any column, empty and long texts, repeated rows, an id twice, columns with clashing names."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    near = [f"token{i}" for i in range(300)]
    rows = [(1, None, "en"), (2, "", "en"), (3, "   \n ", None), (None, "the only text without an id here", "de"),
            (5, long, "en"), (6, "a b", "fr"), (7, "a b", "fr"), (7, "a b", "fr"), (8, "gnu general\npublic license", "en"),
            (9, " ".join(near), "en"), (10, " ".join([*near[:-1], "other"]), "en"), (11, "12345 !!!", "en"),
            (11, "same id, another text", "es"), (12, "alpha beta gamma delta", "es")]
    return spark.createDataFrame([(i, t, g, None, None, "x", "y", 1) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = collections.Counter(tuple(map(str, r)) for r in cur.fetchall())
    assert collections.Counter(tuple(map(str, r)) for r in df.select(*names).collect()) == want


def test_language_id(spark, awkward, empty):
    docs = table(spark, SF, "documents")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    rows = language_id.language_id(awkward).collect()
    assert len(rows) == 14 and all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert language_id.language_id(empty).count() == 0
    assert language_id.filter_documents(awkward).columns == awkward.columns
    # slices and whole texts give the same margins
    w = np.random.default_rng(0).normal(size=(language_id.DIMENSIONS, 2)).astype(np.float32)
    texts = ["abc def", "ü" * 5000, "x y z " * 3000]
    whole, size = language_id.margins(texts, w), language_id.SLICE
    language_id.SLICE = 100
    np.testing.assert_allclose(language_id.margins(texts, w), whole, atol=1e-5)
    language_id.SLICE = size


def test_language_filter_rejects(spark):
    """Text in another language and letter gibberish go, held-out rows stay."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(80)) for _ in range(20)]
    texts += [x * 4 for x in (
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki. ",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. ",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler. ",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. ",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. ")]
    other = spark.createDataFrame([(10_000_000 + i, x, None) for i, x in enumerate(texts)], "doc_id long, text string, lang string")
    left = collections.Counter(r.doc_id for r in language_id.filter_documents(docs.unionByName(other)).collect())
    clean = [r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and len((r.text or "").split()) >= 50]
    assert len(clean) > 20 and all(left[d] for d in clean)
    assert not [d for d in left if d >= 10_000_000]


def test_quality_model(spark, awkward, empty):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality_model.quality_model(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    rows = quality_model.quality_model(awkward, labels).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality_model.quality_model(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_model(empty, labels).count() == 0


def test_quality_rules_edges(spark, awkward, empty):
    rows = quality_rules.quality_rules(awkward).collect()
    assert len(rows) == 14 and all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.filter_documents(awkward).columns == awkward.columns
    order = quality_rules.ordered(quality_rules.RULES, [quality_rules.Estimate(r.name, 1 + i, 0.5)
                                                        for i, r in enumerate(reversed(quality_rules.RULES))])
    assert [r.name for r in order] == [r.name for r in reversed(quality_rules.RULES)]


def test_license_edges(spark, awkward, empty):
    rows = {(r.doc_id, r.n_words): r for r in license_scan.license_scan(awkward).collect()}
    assert (rows[8, 4].n_base, rows[8, 4].first_word, rows[8, 4].base_labels) == (1, 0, "gpl")
    assert rows[1, 0].score == 0 and rows[5, 30_000].n_base == 0
    assert license_scan.license_scan(empty).count() == 0


def test_winnowing_edges(spark, awkward, empty):
    items = spark.createDataFrame([(1, "a b"), (2, None), (3, "alpha beta"), (3, "beta gamma"),
                                   (4, " ".join(f"token{i}" for i in range(290, 300)))], "item_id long, text string")
    rows = collections.defaultdict(list)
    for r in winnowing.decontaminate(awkward, items).collect():
        rows[r.doc_id].append(r)
    assert sum(map(len, rows.values())) == 14
    assert [r.n_hit for r in rows[7]] == [2, 2] and rows[12][0].n_hit == 3 and rows[12][0].n_items == 1
    assert rows[9][0].n_hit == 10 and rows[10][0].n_hit == 0 and rows[1][0].n_words == 0
    assert rows[12][0].items_sha256 == hashlib.sha256(b"3").hexdigest()
    left = winnowing.drop_contaminated(awkward, items)
    assert left.columns == awkward.columns and left.count() == 14 - 3 - 1 - 1
    assert winnowing.decontaminate(empty, items).count() == 0
    assert not any(r.contaminated for r in winnowing.decontaminate(awkward, items.limit(0)).collect())


def test_warc_edges(spark):
    big = "<p>" + "é" * 600
    pages = spark.createDataFrame([(1, "u", big), (3, "v\r\nw", big), (2, None, big), (4, "u", "small"), (5, "u", "small"),
                                   (6, "u", None), (None, "u", ""), (7, "u", "x" * 3_000_000)],
                                  "page_id long, url string, html string")
    folder = warc.work_path(spark, "warc-test")
    got = {r.page_id: r for r in warc.read(warc.write(pages, folder), folder).collect()}
    assert len(got) == 8 and got[3].record_type == "response"
    assert (got[1].refers_to, got[2].record_type, got[2].payload_bytes) == (3, "revisit", 1203)
    assert got[6].payload_digest == hashlib.sha1(b"").hexdigest() and got[4].record_type == "response"
    # other partitions, equal files
    other = warc.work_path(spark, "warc-test")
    sums = [sorted((r.file, r.sha1) for r in m.collect()) for m in
            (spark.read.parquet(folder + "/manifest"), warc.write(pages.repartition(5), other))]
    assert sums[0] == sums[1]
    none = warc.work_path(spark, "warc-test")
    assert warc.read(warc.write(pages.limit(0), none), none).count() == 0


def test_packing(spark, awkward, empty):
    docs = table(spark, SF, "documents")
    got = packing.best_fit(docs).collect()
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1 for r in docs.collect()}
    pieces = collections.defaultdict(int)
    bins = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id] += r.length
        bins[r.bin_id].append(r)
    assert pieces == words
    for rows in bins.values():
        used = sum(r.length for r in rows)
        assert {r.bin_length for r in rows} == {used}
        assert {r.capacity for r in rows} == {min(c for c in packing.CAPACITIES if c >= used)}
        assert sorted(r.bin_offset for r in rows) == list(np.cumsum([0] + [r.length for r in sorted(
            rows, key=lambda r: r.bin_offset)])[:-1])
    assert {r.doc_id: r.length for r in packing.best_fit(awkward).collect()}[1] == 1
    assert packing.best_fit(empty).count() == 0


def test_packing_of_long_words(spark):
    """Text without blanks counts by its characters and is cut like any other."""
    texts = ["x" * 64, "x" * 65, "語" * 1_000_000, "a " + "b" * 640 + "\nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    total, most = collections.Counter(), 0
    for r in packing.best_fit(docs).collect():
        total[r.doc_id] += r.length
        most = max(most, r.length)
    assert total == {0: 2, 1: 3, 2: 15_626, 3: 13} and most == 8192


def test_packing_is_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 300).tolist()
    room, want, left = [], [0] * 300, sum(lengths)
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        fits = [(r, b) for b, r in enumerate(room) if r >= lengths[i]]
        b = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(packing.new_bin(lengths[i], left))
        room[b] -= lengths[i]
        want[i], left = b, left - lengths[i]
    assert [p[0] for p in packing.pack(lengths)] == want


def test_token_files(spark, awkward, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer = Tokenizer.from_file(path)
    for docs, n in ((table(spark, SF, "documents"), None), (awkward, 14), (empty, 0)):
        folder = token_files.work_path(spark, "tokens-test")
        got = {(r.start): r for r in token_files.read(token_files.write(docs, folder, path), folder).collect()}
        rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
        assert len(got) == len(rows) and n in (None, len(rows))
        start = 0
        for r in rows:
            ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
            assert (got[start].doc_id, got[start].n_tokens) == (r.doc_id, len(ids))
            assert got[start].ids_crc32 == zlib.crc32(ids.tobytes())
            start += len(ids)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 6, n).astype("<u4") for n in (1, 500, 2, 3000, 1)]
    f = token_files.TokenFile(token_files.pack([3, None, 5, 6, 7], [t.tobytes() for t in texts], 50))
    assert f.doc_ids == [3, None, 5, 6, 7] and len(f.rules) > 10
    for i, t in enumerate(texts):
        assert f.document(i).tolist() == t.tolist()
        assert [f.token(i, p) for p in range(len(t))] == t.tolist()


def test_language_model(spark, awkward, empty):
    docs = table(spark, SF, "documents")
    rows = language_model.language_model(docs).collect()
    p, vocabulary = language_model.train(docs)
    ids = vocabulary.ids(docs.first().text)
    scorer = language_model.Scorer(p, vocabulary)
    # the whole distribution sums to one, and a document's score is the sum over its words
    padded = language_model._padded(ids)
    total = 0.0
    for i in range(language_model.IDS):
        trial = padded.copy()
        trial[language_model.SIDE] = i
        total += np.exp(scorer.log_probabilities(trial, np.array([language_model.SIDE]))[0])
    assert abs(total - 1) < 1e-3
    counts = np.bincount(np.concatenate([vocabulary.ids(r.text) for r in docs.collect()]), minlength=language_model.IDS)
    unigram = (counts * np.log(np.maximum(counts, 1) / counts.sum())).sum()
    assert sum(r.log_prob for r in rows) > unigram
    got = {(r.doc_id, r.n_words): r for r in language_model.language_model(awkward).collect()}
    assert got[1, 0].log_prob == 0 and got[1, 0].mean_log_prob is None and got[5, 30_000].log_prob < 0
    assert language_model.language_model(empty).count() == 0


def test_language_model_rare_words(spark):
    """A word that shares its id counts with its own part of the id, and an unseen one with the smallest."""
    docs = table(spark, SF, "documents")
    counts = collections.Counter(w for r in docs.collect() for w in (r.text or "").encode().lower().split())
    p, vocabulary = language_model.train(docs)
    rare, words = collections.defaultdict(dict), set(vocabulary.words)
    for w, n in counts.items():
        if w.decode() not in words:
            rare[zlib.crc32(w) % language_model.RARE][w] = n

    def within(w):
        if w.decode() in words:
            return 0.0
        own = rare[zlib.crc32(w) % language_model.RARE]
        return np.log((own.get(w, 0) + 1) / (sum(own.values()) + len(own) + 1))

    table_of = language_model.rare_counts(language_model.count_words(docs), vocabulary.words)
    junk = "qzxv kkjq\nXXÜq wvvz qqqj zzzk vvxq jjkw qqxz zzvk"
    texts = [docs.first().text, junk, None, "", "the the", docs.first().text]
    trial = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_model.scored(trial, language_model.Scorer(p, vocabulary), table_of).collect()}
    assert len(got) == 6 and got[2].word_log_prob == 0 and got[2].mean_log_prob is None
    for i, t in enumerate(texts):
        want = got[i].log_prob + sum(map(within, (t or "").encode().lower().split()))
        assert abs(got[i].word_log_prob - want) < 1e-6 * max(1, abs(want))
    rows = language_model.language_model(docs).where("n_words >= 50").collect()
    assert got[1].mean_log_prob < np.quantile([r.mean_log_prob for r in rows], 0.02)


def test_language_model_trains_on_every_word(monkeypatch):
    """Each word of each document is a target once, with the words around it, and the gradients are exact."""
    import pandas as pd

    seen, step = [], language_model.step
    monkeypatch.setattr(language_model, "BATCH", 64)
    monkeypatch.setattr(language_model, "step", lambda p, c, t: seen.extend(map(tuple, np.column_stack((c, t)))) or step(p, c, t))
    texts = [" ".join(f"w{i * i % 89}" for i in range(n)) for n in (1, 7, 300, 64)] + [None, ""]
    vocabulary = language_model.Vocabulary([f"w{i}" for i in range(60)])
    start = language_model.initial(np.ones(language_model.IDS))
    (out,) = language_model._trainer(start, vocabulary)([pd.DataFrame({"text": texts})])
    want = []
    for t in texts:
        x = language_model._padded(vocabulary.ids(t))
        want += [(x[i - 2], x[i - 1], x[i + 1], x[i + 2], x[i]) for i in range(2, len(x) - 2)]
    assert sorted(seen) == sorted(want) and out.n[0] == len(want) == 372

    p = {k: v.astype(np.float64) for k, v in start.items()}
    context, target = np.array([w[:4] for w in want]), np.array([w[4] for w in want])

    def loss():
        h = np.tanh(sum(p["E"][context[:, k]] @ p["W"][k] for k in range(4)) + p["b"])
        c, d = target // language_model.WIDTH, target % language_model.WIDTH
        top = language_model._log_softmax(h @ p["C"] + p["c"])[np.arange(len(c)), c]
        low = language_model._log_softmax(np.einsum("nh,nhw->nw", h, p["D"][c]) + p["d"][c])[np.arange(len(c)), d]
        return -(top + low).mean()

    g = step(p, context, target)
    for k, at in (("E", (3, 5)), ("E", (language_model.IDS, 2)), ("W", (0, 4, 7)), ("W", (3, 1, 1)), ("b", (9,)),
                  ("C", (2, 1)), ("D", (1, 4, 6))):
        p[k][at] += 1e-5
        up = loss()
        p[k][at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[k][at]) < 1e-6 + 1e-3 * abs(g[k][at])
        p[k][at] += 1e-5


def brute_components(rows, k, percent):
    sets = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root[i], root[j]
                root = [min(x, y) if z in (x, y) else z for z in root]
    least = {}
    for r, z in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[z] = min(least.get(z, r.doc_id), r.doc_id)
    return sorted(((-1 if r.doc_id is None else r.doc_id, len(s), least.get(z, -1))
                   for r, s, z in zip(rows, sets, root, strict=True)))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_parity_join(spark, awkward, empty, k, percent):
    for docs in (table(spark, SF, "documents"), awkward):
        got = sorted((*(-1 if x is None else x for x in (r.doc_id, r.n_shingles, r.component_id)),)
                     for r in parity_join.parity_join(docs, k, percent).collect())
        assert got == brute_components(docs.collect(), k, percent)
    assert parity_join.parity_join(empty, k, percent).count() == 0


def test_near_copies_of_repeated_and_null_ids(spark, awkward):
    """One row of each group of texts stays, whatever the ids are."""
    words = {c: [f"{c}{i}" for i in range(60)] for c in "abcdef"}
    text = {c: " ".join(w) for c, w in words.items()}
    near = {c: " ".join([*w[:-1], "other"]) for c, w in words.items()}
    rows = [(1, text["a"]), (1, text["b"]), (1, text["c"]), (2, near["a"]), (1, text["b"]),  # an id with three texts
            (None, text["d"]), (None, near["d"]), (None, text["d"]),  # copies without ids
            (None, text["e"]), (9, near["e"]), (None, text["f"]), (None, text["f"]),
            (3, None), (3, None), (None, ""), (4, "  ")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, k string")
    out = parity_join.drop_near_copies(docs)
    assert out.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in out.collect())
    one_d = [t for t in (text["d"], near["d"]) if (None, t) in got]
    assert len(one_d) == 1
    assert got == collections.Counter([(1, text["a"]), (1, text["b"]), (1, text["c"]), (None, one_d[0]), (9, near["e"]),
                                       (None, text["f"]), (3, None), (3, None), (None, ""), (4, "  ")])
    left = collections.Counter(r.doc_id for r in parity_join.drop_near_copies(awkward).collect())
    assert left[11] == 2 and left[None] == 1 and left[6] + left[7] == 1 and left[9] + left[10] == 1


def test_sketch_loses_no_link():
    """Sets at the threshold always share a key and always pass the sketch distance."""
    rng = np.random.default_rng(3)
    for percent in (90, 80):
        sketch = parity_join.Sketch(percent)
        for n in (1, 2, 7, 19, 40, 95, 300, 1500):
            for _ in range(12):
                out = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                b = np.unique(np.concatenate((a[out:], rng.integers(0, 1 << 63, int(rng.integers(0, out + 1))).astype(np.uint64))))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    assert len(np.intersect1d(sketch.keys(a), sketch.keys(b)))
                    sizes = np.array([len(a), len(b)])
                    assert len(parity_join.close(sizes, [parity_join.sketch_of(a), parity_join.sketch_of(b)], 0, percent)[0])


def test_large_groups_in_tiles(spark, monkeypatch):
    """Blocks of a few sets give the groups that one block gives."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i % 190], f"x{i}", *base[i % 190 + 1:]])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(parity_join, "GROUP", 5)
    monkeypatch.setattr(parity_join, "TILE", 1500)
    got = parity_join.parity_join(docs, 3, 90).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 40
