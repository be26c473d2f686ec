"""Quality, toxicity and language: counts against plain ones, held-out accuracy, edges."""

import random
import re
import zlib

import numpy as np

from textmill.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text):
    words, lines = WORD.findall(text), text.split("\n")
    seen, dup = set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    cover = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            cover |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_statistics():
    rng = random.Random(6)
    texts = ["", " \n ", "a", "é | # \U0001f600 x", "same line\nsame line\n\n\nsame line ", "a b " * 20]
    texts += [" ".join(rng.choice(["ab", "c\n", "é", "|x", "\t"]) for _ in range(rng.randrange(80))) for _ in range(120)]
    for text in texts:
        assert quality.statistics(text)[:5] == _plain(text)


def test_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(not (r.base_failed and r.kept) for r in rows.values())
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows.values())
    kept = {0: [], 1: []}
    for r in labels.collect():
        if not rows[r.doc_id].base_failed:
            kept[r.quality].append(rows[r.doc_id].kept)
    assert np.mean(kept[1]) >= 0.99 and np.mean(kept[0]) <= 0.6


def _few(spark, texts):
    rows = [(i, t, "c", 1) for i, t in enumerate(texts)] + [(0, texts[0], "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, step string, quality int")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (1, 0, 1), (None, None, None), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_few_rows(spark):
    docs, labels = _few(spark, [None, "", "... 123", "word " * 30, "a b c d e f g h i j k l m n o p q r s t u"])
    got = quality.judge(docs, labels).collect()
    assert len(got) == 6 and {r.doc_id for r in got if r.base_failed} == {0, 1, 2, 3}
    scored = toxicity.score(docs, labels).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    named = langid.identify(docs.selectExpr("*", "cast(null as string) as lang")).collect()
    assert {(r.lang_pred, r.score) for r in named} == {("und", 0.0)} and len(named) == 6
    for result in (quality.judge, toxicity.score, toxicity.accepted):
        assert result(docs.limit(0), labels.limit(0)).count() == 0
    assert langid.identify(docs.limit(0).selectExpr("*", "'x' as lang")).count() == 0


def test_forest_isolates_odd_rows():
    rng = np.random.default_rng(0)
    rows = np.r_[rng.normal(0, 1, (500, 3)), [[9, 9, 9], [-8, 7, 9]]]
    scores = quality.anomaly(rows, quality.fit_forest(rows))
    assert set(np.argsort(scores)[-2:]) == {500, 501}


def test_threshold():
    assert quality.threshold([(10, 50, 0), (20, 50, 1), (30, 0, 9)], 0.0) == 30
    assert quality.threshold([(10, 50, 0), (20, 50, 1), (30, 0, 9)], 0.5) == 20
    assert quality.threshold([(10, 50, 0)]) == quality.STEPS + 1


def test_grammar():
    scorer = toxicity.Scorer({"scoundrel": 1.0, "lout": 0.5})
    kinds = {"plain": 0, "aimed": 1, "negated": 2, "reported": 3, "menace": 4}
    cases = {
        "A scoundrel walked by.": {"plain": 1.0},
        "You are a louts!": {"aimed": 0.5},
        "What a lout you are": {"plain": 0.5, "aimed": 0.5},
        "He is not a scoundrel.": {"negated": 1.0},
        'She said he was "a scoundrel".': {"reported": 1.0},
        "I will hurt you.": {"menace": 1.0},
        "I will not hurt you. They hurt.": {},
        "You left. The lout stayed.": {"plain": 0.5},
        "unlouted clouts": {},
        "C'est l'lout, d'louts": {"plain": 1.0},
        "You’re a lout’s friend": {"aimed": 0.5},
        "I will not\nhurt you.": {},
        "I will not\n\nhurt you.": {"menace": 1.0},
        "You left\nThe lout stayed": {"plain": 0.5},
        "You are one,\r\n lout": {"aimed": 0.5},
        "He isn’t a lout": {"negated": 0.5},
        "": {},
    }
    for text, want in cases.items():
        expected = [0.0] * 5
        for kind, value in want.items():
            expected[kinds[kind]] = value
        assert scorer.evidence(text) == expected, text


def test_quotations_over_several_clauses():
    scorer = toxicity.Scorer({"scoundrel": 1.0, "lout": 0.5})
    cases = {
        'She wrote: "You are a lout. You scoundrel."': [0, 0, 0, 1.5, 0],
        'She wrote: "Go away!\nYou scoundrel."': [0, 0, 0, 1.0, 0],
        'She wrote: "You are a lout. Go." You scoundrel.': [0, 1.0, 0, 0.5, 0],
        "Er schrieb: „Geh. Du lout.“ Du scoundrel.": [0, 1.0, 0, 0.5, 0],
        'She wrote: "Hello. You are a lout. You scoundrel.': [0, 1.5, 0, 0, 0],
        'She wrote. "Go. You lout."': [0, 0.5, 0, 0, 0],
        'She said it. "Well." He is not here. The lout is.': [0.5, 0, 0, 0, 0],
    }
    for text, want in cases.items():
        assert scorer.evidence(text) == want, text


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out]
    clean, toxic = ([r.predicted for r in held if r.toxic == t] for t in (0, 1))
    assert np.mean(clean) < 0.01 and np.mean(toxic) > 0.85


def test_accepted_keeps_columns(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    kept = toxicity.accepted(docs, labels)
    assert kept.schema == docs.schema or [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    want = {r.doc_id for r in toxicity.score(docs, labels).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == want


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en"), (-2, "123 !", None), (-3, "中", None)], "doc_id bigint, text string, lang string")
    rows = langid.identify(docs.select("doc_id", "text", "lang").unionByName(extra)).collect()
    langs = {r.doc_id: r.lang for r in docs.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (r.doc_id in (-1, -2))
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and r.doc_id >= 0]
    assert np.mean(held) > 0.98


def test_most_weights_are_zero():
    rng = np.random.default_rng(2)
    model = langid.FollowTheLeader(2)
    for _ in range(300):
        label = int(rng.integers(2))
        at = np.unique(np.r_[label, rng.integers(10, 2000, 20)])
        model.learn(at, np.full(len(at), 1 / np.sqrt(len(at))), label)
    weights = model.weights(slice(None))
    assert (weights[:, 2000:-1] == 0).all() and weights[0, 0] > 0 > weights[1, 0]
    assert langid.temperature(np.array([[9.0, 0], [0, 9.0], [9.0, 0]]), np.array([0, 1, 1])) > 1


def test_rare_language_is_learned(spark):
    rng = random.Random(9)
    word = lambda signs: "".join(rng.choices(signs, k=rng.randint(2, 7)))
    text = lambda signs: " ".join(word(signs) for _ in range(15))
    rows = [(i, text("etaoinshr"), "en") for i in range(6000)]
    rows += [(10_000 + i, text("абвгдежзик"), "ru") for i in range(12)] + [(7, text("etaoinshr"), "en")] * 3000
    rows += [(20_000, text("абвгдежзик"), None), (None, text("абвгдежзик"), "ru")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    sample = langid.sampled(docs.where("lang is not null")).toPandas()
    assert sample.doc_id.is_unique and (sample.lang == "ru").sum() == 12
    assert langid.FIT_ROWS <= len(sample) <= langid.FIT_ROWS + 2 * langid.LANG_ROWS
    named = {(r.doc_id, r.lang_pred) for r in langid.identify(docs).collect() if r.doc_id is None or r.doc_id >= 10_000}
    assert {lang for _, lang in named} == {"ru"} and len(named) == 14


def test_proximal_update_equals_a_plain_one():
    rng = random.Random(4)
    model = langid.FollowTheLeader(3)
    z, n = ([{} for _ in range(3)] for _ in range(2))

    def weight(c, i):
        value = z[c].get(i, 0.0)
        if abs(value) <= langid.L1:
            return 0.0
        rate = (langid.BETA + n[c].get(i, 0.0) ** 0.5) / langid.ALPHA + langid.L2
        return -(value - langid.L1 * (1 if value > 0 else -1)) / rate

    for _ in range(200):
        at = sorted(rng.sample(range(40), 6))
        values, label = [rng.random() for _ in at], rng.randrange(3)
        model.learn(np.array(at), np.array(values), label)
        row = [*zip(at, values, strict=True), (langid.FEATURES, 1.0)]
        logits = [sum(weight(c, i) * v for i, v in row) for c in range(3)]
        total = sum(np.exp(x) for x in logits)
        for c in range(3):
            error = np.exp(logits[c]) / total - (c == label)
            for i, v in row:
                slope, before = error * v, n[c].get(i, 0.0)
                change = ((before + slope**2) ** 0.5 - before**0.5) / langid.ALPHA
                z[c][i] = z[c].get(i, 0.0) + slope - change * weight(c, i)
                n[c][i] = before + slope**2
    for c in range(3):
        want = [weight(c, i) for i in [*range(40), langid.FEATURES]]
        assert np.allclose(model.weights([*range(40), langid.FEATURES])[c], want, atol=1e-9)
