"""Near duplicates against comparing all pairs, and the sampling against its theory."""

import random

import numpy as np
import pytest

from textmill.llm import neardup


def _texts(seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \n", "one", "one", "three short words"]
    for size in (60, 300, 900):
        for _ in range(6):
            base = fresh(size)
            texts.append(" ".join(base))
            for changes in (1, 1, size // 40, size // 12):
                copy = list(base)
                for _ in range(changes):
                    copy[rng.randrange(size)] = rng.choice(vocabulary)
                texts.append(" ".join(copy))
    chain = fresh(200)  # each near the next, the ends far apart
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = chain[12:] + fresh(12)
    base = fresh(150)  # a crowd: most are near the first, which is no copy's centre
    for i in range(90):
        copy = list(base)
        for at in rng.sample(range(150), 1 + i % 6):
            copy[at] = rng.choice(vocabulary)
        texts.append(" ".join(copy[: 150 - i % 3]))
    line = " ".join(fresh(30))
    return texts + [line + "\n" + " ".join(fresh(80)) for _ in range(20)] + texts[6:9]


def _docs(spark, texts):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, digest string, sim int").repartition(4)


def _classes(texts):
    texts = [t or "" for t in texts]
    parts = [neardup.shingles(t) for t in texts]
    df = np.zeros(neardup.PLACES)
    for hashes, _ in parts:
        df[np.unique(neardup.places(hashes))] += 1
    idf = 1 - np.log10(np.maximum(df / len(texts), neardup.COMMON))
    root = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j in range(i):
            if root[i] != root[j] and (a == texts[j] or (a.split() and texts[j].split() and neardup.similarity(a, texts[j], idf) >= 0.8)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def test_classes_equal_those_of_all_pairs(spark):
    texts = _texts()
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(_docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == _classes(texts)
    kept = neardup.deduplicated(_docs(spark, texts))
    assert kept.columns == ["doc_id", "text", "digest", "sim"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_what_cannot_be_linked_is_not_compared(spark):
    """Of texts far from the first one, only those that the bound allows are compared,
    and with them all that could be linked."""
    texts = _texts()[100:-24]
    idf = np.ones(neardup.PLACES)
    rows = []
    for i, text in enumerate(texts[1:], 1):
        sim, size, both, besides, more = neardup.compared(texts[0], text, idf)
        rows.append((bytes([0]), bytes([i]), sim, size, both, besides.astype(np.int64).tolist(), more.tolist()))
    shape = "a binary, b binary, sim double, size double, both double, besides array<bigint>, more array<double>"
    none = spark.createDataFrame([], "node binary, root binary")
    got = {(r.a[0], r.b[0]) for r in neardup._still_possible(spark.createDataFrame(rows, shape), none, 0.8).collect()}
    near = {(i, j) for j in range(1, len(texts)) for i in range(1, j) if neardup.similarity(texts[i], texts[j], idf) >= 0.8}
    assert near and near <= got and len(got) < len(texts) ** 2 / 3


def test_repeated_rows_and_empty_table(spark):
    docs = _docs(spark, ["a b c d e f", "g h"])
    got = neardup.near_duplicates(docs.unionByName(docs)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    assert neardup.deduplicated(docs.unionByName(docs)).count() == 2
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(0)
    agree, expected = [], []
    for _ in range(60):
        hashes = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
        w1 = rng.uniform(0.5, 8, len(hashes))
        w2 = np.where(rng.random(len(hashes)) < 0.8, w1, rng.uniform(0.5, 8, len(hashes)))
        agree.append((neardup.samples(hashes, w1) == neardup.samples(hashes, w2)).mean())
        expected.append(np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum())
    assert abs(np.mean(agree) - np.mean(expected)) < 0.02


def test_chunks_change_nothing(monkeypatch):
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64))
    want = neardup.samples(hashes, np.full(len(hashes), 2.0))
    monkeypatch.setattr(neardup, "_CHUNK", 7)
    assert (neardup.samples(hashes, np.full(len(hashes), 2.0)) == want).all()


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)]
    root = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    frame = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {r.node[0]: r.root[0] for r in neardup.components(frame, "test").collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in root.items() if n in linked}
