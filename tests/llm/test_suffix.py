"""Suffix deduplication against counting all strings."""

import hashlib
import random
from collections import Counter

import numpy as np

from textmill.llm import suffix


def _texts():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, base = word(450), word(900)
    texts = [None, "", "short", "a" * 199, "b" * 200, "c" * 201, "xyz" * 300, "\U0001f600" * 120, base, base, word(3000)]
    texts += [word(rng.randrange(300)) + passage[: rng.randrange(150, 450)] + word(rng.randrange(300)) for _ in range(25)]
    texts += [base[:300] + word(7) + base[307:], base[100:] + word(30), word(50) + passage + word(20) + passage, passage[10:]]
    return texts


def _expected(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        change = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                change[i] += 1
                change[i + 200] -= 1
        gone = np.cumsum(change[:-1]) > 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), int(gone.sum()), spans, kept))
    return out


def _docs(spark, texts, ids=None):
    rows = [(i, t, "clash", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, anchor string, first int").repartition(4)


def test_all_strings_counted(spark, monkeypatch):
    texts = _texts()
    want = _expected(texts)
    for hot in (2048, 1):  # sorted in blocks, and as rows
        monkeypatch.setattr(suffix, "HOT", hot)
        got = {r.doc_id: r for r in suffix.deduplicated(_docs(spark, texts)).collect()}
        assert len(got) == len(texts)
        for i, (n, removed, spans, kept) in enumerate(want):
            row = got[i]
            assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == (n, removed, spans, kept), i
            assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeated_null_and_shared_ids(spark):
    texts = ["q" * 50 + "r" * 300, "q" * 50 + "r" * 300, "another text " * 30, "w" * 260, None]
    want = _expected(texts)
    got = suffix.deduplicated(_docs(spark, texts, [1, 1, 1, None, None])).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == sorted(w[:2] for w in want)
    assert suffix.deduplicated(_docs(spark, [""]).limit(0)).count() == 0


def test_many_texts_without_ids_or_of_one_id(spark):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(260)
    texts = [word(rng.randrange(10, 400)) + (passage + word(5)) * (i % 2) for i in range(1600)]
    want = _expected(texts)
    got = suffix.deduplicated(_docs(spark, texts, [None, 7] * 400 + [7, None] * 400)).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)


def test_difference_cover():
    for period in (7, 32, 64):
        cover, shift = suffix.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
        for i in range(period):
            for j in range(period):
                k = int(shift[i, j])
                assert (i + k) % period in cover and (j + k) % period in cover
    assert len(suffix.difference_cover(64)[0]) < 16


def test_sorted_repeats():
    rng = random.Random(8)
    for alphabet in ("ab", "abcdefgh"):
        text = "".join(rng.choice(alphabet) for _ in range(1500)).encode()
        text = text + text[200:700] + b"zz" + text[100:350] + b"y" * 500
        starts = sorted(rng.sample(range(len(text) - 200), 1200))
        seen = Counter(text[i : i + 200] for i in starts)
        assert sorted(suffix.sorted_repeats(text, starts)) == [i for i in starts if seen[text[i : i + 200]] > 1]


def test_groups_cover_all_starts_in_any_block(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    for windows in (1 << 19, 1000):
        monkeypatch.setattr(suffix, "_WINDOWS", windows)
        first, n, *_ = suffix.text_groups(data)
        assert np.concatenate([np.arange(f, f + k) for f, k in zip(first, n, strict=True)]).tolist() == list(range(len(data) - 199))
