"""Winnowing against its definition, and neighbours against a plain list."""

import hashlib
import random

import numpy as np

from pyspark.sql import functions as F

from textmill.llm import winnow


def _texts(n=60):
    rng = random.Random(11)
    return ["".join(rng.choice("ab é\U0001f600") for _ in range(rng.choice([0, 1, 5, 40, 300, 700]))) for _ in range(n)]


def _plain(text, k, w):
    with np.errstate(over="ignore"):
        grams = winnow.gram_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), k).tolist()
    high = [g >> 20 for g in grams]
    chosen = set()
    for i in range(max(1, len(high) - w + 1) if high else 0):
        window = high[i : i + w]
        chosen.add(i + max(j for j, x in enumerate(window) if x == min(window)))
    return sorted(chosen), [high[i] for i in sorted(chosen)]


def test_minimum_of_each_window_rightmost_of_equal_ones():
    for text in _texts() + ["a" * 500, "ab" * 300]:
        hashes, at = winnow.winnow(text, 8, 20)
        assert (at.tolist(), hashes.tolist()) == _plain(text, 8, 20)


def test_blocks_change_nothing(monkeypatch):
    texts = [t for t in _texts() if len(t) > 200] + ["ab" * 400]
    want = [winnow.winnow(t, 8, 20) for t in texts]
    monkeypatch.setattr(winnow, "_BLOCK", 64)
    for text, (hashes, at) in zip(texts, want, strict=True):
        got = winnow.winnow(text, 8, 20)
        assert got[0].tolist() == hashes.tolist() and got[1].tolist() == at.tolist()


def test_a_long_match_shares_a_hash():
    rng = random.Random(2)
    for _ in range(50):
        shared = "".join(rng.choice("abcdefgh") for _ in range(winnow.GRAM + winnow.WINDOW - 1))
        a, b = ("".join(rng.choice("xyzuvw") for _ in range(rng.randrange(300))) for _ in range(2))
        first, second = (winnow.winnow(x + shared + y) for x, y in ((a, b), (b, a)))
        places = [{(h, p - len(x)) for h, p in zip(*f, strict=True)} for f, x in ((first, a), (second, b))]
        assert places[0] & places[1]


def test_report(spark):
    texts = [None, *_texts(50), "last", "last"]
    rows = [(i * 7 % 101, t, "x", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, last string, part int").repartition(5)
    order = [(d, t or "") for d, t, *_ in sorted(rows)]
    got = {r.doc_id: r for r in winnow.fingerprint_report(docs).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert row.fingerprint == winnow.written(winnow.winnow(text)[0])
        assert row.positions_sha256 == winnow.places_digest(winnow.winnow(text)[1])
        assert row.edited_fingerprint == winnow.written(winnow.winnow(new)[0])
        sets = [set(winnow.winnow(t)[0].tolist()) for t in (text, new, following)]
        for value, other in ((row.near_edited, sets[1]), (row.near_next, sets[2])):
            both = sets[0] | other
            assert abs(value - (len(sets[0] & other) / len(both) if both else 1.0)) < 1e-12


def _mark(spark, text):
    return spark.range(1).select(F.shiftrightunsigned(F.xxhash64(F.lit(text)), 33)).first()[0], text


def test_hot_ids_are_dealt_into_ranges(spark, request):
    """A third of all rows without an id, a third with one: several ranges, one chain."""
    rows = [(None, f"null {i % 150}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)]
    rows += [(i, f"own {i}") for i in range(-100, 200) if i != 7]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.shuffle.partitions", before))
    sizes = winnow.followed(docs).where("not last").groupBy("part", "doc_id").count().collect()
    assert len([r for r in sizes if r.doc_id == 7]) > 1 and max(r["count"] for r in sizes) < 200
    marks = {r.text: r.m for r in docs.select("text", F.shiftrightunsigned(F.xxhash64("text"), 33).alias("m")).collect()}
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, marks[r[1]], r[1]))]
    want = sorted(hashlib.sha256(winnow.edited(a, b).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1]))
    assert sorted(r.edited_sha256 for r in winnow.fingerprint_report(docs).collect()) == want


def test_written_is_the_whole_hash():
    hashes = winnow.winnow("some text that is long enough to have a few hashes " * 9)[0]
    assert winnow.written(hashes) == "".join(f"{h:011x}" for h in hashes.tolist())
    assert winnow.written(hashes[:0]) == ""


def test_one_row_and_repeated_and_null_ids(spark):
    shape = "doc_id bigint, text string"
    one = winnow.fingerprint_report(spark.createDataFrame([(5, "abcd")], shape)).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest())]
    rows = [(None, "first"), (3, "bbbb"), (3, "aaaa"), (4, "dddd"), (4, "dddd")]
    got = winnow.fingerprint_report(spark.createDataFrame(rows, shape)).collect()
    order = sorted(["aaaa", "bbbb"], key=lambda t: _mark(spark, t))
    texts = ["first", *order, "dddd", "dddd"]
    want = sorted(hashlib.sha256(winnow.edited(a, b).encode()).hexdigest() for a, b in zip(texts, texts[1:] + texts[:1]))
    assert sorted(r.edited_sha256 for r in got) == want
    assert winnow.fingerprint_report(spark.createDataFrame([], shape)).count() == 0


def test_positions_are_kept(spark):
    docs = spark.createDataFrame([(1, "ab" * 90)], "doc_id bigint, text string")
    (row,) = winnow.fingerprints(docs).collect()
    hashes, at = winnow.winnow("ab" * 90)
    assert (row.hashes, row.positions) == (hashes.astype(np.int64).tolist(), at.tolist())
