"""Rows known by their place in files, hash trees, and the n-gram model."""

import json
import math
import random
import time
import uuid
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill import session
from textmill.checks import queries
from textmill.operators import gramblocks, hashtree, ngram, overlap, split
from textmill.sources import corpus, ordered


def _lines(folder, name, texts):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("".join(json.dumps({"text": t}) + "\n" + "\n" * (len(t) % 2) for t in texts))


@pytest.mark.parametrize("block", ["128m", "200b"])
def test_places_do_not_depend_on_how_files_are_cut(spark, out, block):
    texts = [f"line {i} " + "x" * (i % 7) for i in range(300)]
    for name, part in (("part-00000.json", texts[:100]), ("part-00001.json", []), ("part-00002.json", texts[100:])):
        _lines(out, name, part)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = ordered.read_ordered(spark, out).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.ordinal: r.text for r in rows} == dict(enumerate(texts))


def test_positional_pairs_end_with_the_shorter_side(spark, out):
    _lines(f"{out}/p", "a.json", ["p0", "p1"])
    _lines(f"{out}/p", "b.json", ["p2", "p3", "p4"])
    _lines(f"{out}/r", "a.json", ["r0", "r1", "r2"])
    said, known = (ordered.read_ordered(spark, f"{out}/{side}") for side in "pr")
    got = sorted(tuple(r) for r in overlap.pair_by_position(known, said).collect())
    assert got == [(0, "p0", "r0"), (1, "p1", "r1"), (2, "p2", "r2")]


def test_files_of_a_split_hold_the_seeded_order(spark, out, texts):
    rows = texts([f"text number {i}" for i in range(200)], parts=7)
    assigned = split.assign_splits(rows)
    corpus.write_splits(assigned, out)
    in_order = [r.doc_id for r in split.seeded_order(rows).collect()]
    for name in ("train", "val", "test"):
        files = sorted(Path(f"{out}/split={name}").glob("part-*.json"))
        ids = [json.loads(line)["doc_id"] for f in files for line in f.read_text().splitlines()]
        mine = {r.doc_id for r in assigned.where(F.col("split") == name).collect()}
        assert ids == [i for i in in_order if i in mine]


def test_what_differs_between_versions(spark, texts):
    rows = texts([f"text number {i}" for i in range(500)])
    later = rows.where("doc_id <> 3").withColumn("text", F.when(F.col("doc_id") == 8, "new").otherwise(F.col("text")))
    later = later.unionByName(spark.createDataFrame([(900, "more")], "doc_id bigint, text string")).repartition(5)
    trees = [hashtree.hash_tree(t) for t in (rows, later)]
    roots = [t.where("level = 0").first() for t in trees]
    assert [r.n_rows for r in roots] == [500, 500] and roots[0].hash != roots[1].hash
    buckets = hashtree.changed_buckets(*trees)
    assert buckets.count() == 3
    changes = {(r.row_key, r.change) for r in hashtree.changed_rows(rows, later, buckets).collect()}
    assert changes == {("3", "removed"), ("8", "changed"), ("900", "added")}
    again = hashtree.hash_tree(rows.repartition(9))
    assert hashtree.changed_buckets(trees[0], again).count() == 0
    assert {r.bucket for r in hashtree.changed_buckets(trees[0].where("false"), again).collect()} == {
        r.bucket for r in again.where("level = 2").collect()
    }


def _plain_losses(train, test, order):
    grams = [Counter() for _ in range(order)]
    for text in train:
        words = (text or "").lower().split()
        for k in range(order):
            grams[k].update(tuple(words[i - k : i + 1]) for i in range(k, len(words)))
    size = sum(grams[0].values()) + len(grams[0]) + 1

    def p(words):
        if len(words) == 1:
            return (grams[0][words] + 1) / size
        after = [n for g, n in grams[len(words) - 1].items() if g[:-1] == words[:-1]]
        if not after:
            return p(words[1:])
        return (max(grams[len(words) - 1][words] - 0.75, 0) + 0.75 * len(after) * p(words[1:])) / sum(after)

    found = []
    for text in test:
        words = (text or "").lower().split()
        logs = [-math.log(p(tuple(words[max(0, i - order + 1) : i + 1]))) for i in range(1, len(words))]
        found.append((sum(logs) / len(logs) if logs else None, len(words)))
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
def test_losses_equal_plain_counting(texts, order):
    rng = random.Random(order)
    make = lambda n: [" ".join(rng.choice("a B c d e f".split()) for _ in range(rng.randrange(25))) for _ in range(n)]
    train, test = [*make(30), None, ""], [*make(20), None, "", "one", "never seen", "a a a a never a"]
    rows = ngram.token_losses(texts(test), texts(train), order).collect()
    for r, (loss, n) in zip(sorted(rows), _plain_losses(train, test, order), strict=True):
        assert r.n_tokens == n
        assert (r.loss is None) if loss is None else abs(r.loss - loss) < 1e-9


@pytest.mark.parametrize("order", [1, 2, 3])
def test_losses_from_small_blocks_and_shared_contexts(texts, monkeypatch, order):
    for name, value in (("BLOCK", 40), ("BUCKET", 50), ("SPLIT", 3)):
        monkeypatch.setattr(gramblocks, name, value)
    rng = random.Random(order)
    made = [" ".join(rng.choice(["a", "a", "B", "c\u2003d", "\u00e9", "f"]) for _ in range(rng.randrange(25))) for _ in range(60)]
    table = texts([*made, None, "", "one"])
    for test, train in ((table, table), (texts(made[:20]), texts(made[20:]))):
        rows = ngram.token_losses(test, train, order).collect()
        said, learned = ([r.text for r in t.sort("doc_id").collect()] for t in (test, train))
        for r, (loss, n) in zip(sorted(rows), _plain_losses(learned, said, order), strict=True):
            assert r.n_tokens == n and ((r.loss is None) if loss is None else abs(r.loss - loss) < 1e-9)


def test_losses_of_odd_tables(spark, texts):
    none = texts([]).where("false")
    assert ngram.token_losses(none, none).collect() == ngram.token_losses(none, texts(["a b"])).collect() == []
    rows = spark.createDataFrame([("x", "a b"), (None, "a b c"), ("y", " \u2003"), ("z", None)], "doc_id string, text string")
    told = {r.doc_id: (r.loss is None, r.n_tokens) for r in ngram.token_losses(rows, rows).collect()}
    assert told == {"x": (False, 2), None: (True, 3), "y": (True, 0), "z": (True, 0)}
    blank = rows.where("doc_id in ('y', 'z')")
    assert [r.loss for r in ngram.token_losses(blank, blank, order=3).collect()] == [None, None]


def test_losses_agree_with_probabilities_of_ngrams(spark, texts):
    train, words = texts(["a b a c a b", "b b c", "c a"]), "a c b b unseen a"
    ((_, loss, n),) = ngram.token_losses(texts([words]), train).collect()
    grams = spark.createDataFrame(list(zip(words.split()[1:], words.split())), "word string, h1 string")
    told = [-math.log(r.p) for r in ngram.probabilities(grams, train).collect()]
    assert n == 6 and abs(loss - sum(told) / 5) < 1e-12


def test_losses_store_a_few_bytes_for_a_token(texts, out, monkeypatch):
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: f"{out}/{name}")
    rng = random.Random(4)
    table = texts([" ".join(f"word{rng.randrange(5000)}" for _ in range(1000)) for _ in range(200)])
    assert ngram.token_losses(table, table).count() == 200
    assert sum(p.stat().st_size for p in Path(out).rglob("*.parquet")) < 4 * 200_000


def test_shuffle_files_go_with_the_write(spark, out, monkeypatch):
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: f"{out}/{uuid.uuid4().hex}")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left(release):
        """Shuffle files of a write, after the time that background work may need to remove them."""
        before, until = set(disk.getAllFiles().mkString(",").split(",")), time.time() + 10
        session.materialize(spark.range(100).repartition(3, "id"), "rows", release=release)
        while True:
            new = {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f} - before
            if not new or not release or time.time() > until:
                return new
            time.sleep(0.1)

    assert left(False) and not left(True) and left(False)


@pytest.mark.parametrize("values", [[], [0], [0, 255, 256, 7], [1 << 40, 3], [(1 << 62) + 1]])
def test_packed_numbers_come_back(values):
    assert gramblocks.unpack(gramblocks.pack(np.array(values, dtype=np.int64))).tolist() == values


def test_tasks_hand_on_counts_they_cannot_hold(texts, monkeypatch):
    monkeypatch.setattr(ngram, "MOST_HELD", 3)
    train = ["a b a c a b", "", None, "B b\u2003c", "c a", "a b a c a b"]
    by_text = ngram._tally(texts(train), 3, None, "doc_id").collect()
    assert sum(r.times for r in by_text) == 17
    assert [tuple(r[1:]) for r in by_text if r.doc_id == 3 and r.h1] == [("b", "b", "", 1), ("c", "b", "b b", 1)]
    parts = ngram._tally(texts(train, 1), 2, None, None).collect()
    counts = {}
    for r in parts:
        counts[r.h1, r.word] = counts.get((r.h1, r.word), 0) + r.times
    assert counts["a", "b"] == 4 and counts["", "a"] == 2 and len(parts) > len(counts)


def test_probabilities_add_up_to_one(spark, texts):
    train = texts(["a b a c a b", "b b c", "c a"])
    vocabulary = ["a", "b", "c", "unseen"]
    grams = spark.createDataFrame([(w, h) for w in vocabulary for h in ("a", "b", "zz")], "word string, h1 string")
    told = ngram.probabilities(grams, train, 2).groupBy("h1").agg(F.sum("p").alias("p")).collect()
    assert all(abs(r.p - 1) < 1e-12 for r in told)


def test_empty_training_table_and_cut_texts(texts):
    (row,) = ngram.token_losses(texts(["x y z"]), texts([]).where("false")).collect()
    assert (row.loss, row.n_tokens) == (0.0, 3)
    (row,) = ngram.token_losses(texts(["x y z"]), texts(["x y"]), max_length=2).collect()
    assert row.n_tokens == 2 and row.loss > 0


def test_pairs_are_dealt_into_more_files_the_more_there_are(spark, out, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{out}/{name}")
    wanted = queries.e02_pairs(spark, "/root/testdata/sf0.001").count()
    monkeypatch.setattr(queries, "FILE_BYTES", 50_000)
    assert queries.e02_positional_pairs(spark, "/root/testdata/sf0.001").count() == wanted > 0
    for name in ("reference", "prediction"):
        assert len(list(Path(f"{out}/{name}").glob("part-*"))) > 5
