import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from textmill import rules
from textmill.operators import cleaning, dedup, fingerprint, split
from textmill.plans.cleaning import clean_corpus, clean_table
from textmill.sources import corpus as files

DIRTY = [
    "The ferry leaves the old harbour at seven.",
    "q",
    "Ask mara.k@harbour.example about the timetable.",
    "In winter the island is reached by the mail boat only.",
    "<td>Crossing: forty minutes</td>",
    "The ferry leaves the old harbour at seven.",
    "z" * 2400,
    "Fog keeps the boats in port on about thirty days a year.",
]


def _mixed(n=400, seed=3):
    rng = random.Random(seed)
    pool = [f"A perfectly fine sentence number {i}." for i in range(60)] + DIRTY + ["\ufffd" + DIRTY[0], "All rights reserved; privacy policy"]
    # A third of all rows are copies of one text.
    return ["The text everybody copies around." if rng.random() < 0.33 else rng.choice(pool) for _ in range(n)]


def _reasons(items):
    seen, reasons = set(), []
    for t in items:
        if t in seen:
            reasons.append("duplicate")
            continue
        seen.add(t)
        reasons.append(
            "unicode" if "\ufffd" in t else "html" if "<" in t else "pii" if "@" in t
            else "length" if not 20 <= len(t) <= 2000 else "boilerplate" if "All rights" in t else "keep"
        )
    return reasons


def test_stats_of_the_small_dirty_file(texts):
    stats = cleaning.cleaning_stats(texts(DIRTY)).first().asDict()
    assert stats == {
        "total_input": 8, "removed_duplicate": 1, "removed_html": 1, "removed_unicode": 0, "removed_pii": 1,
        "removed_length": 2, "removed_boilerplate": 0, "total_output": 3,
        "train_count": 2, "val_count": 0, "test_count": 1,
    }
    report = cleaning.cleaning_report(cleaning.cleaning_stats(texts(DIRTY))).first()
    assert (report.total_removed, report.reduction_pct) == (5, 62.5)


def test_empty_table(texts, spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    stats = cleaning.cleaning_stats(empty).first()
    assert set(stats) == {0}
    assert cleaning.cleaning_report(cleaning.cleaning_stats(empty)).first().reduction_pct == 100.0
    assert split.assign_splits(empty).count() == 0
    assert cleaning.manifest(empty, "x").first().dataset_hash == fingerprint.dataset_fingerprint(empty).first().dataset_hash


def test_classify_agrees_with_the_plain_loop_for_any_partitioning(texts):
    items = _mixed()
    want = _reasons(items)
    for parts in (1, 7):
        got = sorted(cleaning.classify(texts(items, parts)).collect())
        assert [r.reason for r in got] == want
    kept = sorted(cleaning.clean(texts(items)).collect())
    assert [(r.doc_id, r.text) for r in kept] == [(i, t) for i, (t, r) in enumerate(zip(items, want)) if r == "keep"]
    stats = cleaning.cleaning_stats(texts(items)).first().asDict()
    for reason in rules.REASONS:
        assert stats[f"removed_{reason}"] == want.count(reason)


def test_first_copy_stays(texts):
    items = ["b", "a", "b", "a", "a"]
    assert sorted(r.doc_id for r in dedup.drop_duplicates(texts(items)).collect()) == [0, 1]
    flagged = dedup.flag_duplicates(texts(items), key="text", salts=2).collect()
    assert {r.doc_id: r.is_duplicate for r in flagged} == {0: False, 1: False, 2: True, 3: True, 4: True}


def test_copies_are_thinned_out_before_the_only_exchange(texts):
    plan = dedup.drop_duplicates(texts(DIRTY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(content_key") == 1 and "Sort" not in plan and plan.count("HashAggregate") == 2


def test_fingerprint_sums_hold_any_number_of_rows(texts):
    sums = texts(["a"]).agg(*fingerprint.row_digest_sums(F.lit("k"), F.lit("h")))
    assert {kind for _, kind in sums.dtypes} == {"decimal(38,0)"}


def test_texts_equal_only_after_normalization_both_stay(texts):
    items = ["A sentence with caf\u00e9 in it.", "A sentence with cafe\u0301 in it.", " A sentence with caf\u00e9 in it. "]
    assert len({r.text for r in cleaning.clean(texts(items)).collect()}) == 1
    assert cleaning.clean(texts(items)).count() == 3


def _plain_split(ids, seed):
    ranked = sorted(ids, key=lambda i: (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), i))
    a, b = math.floor(len(ids) * 0.8), math.floor(len(ids) * 0.9)
    return {i: "train" if k < a else "val" if k < b else "test" for k, i in enumerate(ranked)}


@pytest.mark.parametrize("n", [1, 2, 3, 9, 33, 1000])
def test_split_is_exact(texts, n):
    rows = texts([f"t{i}" for i in range(n)])
    got = {r.doc_id: r.split for r in split.assign_splits(rows, seed=7).collect()}
    assert got == _plain_split(range(n), 7)
    counts = {r.split: r.n_rows for r in split.split_counts(split.assign_splits(rows, seed=7)).collect()}
    a, b = int(n * 0.8), int(n * 0.9)
    assert counts == {"train": a, "val": b - a, "test": n - b}
    if n == 33:
        assert counts == {"train": 26, "val": 3, "test": 4}


def test_split_does_not_depend_on_partitioning_but_on_the_seed(texts):
    items = [f"t{i}" for i in range(200)]
    one = {tuple(r) for r in split.assign_splits(texts(items, 1)).collect()}
    assert one == {tuple(r) for r in split.assign_splits(texts(items, 9)).collect()}
    assert one != {tuple(r) for r in split.assign_splits(texts(items, 1), seed=43).collect()}
    order = [r.doc_id for r in split.seeded_order(texts(items, 5)).collect()]
    assert order == [r.doc_id for r in split.seeded_order(texts(items, 2)).collect()]
    assert sorted(order) == list(range(200)) != order


def test_fingerprint(texts):
    def of(items, parts=3, seed=42):
        return fingerprint.dataset_fingerprint(texts(items, parts), seed).first().dataset_hash

    items = [f"text {i}" for i in range(50)]
    base = of(items)
    assert len(base) == 16 and base == of(items, 8)
    assert base != of(items, seed=1)
    assert base != of(items[::-1])
    assert base != of(items[:-1])
    assert base != of(items[:-1] + ["changed"])


def test_job_writes_splits_and_manifest(spark, texts, out):
    raw = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(DIRTY)], files.RAW_SCHEMA)
    files.write_jsonl(raw, f"{out}/raw")
    row = clean_corpus(spark, f"{out}/raw", f"{out}/clean", seed=99).first()
    again = clean_table(texts(DIRTY), f"{out}/again", f"{out}/raw", seed=99).first()
    assert row == again
    assert (row.cleaning_rules_version, row.split_seed, row.input_file) == ("1.0.0", 99, f"{out}/raw")
    assert row.stats.total_output == 3 and row.stats.train_count == 2
    cleaned = cleaning.clean(texts(DIRTY))
    assert row.dataset_hash == fingerprint.dataset_fingerprint(cleaned, 99).first().dataset_hash
    assert files.read_splits(spark, f"{out}/clean/splits").count() == 3
    assert {r.split for r in files.read_splits(spark, f"{out}/clean/splits", "train").collect()} == {"train"}
    assert files.read_splits(spark, f"{out}/clean/splits", "val").count() == 0  # three rows leave it empty
    with pytest.raises(ValueError):
        files.read_splits(spark, f"{out}/clean/splits", "dev")


def test_job_on_records_without_ids(spark, out):
    rows = [(f"A perfectly fine sentence number {i}.",) for i in range(100)] + [("short",), ("A perfectly fine sentence number 7.",)]
    files.write_jsonl(spark.createDataFrame(rows, "text string"), f"{out}/raw")
    row = clean_corpus(spark, f"{out}/raw", f"{out}/clean").first()
    written = files.read_splits(spark, f"{out}/clean/splits").collect()
    sizes = {name: sum(r.split == name for r in written) for name in rules.SPLITS}
    assert sizes == {"train": 80, "val": 10, "test": 10}
    assert (row.stats.train_count, row.stats.val_count, row.stats.test_count) == (80, 10, 10)
    kept = cleaning.clean(files.read_jsonl(spark, f"{out}/raw"), with_key=True)
    assert row.dataset_hash == fingerprint.dataset_fingerprint(kept).first().dataset_hash


def test_other_limits(texts):
    items = ["tiny", "A line about tides.", "A line about tides and fog.", "x" * 40, "fog horn: tides turn, fog stays"]
    limits = rules.Limits(min_chars=5, max_chars=39, signals=("fog horn", "tides turn"), min_signals=2, train_end=0.5, val_end=0.5)
    stats = cleaning.cleaning_stats(texts(items), limits).first()
    assert (stats.removed_length, stats.removed_boilerplate, stats.total_output) == (2, 1, 2)
    assert (stats.train_count, stats.val_count, stats.test_count) == (1, 0, 1)
    kept = cleaning.clean(texts(items), limits=limits)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert sorted(r.split for r in split.assign_splits(kept, limits=limits).collect()) == ["test", "train"]
    assert [r.reason for r in sorted(cleaning.classify(texts(items), limits).collect())] == ["length", "keep", "keep", "length", "boilerplate"]


@pytest.mark.parametrize("ids", [[1, None, 3], [1, 2, 2]])
def test_split_refuses_missing_and_repeated_ids(spark, ids):
    rows = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "doc_id bigint, text string")
    with pytest.raises(Exception, match="id"):
        split.assign_splits(rows).collect()


@pytest.mark.parametrize("run", [cleaning.clean, cleaning.classify, cleaning.cleaning_stats, lambda t: cleaning.manifest(t, "x")])
def test_a_row_without_a_text_fails_everywhere(spark, run):
    rows = spark.createDataFrame([(1, "A perfectly fine sentence."), (2, None)], "doc_id bigint, text string")
    with pytest.raises(Exception, match="without a text"):
        run(rows).collect()


def test_jsonl_scan(spark, out):
    spark.createDataFrame([('{"doc_id": 1, "text": "\u00e9"}',), ("   ",), ("",)], "value string").coalesce(1).write.text(out)
    assert [(r.doc_id, r.text) for r in files.read_jsonl(spark, out).collect()] == [(1, "\u00e9")]


@pytest.mark.parametrize("line", ['{"doc_id": 1, "text": "x"', '{"doc_id": 1}'])
def test_jsonl_scan_fails_on_bad_records(spark, out, line):
    spark.createDataFrame([(line,)], "value string").write.text(out)
    with pytest.raises(Exception):
        files.read_jsonl(spark, out).collect()
