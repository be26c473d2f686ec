import json
import os

import pytest
from pyspark.sql import functions as F

from textmill.checks import queries
from textmill.operators import cleaning, noise, runlog
from textmill.session import scratch_folder
from textmill.sources import runlogs


@pytest.fixture
def clean_texts(texts):
    return texts([f"A perfectly fine sentence with the number {i} in it." for i in range(2000)], 5)


def test_noise_does_not_depend_on_partitioning(clean_texts):
    one = {tuple(r) for r in noise.inject_noise(clean_texts.coalesce(1)).collect()}
    assert one == {tuple(r) for r in noise.inject_noise(clean_texts.repartition(9)).collect()}
    assert one != {tuple(r) for r in noise.inject_noise(clean_texts, seed=1).collect()}


def test_noise_shares_and_ids(clean_texts):
    rows = noise.inject_noise(clean_texts).cache()
    counts = {(r.label, r.source): r["count"] for r in rows.groupBy("label", "source").count().collect()}
    assert set(counts) == {(c.label, c.source) for c in noise.CLASSES.values()}
    assert rows.select("doc_id").distinct().count() == rows.count()
    for c in noise.CLASSES.values():
        if c.label != "clean":
            assert 0.5 * c.rate < counts[(c.label, c.source)] / 2000 < 1.6 * c.rate
    assert 2000 * 1.06 < counts[("clean", "curated")] < 2000 * 1.18


def test_rules_find_the_noise(clean_texts):
    rows = noise.inject_noise(clean_texts)
    reasons = cleaning.classify(rows.select("doc_id", "text"))
    found = {
        (r.label, r.reason): r["count"] for r in rows.join(reasons, "doc_id").groupBy("label", "reason").count().collect()
    }
    assert {label: sum(n for (x, _), n in found.items() if x == label) for label, _ in found}["clean"] > 2000
    # Each class is caught by its own rule, and near misses are not.
    for label, reason in [("html", "html"), ("unicode", "unicode"), ("pii", "pii"), ("long", "length"), ("short", "length"), ("boilerplate", "boilerplate")]:
        assert found[(label, reason)] > 0
    for label in ("html", "unicode", "pii", "boilerplate"):
        assert found[(label, "keep")] > 0
    assert found[("clean", "duplicate")] > 0 and found[("clean", "keep")] == 2000
    assert set(reason for label, reason in found if label == "clean") == {"duplicate", "keep"}
    assert found[("boilerplate", "pii")] > 0  # an address in boilerplate counts as personal data


def test_run_logs_from_files(spark, tmp_path):
    history = [
        {"eval_loss": 2.25, "eval_runtime": 9.5, "epoch": 1.0, "step": 4},
        {"eval_loss": 1.75, "eval_runtime": 9.5, "epoch": 2.0, "step": 8},
        {"loss": 4.5, "grad_norm": 2.0, "learning_rate": 0.002, "epoch": 2.5, "step": 10},
        {"eval_loss": 1.75, "eval_runtime": 9.5, "epoch": 3.0, "step": 12},
        {"train_runtime": 321.0, "total_flos": 7e9, "train_loss": 4.0, "epoch": 3.0, "step": 12},
    ]
    config = {"num_epochs": 3, "lora": {"enabled": True, "r": 8, "dropout": 0.05, "target_modules": ["a", "b"]}}
    for name, part in (("one", history), ("two", history[:1]), ("three", [])):
        folder = tmp_path / name
        folder.mkdir()
        log = {"run_id": name, "seed": 42, "config": config, "train_samples": 1200, "history": part}
        (folder / "train_logs.json").write_text(json.dumps(log, indent=2))
    (tmp_path / "train_logs.json").write_text(json.dumps({"seed": 7, "history": history[:2]}, indent=2))

    runs = runlogs.read_run_logs(spark, str(tmp_path))
    assert runs.count() == 4
    assert runs.where("run_id = 'one'").select("config.lora.target_modules", "train_samples").first() == (["a", "b"], 1200)
    rows = runlog.history_rows(runs)
    kinds = [(r.position, r.kind) for r in rows.where("run_id = 'one'").orderBy("position").collect()]
    assert kinds == [(0, "eval"), (1, "eval"), (2, "step"), (3, "eval"), (4, "summary")]
    best = {r.run_id.rsplit("/", 1)[-1]: tuple(r)[1:] for r in runlog.best_checkpoint(rows).collect()}
    assert best == {"one": (8, 2.0, 1.75), "two": (4, 1.0, 2.25), "train_logs.json": (8, 2.0, 1.75)}


def test_run_logs_from_strings(spark):
    table = spark.createDataFrame([('{"run_id": "x", "history": [{"loss": 1.0, "step": 1}]}',)], "d string")
    runs = table.select(runlogs.parse_run_log(F.col("d")).alias("r")).select("r.*")
    assert [r.kind for r in runlog.history_rows(runs).collect()] == ["step"]


def test_scratch_folder_follows_the_session(spark):
    folder = scratch_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder).rstrip("/")


def test_runs_lie_in_one_folder(spark, out, monkeypatch):
    """A folder for each run has to be listed, and made by the driver, one by one."""
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{out}/{name}")
    read = queries.s07_run_log_scan(spark, "/root/testdata/sf0.001").count()
    files = [f for f in os.listdir(f"{out}/runs") if f.startswith("part-")]
    assert len(files) == read > 0 and all(os.path.isfile(f"{out}/runs/{f}") for f in files)
