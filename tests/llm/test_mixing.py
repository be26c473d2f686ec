"""Targets against plain resharing, the dual against its conditions, and the mix."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textmill.llm import mixing


def _targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return target


def _rows(seed=1, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "ä", "Z", None, "tiny", "z"]
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), rng.choices(sources, [30, 9, 9, 9, 5, 1, 9])[0]) for i in range(n)]
    return rows + [(n, None, "b"), (n + 1, "", "a"), (n + 2, " \t\n", "empty"), (n + 3, "x y z", "b")] + rows[:3]


def _docs(spark, rows, parts=4):
    rows = [(*r, "clash", 1) for r in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, place string, copies int").repartition(parts)


def _size(text):
    return len([w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w])


def test_mix(spark):
    rows = _rows()
    got = mixing.mix_report(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    own = {d: (_size(t), s) for d, t, s in rows}
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + _size(t)
    targets = _targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for row in got:
        size, source = own[row.doc_id]
        assert (row.size, row.source_size) == (size, sizes[source])
        assert math.isclose(row.target, targets[source], rel_tol=1e-9, abs_tol=1e-9)
        assert row.taken == row.copies * size <= 3 * size
        taken[source] += row.taken
    for source, target in targets.items():
        largest = max(_size(t) for _, t, s in rows if s == source)
        assert abs(taken[source] - target) <= max(0.01 * target, 0.5 * largest)


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = _rows(2, 150)
    a, b = (sorted(map(tuple, mixing.mix_report(_docs(spark, r, p)).collect())) for r, p in ((rows, 2), (rows[::-1], 7)))
    assert a == b


def test_rates_are_exponentially_tilted(spark):
    """Optimal in the dual: each source meets its target, and the logarithm of a rate
    below the cap is proportional to the size."""
    cells = [(0, s, n) for s, n in ((1, 50), (10, 20), (200, 3))] + [(1, s, n) for s, n in ((5, 10), (80, 2))]
    cells = spark.createDataFrame(cells, "place int, size bigint, n bigint")
    table = [("a", 0, 850, 1200.0, 850 / 73), ("b", 1, 210, 90.0, 210 / 12)]
    sources = spark.createDataFrame(table, "source string, place int, source_size bigint, target double, mean double")
    state = mixing.multipliers(cells, sources)
    rates = cells.join(state, "place").withColumn("rate", mixing._rate(3)).collect()
    for place, target in ((0, 1200.0), (1, 90.0)):
        own = [r for r in rates if r.place == place]
        assert math.isclose(sum(r.rate * r["size"] * r.n for r in own), target, rel_tol=1e-5)
        slopes = {round(math.log(r.rate) / r["size"], 9) for r in own if r.rate < 2.999999}
        assert len(slopes) == 1


def test_hot_sizes_are_dealt_evenly(spark):
    rows = [(i, "one two three four", "hot") for i in range(3000)] + [(i, "one two", "cold") for i in range(3000, 3100)]
    got = mixing.mix_report(_docs(spark, rows)).collect()
    for source in ("hot", "cold"):
        own = [r for r in got if (r.doc_id < 3000) == (source == "hot")]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4
        assert max(r.copies for r in own) - min(r.copies for r in own) <= 1


def test_mixed_documents(spark):
    rows = _rows(3, 120)
    docs = _docs(spark, rows)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    counts = {}
    for r in mixing.mix_report(docs).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + (1 if r.size == 0 else r.copies)
    seen = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert seen == {d: n for d, n in counts.items() if n}
    texts = {d: t for d, t, _ in rows}
    assert all(texts[r.doc_id] == r.text for r in got.collect())


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, "", None), (2, " ", "b")]])
def test_nothing_to_mix(spark, rows):
    got = mixing.mix_report(_docs(spark, rows)).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * len(rows)
    assert mixing.mixed_documents(_docs(spark, rows)).count() == len(rows)


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_report(_docs(spark, _rows(4, 20)).withColumn("text", F.col("text")))
    assert "Python" not in plan._jdf.queryExecution().toString().replace("PythonRDD", "")


def test_bisection_meets_the_targets_too(spark, monkeypatch):
    rows = _rows(seed=8)
    want = {r.source: r.lam for r in _multipliers(spark, rows)}
    monkeypatch.setattr(mixing, "NEWTON_ROUNDS", 2)
    for row in _multipliers(spark, rows):
        assert row.off <= mixing.TOLERANCE
        assert math.isclose(row.lam, want[row.source], rel_tol=1e-3, abs_tol=1e-4)


def _multipliers(spark, rows):
    cells = mixing.document_sizes(_docs(spark, rows)).groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = mixing.source_targets(cells)
    place = sources.select(F.col("source").alias("of"), "place")
    cells = cells.join(place, F.col("source").eqNullSafe(F.col("of"))).select("place", "size", "n").cache()
    return mixing.multipliers(cells, sources).collect()
