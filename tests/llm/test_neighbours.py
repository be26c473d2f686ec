"""Neighbours against brute force: recall, exact scores, ties, vectors that take no part."""

import numpy as np
import pytest

from textmill.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, links string, dim string"


def _table(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "a", "b") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("shard_rows", [1 << 14, 400])
def test_recall_and_scores(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(1500, 24)).astype(np.float32)
    got = neighbours.nearest_report(_table(spark, list(enumerate(vectors)))).collect()
    wide = vectors.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        scores = unit @ unit[q]
        scores[q] = -2
        hits += len({v for _, v, _ in mine} & set(np.argsort(-scores)[:5].tolist()))
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - scores[v]) < 1e-12 for _, v, s in mine)
        assert [s for _, _, s in mine] == sorted((s for _, _, s in mine), reverse=True)
    assert hits >= 0.9 * 150


def test_copies_ties_and_vectors_without_direction(spark):
    vectors = [(i, (1, 2, 3)) for i in range(0, 40)]  # a group of copies: the least ids answer
    vectors += [(100, (0, 0, 0)), (150, None), (200, ()), (250, (1, None, 2)), (300, (float("nan"), 1, 1)), (350, (float("inf"), 1, 1))]
    vectors += [(400, (1, 0)), (401, (2, 0)), (450, (0, 1, 0)), (0, (1, 2, 3))]
    got = neighbours.nearest_report(_table(spark, vectors)).collect()
    by = {q: [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in {r.query_id for r in got}}
    assert by[0] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert by[400] == [(1, 401)]
    assert by[450] == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
    assert set(by) == {0, 400, 450}


def test_empty_table(spark):
    assert neighbours.nearest_report(_table(spark, [])).count() == 0
