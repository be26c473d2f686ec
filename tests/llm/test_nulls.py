"""Nulls in every column, extra columns, and one very long text, for every operator."""

import pytest
from pyspark.sql import functions as F

from textmill.llm import bpe, langid, mixing, neardup, quality, secrets, suffix, tokencount, toxicity, winnow

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, TEXT_ string, kind int"
TOKEN = "token = abcdefgh12"
ROWS = [
    (None, f"the first text without an id {TOKEN}", "en", "a", 1, None, None),
    (None, None, None, None, None, "x", 1),
    (3, None, None, "b", None, None, None),
    (4, "", "en", None, 0, None, None),
    (5, "der die das " * 60, "de", "b", 1, None, None),
    (6, "you are here and there " * 40_000, "en", "b", 1, None, None),
    (6, "another text with the same id", None, "a", 1, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SHAPE).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(3, 0, 1), (4, None, None), (5, 1, 0), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


CALLS = {
    "suffix": lambda d, lab: suffix.deduplicated(d),
    "quality": quality.judge,
    "toxicity": toxicity.score,
    "accepted": toxicity.accepted,
    "langid": lambda d, lab: langid.identify(d),
    "counts": lambda d, lab: tokencount.token_counts(d),
    "bpe": lambda d, lab: bpe.round_trip(d),
    "neardup": lambda d, lab: neardup.near_duplicates(d),
    "mixing": lambda d, lab: mixing.mix_report(d),
    "winnow": lambda d, lab: winnow.fingerprint_report(d),
    "secrets": lambda d, lab: secrets.secret_report(d),
    "redacted": lambda d, lab: secrets.redacted_documents(d),
}


@pytest.mark.parametrize("name", CALLS)
def test_every_row_gets_a_result(docs, labels, name):
    got = CALLS[name](docs, labels).collect()
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert ids == sorted((r[0] is not None, r[0] or 0) for r in ROWS)


def test_other_columns_may_have_any_names(docs, labels):
    names = ["kinds", "spans", *[f"{c}{k}" for c in "lpc" for k in range(9)], *toxicity.KINDS, "row", "a.b", "__text", "__id"]
    wide = docs.select("kind", *[F.lit(i).alias(n) for i, n in enumerate(names)], "n_chars", "text", "doc_id")
    for result in (toxicity.accepted(wide, labels), secrets.redacted_documents(wide)):
        rows = result.collect()
        assert result.columns == wide.columns and len(rows) == len(ROWS)
        assert all(list(r)[1 : 1 + len(names)] == list(range(len(names))) for r in rows)
    assert all(r.n_chars == len(r.text or "") and TOKEN not in (r.text or "") for r in rows)


def test_stages_that_join_take_any_names(docs):
    names = ["__id", "__key", "__n", "__m", "__of", "__with", "__copies", "__copy", "__digest", "digest", "of", "id", "key", "n", "copies", "copy", "c0", "c1", "a.b"]
    wide = docs.select("kind", *[F.lit(i).alias(n) for i, n in enumerate(names)], "text", "source", "doc_id")
    for result in (neardup.deduplicated(wide), mixing.mixed_documents(wide)):
        rows = result.collect()
        assert result.columns == wide.columns and rows
        assert all(list(r)[1 : 1 + len(names)] == list(range(len(names))) for r in rows)
    for result in (neardup.deduplicated, mixing.mixed_documents):
        assert result(wide.limit(0)).count() == 0


def test_rows_without_ids_are_treated_alike(docs):
    spans = {r.spans for r in secrets.secret_report(docs).where("doc_id is null").collect()}
    assert spans == {"", "assign:29:47"}
    kept = neardup.deduplicated(docs).collect()
    # The three empty texts are one class, that of document 3.
    assert sorted((r.doc_id or 0, bool(r.text)) for r in kept) == [(0, True), (3, False), (5, True), (6, True), (6, True)]
    assert mixing.mixed_documents(docs.where(F.col("doc_id").isNull())).columns == docs.columns
