"""Spans against Python's own expressions, and the trigram queries."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textmill.llm import secrets

HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "Z9" * 8
CASES = [
    None,
    "",
    "nothing here",
    f"password = 'hunter22' and token:abc and {HEX}",
    "token=token:abcdefgh",  # the failing match eats the second word
    f"{KEY} AKIASHORT api_key==x.y/z+1= APIKEY : \"qwertyuiop\"",
    f"né\U0001f600 secret: {HEX}\nSECRET={HEX}{HEX}",
    HEX * 40,
    " ".join([HEX] * 1500),  # more matches than one chunk sums up
    "gh" + "p_" + "a1" * 20 + " xox" + "b-1234567890ab ey" + "Jhbcdefghi.ey" + "Jhbcdefghi.abcdefghij",
    "-----BEGIN RSA PRIVATE KEY-----",
    "paſsword=hunter22 toKen=abcdefg",
]


def _expected(text):
    spans = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), m.end(), k))
    # Python orders by start, then rule; the end decides nothing further.
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _written(spans, base):
    names = [r.kind for r in secrets.RULES]
    return ",".join(f"{names[k]}:{b}:{e}" for b, e, k in spans if not base or k < 3)


def _docs(spark, texts):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:4], "doc_id bigint, text string, kinds string, spans string").repartition(3)


def _random_texts(n):
    rng, bits = random.Random(3), ["token", "=", ":", " ", "abcdef", "secret", "'", HEX[:12], KEY[:9], "Z9Z9Z9Z9Z9Z9", "\n", "é"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_spans(spark):
    texts = CASES + _random_texts(150)
    got = secrets.secret_report(_docs(spark, texts)).collect()
    assert len(got) == len(texts) + 4
    for row in got:
        want = _expected(texts[row.doc_id] or "")
        assert row.spans == _written(want, False), texts[row.doc_id][:80]
        assert row.base_sha256 == hashlib.sha256(_written(want, True).encode()).hexdigest()
        counts = [sum(k == kind for *_, k in want) for kind in range(3)]
        assert [row.n_assign, row.n_access, row.n_hex] == counts


def test_redaction(spark):
    texts = CASES + _random_texts(60)
    docs = _docs(spark, texts).select("doc_id", "text", F.lit(1).alias("n_chars"))
    for row in secrets.redacted_documents(docs).collect():
        text, covered = texts[row.doc_id] or "", set()
        for b, e, _ in _expected(text):
            covered |= set(range(b, e))
        want, i = "", 0
        runs = []
        for b, e, _ in _expected(text):
            if runs and b < runs[-1][1]:
                runs[-1][1] = max(e, runs[-1][1])
            else:
                runs.append([b, e])
        for b, e in runs:
            want, i = want + text[i:b] + "[SECRET]", e
        want += text[i:]
        assert (row.text, row.n_chars) == (want, len(want))


def test_empty_table(spark):
    assert secrets.secret_report(_docs(spark, [""]).limit(0)).count() == 0


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_every_match_satisfies_its_query(rule):
    terms = secrets.trigram_query(rule.pattern)
    assert bool(terms) is (rule.kind != "hex")
    texts = [t for t in CASES + _random_texts(400) if t]
    for text in texts:
        if terms and re.search(rule.pattern, text, re.ASCII):
            assert any(all(g in text.lower() for g in term) for term in terms)


def test_queries_of_other_expressions():
    assert secrets.trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert secrets.trigram_query("a.b") == []
    assert set(secrets.trigram_query("(abc|xyz)[0-9]+")) == {frozenset({"abc"}), frozenset({"xyz"})}
    assert secrets.trigram_query("(abc[0-9]+|xy)") == []
    assert secrets.trigram_query("(abc)*x") == []
    assert secrets.trigram_query("(abc)+x") == [frozenset({"abc"})]


def test_index_has_all_postings(spark):
    docs = _docs(spark, CASES)
    got = {tuple(r) for r in secrets.postings(docs).collect()}
    grams = {g for r in secrets.RULES for term in secrets.trigram_query(r.pattern) for g in term}
    assert got == {(g, i) for i, t in enumerate(CASES) for g in grams if t and g in t.replace("K", "k").lower()}


def test_redaction_of_many_secrets_in_one_text(spark):
    n = 3000
    text = "é ".join(f"token={i:08d}abcdef" for i in range(n)) + " end"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert secrets.redacted_documents(docs).first().text == "é ".join(["[SECRET]"] * n) + " end"
