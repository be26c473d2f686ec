import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill import rules
from textmill.checks import inputs
from textmill.functions import porter, tokens
from textmill.operators import overlap
from textmill.plans.evaluation import evaluate


def _f(common, n_pred, n_ref):
    if not common:
        return 0.0
    p, r = common / n_pred, common / n_ref
    return 2 * p * r / (p + r)


def _clipped(a, b):
    return _f((Counter(a) & Counter(b)).total(), len(a), len(b))


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def _grams(t):
    return list(zip(t, t[1:]))


@pytest.fixture(scope="module")
def items():
    rng = random.Random(5)
    vocabulary = ["the", "cat", "sat", "on", "mats", "Running", "relational", "the", "Été", "x1", "quickly,"]
    made = [
        ("same text here", "same text here"), ("all different", "no overlap"), ("", "something"), ("something", ""),
        ("", ""), ("the the the cat", "the cat the"), ("one", "one"), ("...", "!!!"),
    ]
    for _ in range(60):
        made.append(tuple(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 40))) for _ in range(2)))
    return made


@pytest.fixture
def pairs(spark, items):
    rows = [(i, p, r) for i, (p, r) in enumerate(items)]
    return spark.createDataFrame(rows, "doc_id bigint, prediction string, reference string").repartition(3)


def _ascii_words(t):
    return re.findall("[a-z0-9]+", t.lower())


def test_scores_equal_brute_force(spark, pairs, items):
    stem = {
        r.w: r.s
        for r in spark.createDataFrame([(w,) for w in {w for p in items for t in p for w in _ascii_words(t)}], "w string")
        .select("w", F.element_at(tokens.stem_tokens(F.array("w")), 1).alias("s"))
        .collect()
    }
    rows = {r.doc_id: r for r in overlap.score_pairs(pairs).collect()}
    plain = {r.doc_id: r.rouge1 for r in overlap.rouge_n(pairs, stem=False).collect()}
    f1 = {r.doc_id: r.token_f1 for r in overlap.token_f1(pairs).collect()}
    r12 = {r.doc_id: (r.rouge1, r.rouge2) for r in overlap.rouge_n(pairs).collect()}
    rl = {r.doc_id: r.rougeL for r in overlap.rouge_l(pairs).collect()}
    assert len(rows) == len(items) == len(plain) == len(f1) == len(r12) == len(rl)
    for i, (p, r) in enumerate(items):
        a, b = ([stem[w] for w in _ascii_words(t)] for t in (p, r))
        want = _clipped(p.lower().split(), r.lower().split())
        assert abs(rows[i].token_f1 - want) <= 5.1e-5 and rows[i].token_f1 == f1[i]
        assert (rows[i].rouge1, rows[i].rouge2) == r12[i] == (_clipped(a, b), _clipped(_grams(a), _grams(b)))
        assert rows[i].rougeL == rl[i] == _f(_lcs(a, b), len(a), len(b))
        assert plain[i] == _clipped(_ascii_words(p), _ascii_words(r))


def test_lcs_of_long_texts():
    rng = random.Random(1)
    a, b = (rng.choices("abcdefgh", k=n) for n in (700, 900))
    assert overlap.lcs(a, b) == _lcs(a, b)


def test_both_stemmers_agree(spark):
    rng = random.Random(3)
    suffixes = [s for table in (porter.STEP_1A, porter.STEP_2, porter.STEP_3, porter.STEP_4) for s, *_ in table]
    suffixes += ["ed", "ing", "eed", "ied", "y", "logi", "alli", "e", "ll", "ion", "yy", ""]
    made = {"".join(rng.choices("abeilostyz1", k=rng.randrange(1, 6))) + rng.choice(suffixes) for _ in range(6000)}
    words = sorted(made | set(porter.IRREGULAR))
    table = spark.createDataFrame([(w,) for w in words], "w string")
    column = table.select("w", F.element_at(tokens.stem_tokens(F.array("w")), 1).alias("s")).collect()
    assert [(r.w, porter.stem(r.w)) for r in column] == [(r.w, r.s) for r in column]


def test_words_part_at_every_space(spark):
    signs = [c for c in map(chr, range(1, 0x3100)) if not 0xD800 <= ord(c) < 0xE000]
    table = spark.createDataFrame([(c, f"a{c}{c}b{c}") for c in signs], "c string, text string")
    rows = table.select("c", tokens.words(F.col("text")).alias("w"), F.lower("text").alias("low")).collect()
    assert all(r.w == r.low.split() for r in rows) and sum(len(r.w) == 2 for r in rows) == len(rules.SPACE_CHARS)


def test_counts_of_numbered_pairs_equal_counters():
    rng = random.Random(8)
    for n in range(200):
        a, b = (" ".join(rng.choices(["ab", "cats", "cat", "x-y", "\u00e9t", "the"], k=rng.randrange(n % 9 + 1))) for _ in range(2))
        words = [[porter.stem(w) for w in _ascii_words(t)] for t in (a, b)]
        want = [x for one, two in ((a.split(), b.split()), words, map(_grams, words)) for x in ((Counter(one) & Counter(two)).total(), len(one), len(two))]
        assert overlap._pair_counts(a, b, ("f1", "rouge1", "rouge2", "rougeL"), True) == [*want, _lcs(*words), *map(len, words)]


def test_predictions_make_the_tokens_once(spark):
    table = spark.createDataFrame([(1, "A b c d e f"), (7, "a b"), (8, "")], "doc_id bigint, reference string")
    made = inputs.predictions(table)
    assert [r.prediction for r in made.sort("doc_id").collect()] == ["a b c d f a b c", "", ""]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_corpus_means(spark, pairs, items):
    scores = overlap.score_pairs(pairs)
    row = overlap.corpus_rouge(scores).first()
    rows = scores.collect()
    assert row.rouge2 == pytest.approx(sum(r.rouge2 for r in rows) / len(rows), abs=5.1e-5)
    assert overlap.mean_token_f1(scores).first()[0] == pytest.approx(sum(r.token_f1 for r in rows) / len(rows), abs=5.1e-5)
    none = scores.where("false")
    assert tuple(overlap.corpus_rouge(none).first()) == (0.0, 0.0, 0.0)
    assert overlap.mean_token_f1(none).first()[0] == 0.0


def test_prediction_without_reference_counts_as_zero(spark):
    said = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id bigint, prediction string")
    references = spark.createDataFrame([(1, "a b"), (3, "z")], "doc_id bigint, reference string")
    assert overlap.pair_up(references, said).count() == 1
    scores = overlap.score_pairs(overlap.pair_up(references, said, "left"))
    assert overlap.corpus_rouge(scores).first().rouge1 == 0.5


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, 2.0, 3), (2, 1.0, 2)], math.exp((2.0 * 2 + 1.0) / 3)),
        ([(1, 2.0, 1001), (2, 1.0, 251)], math.exp((2000 + 250) / 1250)),
        ([(1, 9.0, 1), (2, 9.0, 0)], math.inf),
        ([(1, 9.0, 1), (2, 1.0, 2)], math.exp(1.0)),
        ([], math.inf),
    ],
)
def test_perplexity(spark, rows, want):
    table = spark.createDataFrame(rows, "doc_id bigint, loss double, n_tokens int")
    assert overlap.perplexity(table).first()[0] == pytest.approx(want)


def test_perplexity_of_a_scorer_that_cuts(spark):
    table = spark.createDataFrame([(1, 2.0, 1000), (2, 1.0, 256)], "doc_id bigint, loss double, n_tokens int")
    assert overlap.perplexity(table, max_length=256).first()[0] == pytest.approx(math.exp(1.5))


def test_cap_counts_texts_before_the_length_test(texts):
    items = ["x" * 59, "y" * 60, "z" * 61, "w" * 62]
    got = overlap.eval_texts(texts(items), cap=3).collect()
    assert sorted((r.doc_id, r.prompt, r.reference) for r in got) == [(1, "y" * 50, "y" * 10), (2, "z" * 50, "z" * 11)]
    assert overlap.eval_texts(texts(items)).count() == 3


def test_result_row(spark, texts):
    items = ["a short one"] + [f"{'word ' * 20}number {i}" for i in range(4)]
    table = texts(items)
    said = overlap.eval_texts(table).select("doc_id", F.col("reference").alias("prediction"))
    scores = spark.createDataFrame([(1, 1.0, 5)], "doc_id bigint, loss double, n_tokens int")
    row = evaluate(table, said, scores, "m", "d", cap=3).first()
    assert tuple(row) == ("m", "d", 5, 2.72, 1.0, 1.0, 1.0, 1.0)
