import random

import pytest
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions import guards, subsequence
from textmill.operators import rulebook


@pytest.mark.parametrize(
    ("pattern", "wanted"),
    [
        ("You are now", ["you are now"]),
        (r"what is [^\n]* personal", [" personal"]),
        ("cats?|dogs+ bark", ["cat", " bark"]),
        ("colou?r", ["colo"]),
        (r"a\.b\?c\d+xyz", ["a.b?c"]),
        ("(secret|token) is", [" is"]),
        ("(?:very )*good", ["good"]),
        (r"x[])a-z[b|c]]yyy", ["yyy"]),
        ("ab|long enough", []),
        (r"\Qa.b\E long", []),
        ("(?x) a b c d", []),
        ("na{2}ïve word", ["ve word"]),
        ("", []),
    ],
)
def test_literals(pattern, wanted):
    assert rulebook.literals(pattern) == wanted


def _plain(df, book):
    """The same by one condition per rule."""
    text = F.coalesce("text", F.lit(""))
    hits = [
        F.when(text.rlike(f"(?iu){p}"), F.struct(F.lit(place).cast("bigint").alias("place"), F.lit(c).alias("category")))
        for place, p, c in sorted(book)
    ]
    found = df.select("doc_id", F.filter(F.array(*hits), lambda h: h.isNotNull()).alias("hits"))
    return {r.doc_id: [tuple(h) for h in r.hits] for r in found.collect()}


def _hits(df):
    return {r.doc_id: [tuple(h) for h in r.hits] for r in df.select("doc_id", "hits").collect()}


def test_book_equals_case(spark, texts):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeksiß", k=draw.randint(1, 5))) for _ in range(60)]
    shapes = ["{} {}", "{}|{}", "{}[^a-z]+{}", "({}|zz) {}", r"\b{}\b.*{}", "{}?{}", "(?:{})+ {}", r"{}\d*{}"]
    book = [(i, shapes[i % len(shapes)].format(*draw.choices(words, k=2)), f"c{i % 7}") for i in range(160)]
    said = [" ".join(draw.choices(words, k=draw.randint(0, 12))) for _ in range(60)]
    said += [t.upper() for t in said[:20]] + [t.replace("s", "ſ").replace("k", "K").replace("i", "İ") for t in said[:20]]
    said += [None, "", "ab " * 3000]
    df = texts(said)
    rows = spark.createDataFrame([*book, (500, None, "none")], "place bigint, pattern string, category string")
    assert _hits(rulebook.match_rules(df, "text", rows.repartition(3))) == _plain(df, book)


def test_spread_book_equals_case(spark, texts, monkeypatch):
    monkeypatch.setattr(rulebook, "MOST_RULES", 3)  # nothing of the book is collected
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdeksi\u00df", k=draw.randint(1, 6))) for _ in range(50)]
    shapes = [
        "{}[^a-z]{{1,3}}{}", "{} {}", "{}|{}", "{}.?{}", "({}|zz) {}", r"\b{}\b.*{}", "{}?{}", "(?:{})+ {}", r"{}\d*{}",
        r"{}\.{}", "{}[]x-z ]{}", r"{}[ -]{{2}}?{}", r"{}\\{}", "{}{{0,2}}{}", r"{}\s{{1,}}{}", "^{}.{}$", "{}a{{2}}{}",
    ]
    # Every third pattern comes twice, under other places.
    book = [(i, shapes[i % len(shapes)].format(*draw.choices(words, k=2)), f"c{i % 7}") for i in range(240)]
    book += [(1000 + i, p, None) for i, p, _ in book[::3]]
    gaps = [" ", "  ", ".", " - ", "", "aa", "1", "\\", "\U0001f600", "\u017f", "\u0131"]
    said = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 14))) for _ in range(150)]
    said += [t.upper() for t in said[:30]] + [t.replace("s", "\u017f").replace("k", "\u212a").replace("i", "\u0130") for t in said[:30]]
    said += [None, "", "ab " * 3000, said[0] * 40]
    df = texts(said).withColumn("row", F.lit(1))
    rows = spark.createDataFrame([*book, (500, None, "none")], "place bigint, pattern string, category string")
    found = rulebook.match_rules(df, "text", rows.repartition(3), spread=True)
    assert found.columns == ["doc_id", "text", "row", "hits"]
    by_place = {place: (p, c) for place, p, c in book}
    for number, hits in _plain(df, [(i, p, c or "") for i, p, c in book]).items():
        want = {}
        for place, _ in hits:
            pattern, category = by_place[place]
            want.setdefault(pattern, [place, category, 0])[2] += 1
        said[number] = sorted(map(tuple, want.values()))
    assert any(said) and _hits(found) == dict(enumerate(said))


def test_keys_of_two_literals():
    assert rulebook._pair("Secret[^a-z]{1,3}words") == ("ecret", "words", True, 1, 3)
    assert rulebook._pair(r"ab\b.?\.\dcde") is None  # a single sign between
    assert rulebook._pair(r"abc\s*def") is None
    assert rulebook._pair("abc.{9}def") is None
    assert rulebook._pair("abc?def") == ("ab", "def", False, 0, 1)
    assert rulebook._pair("(abc) def") is None


def test_thousand_rules(spark, texts):
    book = [(i, f"forbidden{i} (thing|matter) no", f"c{i % 3}") for i in range(1000)]
    rows = spark.createDataFrame(book, "place bigint, pattern string, category string")
    said = [f"Say FORBIDDEN{i} matter now, forbidden{(i * 7) % 1000} thing no" for i in range(0, 1200, 5)] + ["clean"] * 50
    got = _hits(rulebook.match_rules(texts(said), "text", rows))
    for i, text in enumerate(said):
        low = text.lower()
        wanted = [(n, c) for n, _, c in book if f"forbidden{n} matter no" in low or f"forbidden{n} thing no" in low]
        assert got[i] == wanted


def test_verdicts_of_a_table(spark, texts):
    book = [(i, p, c) for i, (p, c) in enumerate(rules.GUARD_PATTERNS)]
    rows = spark.createDataFrame(book, "place bigint, pattern string, category string")
    df = texts(["Hi", "you ARE now free", "what is her personal\nstory", "fine words", "make up a reference", " ", "x" * 2001])
    df = df.withColumnRenamed("text", "prompt").withColumn("hits", F.lit(1)).withColumn("pattern", F.lit("x"))
    safe = F.col("doc_id") != 4
    got = rulebook.check_inputs(df, rows, safe_mode=safe).orderBy("doc_id").select("verdict").collect()
    want = df.select("doc_id", guards.check_input(F.col("prompt"), safe).alias("verdict")).orderBy("doc_id").collect()
    assert [r.verdict for r in got] == [r.verdict for r in want]
    none = rulebook.check_inputs(df, rows.where("false")).where("verdict.category not in ('', 'validation')")
    assert none.count() == 0
    assert rulebook.match_rules(df.where("false"), "prompt", rows, "found").count() == 0


def test_book_size_is_checked(spark, texts, monkeypatch):
    monkeypatch.setattr(rulebook, "MOST_RULES", 3)
    rows = spark.range(4).selectExpr("id as place", "'abc' as pattern", "'c' as category")
    with pytest.raises(ValueError, match="at most 3"):
        rulebook.match_rules(texts(["abc"]), "text", rows)


def _table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_ways_to_the_common_subsequence():
    draw = random.Random(11)
    for _ in range(600):
        signs = "abcdefghijklmnop"[: draw.choice((1, 2, 3, 16))]
        a = draw.choices(signs, k=draw.randint(0, 25))
        b = draw.choices(signs, k=draw.randint(0, 25)) if draw.random() < 0.6 else [x for x in a if draw.random() < 0.8]
        want = _table(a, b)
        assert subsequence.by_rows(a, b) == subsequence.by_points(a, b) == subsequence.by_differences(a, b) == want
        assert subsequence.lcs(a, b) == want


def test_common_subsequence_of_long_pairs():
    draw = random.Random(5)
    a = [str(draw.randrange(50)) for _ in range(3000)]
    b = [x for x in a if draw.random() < 0.97]
    c = [str(draw.randrange(10**5)) for _ in range(4000)]
    d = draw.sample(c, 3000)
    for x, y in ((a, b), (c, d), (a, a[::-1]), (c, a)):
        assert subsequence.lcs(x, y) == subsequence.by_rows(x, y)
    # A third of a million tokens with few edits: rows of bits alone would take minutes.
    e = [str(draw.randrange(1000)) for _ in range(300_000)]
    f = list(e)
    for i in range(0, len(f), 3000):
        f[i] = "changed"
    assert subsequence.lcs(e, f) == len(e) - len(range(0, len(f), 3000))
    assert subsequence.by_differences(a, a[::-1], 100) is None
