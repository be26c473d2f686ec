import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions import porter, quality, text, tokens


def test_normalize(column):
    cases = {
        "low\x00tide\x07": "lowtide",
        "Plain text stays as it is.": "Plain text stays as it is.",
        "re\u0301cif": "r\u00e9cif",
        "  reef  ": "reef",
        "\u3000\u2003 tab\tand\nline \x85\xa0": "tab\tand\nline",
        "\x80quoted\x92": "quoted",
        "\u1100\u1161": "\uac00",
        "": "",
        " \u2028 ": "",
    }
    assert column(text.normalize_text, list(cases)) == list(cases.values())


def test_nfc_equals_unicodedata_for_every_code_point(spark):
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    forms = sorted({unicodedata.normalize("NFD", "a" + p) for p in points} | {"a" + p for p in points})
    want = [unicodedata.normalize("NFC", f) for f in forms]
    table = spark.createDataFrame(pd.DataFrame({"t": forms, "want": want})).repartition(8)
    assert table.where(text.nfc(F.col("t")) != F.col("want")).count() == 0


def test_strip_and_split_know_all_white_space(column):
    space = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace()]
    assert sorted(space) == sorted(rules.SPACE_CHARS)
    assert column(text.strip_space, [s + "x" + s for s in space]) == ["x"] * len(space)
    assert column(tokens.words, ["A" + s + "b" for s in space]) == [["a", "b"]] * len(space)


def test_invalid_utf8_becomes_replacement(spark):
    row = spark.sql("SELECT cast(unhex('61FF62') AS string) AS t").select(text.valid_utf8(F.col("t")).alias("t")).first()
    assert row.t == "a\ufffdb"


@pytest.mark.parametrize(
    "value, hit",
    [
        ("<em>Low tide</em>", True),
        ("salt &amp; sand", True),
        ("Nothing marked up.", False),
        ("when x < y holds", False),
        ("&#167; marks a section", True),
        ("&#xA7; is not seen", False),
        ("<>", False),
        ("<>>", False),
        ("a > b < c", False),
        ("<<<< then >", True),
        ("x <\n> y", True),
    ],
)
def test_html(column, value, hit):
    import re

    assert bool(re.search("<[^>]+>", value) or re.search(r"&[a-zA-Z]+;|&#\d+;", value)) is hit
    assert column(quality.has_html, [value]) == [hit]


PII_CASES = {
    "Write to mara.k@harbour.example": "email",
    "weird tld a@b.c|d": "email",
    "a@b.c": "",
    "SSN: 078-05-1120": "ssn,ssn_label",
    "\u00e9078-05-1120": "",
    "078-05-1120\u0301": "ssn",
    "Ring 212-555-0187 today": "phone",
    "plain 2125550187": "phone",
    "\u0660\u0661\u0662-\u0663\u0664-\u0665\u0666\u0667\u0668": "ssn",
    "Card: 4111 1111 1111 1111": "card",
    "4111-1111-1111-1111": "",
    "Patient DOB: 11/02/1971": "dob",
    "patient dob\u2003:11/02/1971": "dob",
    "Patient DOB 11/02/1971": "",
    "MRN: 7734019": "mrn",
    "mrn :1": "mrn",
    "\u017fsn: 078-05-1120": "ssn,ssn_label",
    "Tides follow the moon.": "",
    "The winter of 1987 was mild.": "",
    "phone 9876543210987": "",
    "212\xa0555\xa00187": "phone",
}


def test_pii_kinds(column):
    assert column(lambda t: F.array_join(quality.pii_kinds(t), ","), list(PII_CASES)) == list(PII_CASES.values())
    assert column(quality.has_pii, list(PII_CASES)) == [bool(k) for k in PII_CASES.values()]


def test_boilerplate(column):
    cases = {
        "Unauthorized reproduction of these charts is theft; all rights reserved.": 2,
        "All rights reserved.": 1,
        "all RIGHTS reserved. All rights reserved.": 1,
        "Harbours silt up slowly.": 0,
    }
    assert column(quality.boilerplate_score, list(cases)) == list(cases.values())
    assert column(quality.is_boilerplate, list(cases)) == [True, False, False, False]


def test_length_and_broken_unicode(column):
    assert column(quality.length_ok, ["x" * 19, "x" * 20, "x" * 2000, "x" * 2001, "\U0001f600" * 20]) == [
        False, True, True, False, True,
    ]
    assert column(quality.has_broken_unicode, ["low\ufffdtide", "A plain line."]) == [True, False]


def test_precedence_and_equivalence_of_the_two_rule_chains(column):
    cases = {
        "\ufffd <b>x</b>": "unicode",
        "<b>mail a@example.com</b>": "html",
        "a@example.com": "pii",
        "short": "length",
        "All rights reserved. See the privacy policy.": "boilerplate",
        "All rights reserved. See the privacy policy or ask a@example.com": "pii",
        "A text that nothing is wrong with.": None,
    }
    assert column(quality.first_failure, list(cases)) == list(cases.values())
    assert column(quality.passes_all, list(cases)) == [r is None for r in cases.values()]


def test_slices_and_prompt_removal(spark):
    rows = spark.createDataFrame([("abc", "abc  def "), ("abc", " abc"), ("", " x ")], "p string, g string")
    assert [r[0] for r in rows.select(text.strip_prompt(F.col("g"), F.col("p"))).collect()] == ["def", "abc", "x"]
    both = rows.limit(1).select(text.prompt_part(F.lit("x" * 50 + "yz")), text.continuation_part(F.lit("x" * 50 + "yz")))
    assert tuple(both.first()) == ("x" * 50, "yz")


def test_tokens(column, texts):
    assert column(tokens.words, ["  The cat\tSAT\n", ""]) == [["the", "cat", "sat"], []]
    assert [len(x) for x in column(lambda t: tokens.truncate(tokens.words(t)), ["w " * 300, "w w"])] == [256, 2]
    got = tokens.map_batches(texts(["a b"]), lambda b: b.assign(n=b.text.str.len())[["n"]], "n int").collect()
    assert [r.n for r in got] == [3]


# Examples of the published algorithm, and of the usual extensions to it.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "enjoy": "enjoy", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "news": "news", "died": "die",
    "spied": "spi", "using": "use", "the": "the", "was": "was", "skies": "sky", "geologi": "geolog",
}


def test_stems(column):
    got = column(lambda t: F.element_at(tokens.stem_tokens(F.array(t)), 1), list(STEMS))
    assert dict(zip(STEMS, got)) == STEMS == {w: porter.stem(w) for w in STEMS}
