"""Porter's suffix stripper (M. F. Porter, "An algorithm for suffix stripping",
1980) over an array of lower-case tokens, with the extensions that stemmers used
for ROUGE commonly make to it.

``stem_tokens`` is a column: each step is a table of suffix rules turned into one
``CASE`` inside a ``transform``, computed in the JVM, in place. ``stem`` does the same
for one token, with a bounded memory of tokens met, inside Arrow functions that have the
tokens in Python anyway.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A consonant "y" is held as "Y" while the steps run, so that every condition on
# vowels and consonants is a plain character class.
V, C = "[aeiouy]", "[^aeiouy]"
M0 = f"{C}*{V}+{C}.*"  # measure above 0
M1 = f"{C}*{V}+{C}+{V}+{C}.*"  # measure above 1
HAS_VOWEL = f".*{V}.*"
ENDS_CVC = f"(?:.*{C}{V}[^aeiouywxY]|{V}{C})"  # a two-letter stem counts as well

# --- Fixed values: suffix, replacement, condition on the stem ----------------
IRREGULAR = {
    "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
STEP_1A = (("sses", "ss", ""), ("ies", "i", ""), ("ss", "ss", ""), ("s", "", ""))
STEP_2 = (
    ("ational", "ate", M0), ("tional", "tion", M0), ("enci", "ence", M0), ("anci", "ance", M0),
    ("izer", "ize", M0), ("bli", "ble", M0), ("alli", "al", M0), ("entli", "ent", M0),
    ("eli", "e", M0), ("ousli", "ous", M0), ("ization", "ize", M0), ("ation", "ate", M0),
    ("ator", "ate", M0), ("alism", "al", M0), ("iveness", "ive", M0), ("fulness", "ful", M0),
    ("ousness", "ous", M0), ("aliti", "al", M0), ("iviti", "ive", M0), ("biliti", "ble", M0),
    ("fulli", "ful", M0),
)
STEP_3 = (
    ("icate", "ic", M0), ("ative", "", M0), ("alize", "al", M0), ("iciti", "ic", M0),
    ("ical", "ic", M0), ("ful", "", M0), ("ness", "", M0),
)
STEP_4 = (
    ("al", "", M1), ("ance", "", M1), ("ence", "", M1), ("er", "", M1), ("ic", "", M1),
    ("able", "", M1), ("ible", "", M1), ("ant", "", M1), ("ement", "", M1), ("ment", "", M1),
    ("ent", "", M1), ("ion", "", M1), ("ou", "", M1), ("ism", "", M1), ("ate", "", M1),
    ("iti", "", M1), ("ous", "", M1), ("ive", "", M1), ("ize", "", M1),
)


def _swap(word: Column, stem: str, suffix: str, into: str) -> Column:
    """Replace the suffix where the stem pattern holds; else keep the word."""
    return F.regexp_replace(word, f"^({stem}){suffix}$", f"$1{into}")


def _cases(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    first, *rest = branches
    return reduce(lambda acc, b: acc.when(*b), rest, F.when(*first)).otherwise(otherwise)


def _table(word: Column, rules: tuple) -> Column:
    """The first rule whose suffix fits decides, also when its condition fails.
    Rules are looked up by last letter first, which leaves few suffixes to try."""
    by_letter: dict[str, list] = {}
    for suffix, into, cond in rules:
        by_letter.setdefault(suffix[-1], []).append((suffix, into, cond))
    branches = [
        (
            F.endswith(word, F.lit(letter)),
            _cases([(F.endswith(word, F.lit(s)), _swap(word, c or ".*", s, into)) for s, into, c in group], word),
        )
        for letter, group in by_letter.items()
    ]
    return _cases(branches, word)


def _mark_consonant_y(word: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(word, "(^|[aeiou])y", "$1Y"), "yy", "yY")
    return F.when(F.contains(word, F.lit("y")), marked).otherwise(word)


def _step_1a(word: Column) -> Column:
    short = F.endswith(word, F.lit("ies")) & (F.length(word) == 4)
    table = _table(word, STEP_1A)
    return F.when(F.endswith(word, F.lit("s")), F.when(short, _swap(word, ".", "ies", "ie")).otherwise(table)).otherwise(word)


def _step_1b(word: Column) -> Column:
    """Cut "ed" and "ing"; a cut word is left with a trailing mark for its repair."""
    four = F.length(word) == 4
    cut = _cases(
        [
            (F.endswith(word, F.lit("ied")), F.when(four, _swap(word, ".", "ied", "ie")).otherwise(_swap(word, ".*", "ied", "i"))),
            (F.endswith(word, F.lit("eed")), _swap(word, M0, "eed", "ee")),
            (F.endswith(word, F.lit("ed")), _swap(word, HAS_VOWEL, "ed", "+")),
            (F.endswith(word, F.lit("ing")), _swap(word, HAS_VOWEL, "ing", "+")),
        ],
        word,
    )
    return F.when(F.endswith(word, F.lit("d")) | F.endswith(word, F.lit("g")), cut).otherwise(word)


def _step_1b_repair(word: Column) -> Column:
    doubled = "|".join(["yY", *(f"{c}{c}" for c in "bcdfghjkmnpqrtvwx0123456789")])
    kept = "|".join(f"{c}{c}" for c in "lsz")
    repaired = _cases(
        [
            (word.rlike(r"(?:at|bl|iz)\+$"), F.regexp_replace(word, r"\+$", "e")),
            (word.rlike(rf"(?:{doubled})\+$"), F.regexp_replace(word, r".\+$", "")),
            (word.rlike(rf"(?:{kept})\+$"), F.regexp_replace(word, r"\+$", "")),
            (word.rlike(rf"^(?={C}*{V}+[^aeiouy+]+{V}*\+$){ENDS_CVC}\+$"), F.regexp_replace(word, r"\+$", "e")),
        ],
        F.regexp_replace(word, r"\+$", ""),
    )
    return F.when(F.endswith(word, F.lit("+")), repaired).otherwise(word)


def _step_1c(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("y")), _swap(word, f".+{C}", "y", "i")).otherwise(word)


def _step_2_alli(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("alli")), _swap(word, M0, "alli", "al")).otherwise(word)


def _step_2(word: Column) -> Column:
    logi = (F.endswith(word, F.lit("logi")), F.regexp_replace(word, f"^(?={C}*{V}+{C}.*ogi$)(.*)logi$", "$1log"))
    return F.when(logi[0], logi[1]).otherwise(_table(word, STEP_2))


def _step_3(word: Column) -> Column:
    return _table(word, STEP_3)


def _step_4(word: Column) -> Column:
    ion = F.regexp_replace(word, f"^(?={M1}ion$)(.*[st])ion$", "$1")
    return F.when(F.endswith(word, F.lit("ion")), ion).otherwise(_table(word, STEP_4))


def _step_5(word: Column) -> Column:
    cut = F.regexp_replace(word, f"^((?:{M1})|(?!{ENDS_CVC}e$)(?:{C}*{V}+{C}+{V}*))e$", "$1")
    single = F.regexp_replace(word, f"^({M1})l$", "$1")
    return _cases([(F.endswith(word, F.lit("e")), cut), (F.endswith(word, F.lit("ll")), single)], word)


_STEPS = (
    _mark_consonant_y, _step_1a, _step_1b, _step_1b_repair, _step_1c,
    _step_2_alli, _step_2, _step_3, _step_4, _step_5,
)


def stem_tokens(tokens: Column, min_chars: int = 4) -> Column:
    """Stem every token of at least ``min_chars`` characters."""
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    # Tokens too short for a stem go through the steps as empty texts, which no
    # rule fits. One ``transform`` per step binds the step's input to a lambda
    # variable; a nested expression would repeat it at each of its uses.
    long = F.transform(tokens, lambda t: F.when(F.length(t) >= min_chars, t).otherwise(""))
    stems = reduce(lambda acc, step: F.transform(acc, step), _STEPS, long)
    return F.zip_with(
        tokens,
        stems,
        lambda token, stem: F.when(F.length(token) < min_chars, token)
        .when(token.isin(*IRREGULAR), irregular[token])
        .otherwise(F.lower(stem)),
    )


@lru_cache(maxsize=1024)
def _rule(stem: str, suffix: str) -> re.Pattern:
    return re.compile(f"({stem}){suffix}")


def _swapped(word: str, stem: str, suffix: str, into: str) -> str:
    met = _rule(stem or ".*", suffix).fullmatch(word)
    return met[1] + into if met else word


def _by_table(word: str, rules: tuple) -> str:
    for suffix, into, condition in rules:
        if word.endswith(suffix):
            return _swapped(word, condition, suffix, into)
    return word


#: What a token must end in for any step to change it.
_ENDS = ("s", "ed", "ing", "y", "logi", "ion", "e", "ll", *(suffix for suffix, *_ in STEP_2 + STEP_3 + STEP_4))
_DOUBLED = re.compile("(?:yY|([bcdfghjkmnpqrtvwx0-9])\\1)$")
_SHORT = re.compile(f"(?=^{C}*{V}+[^aeiouy]+{V}*$){ENDS_CVC}")
_LOGI = re.compile(f"(?={C}*{V}+{C}.*ogi$)(.*)logi")
_ION = re.compile(f"(?={M1}ion$)(.*[st])ion")
_FINAL_E = re.compile(f"((?:{M1})|(?!{ENDS_CVC}e$)(?:{C}*{V}+{C}+{V}*))e")
_FINAL_L = re.compile(f"({M1})l")


def _cut_ed_ing(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return _swapped(word, M0, "eed", "ee")
    for suffix in ("ed", "ing"):
        if word.endswith(suffix):
            cut = word[: -len(suffix)]
            if not re.search(V, cut):
                return word
            if cut.endswith(("at", "bl", "iz")):
                return cut + "e"
            if _DOUBLED.search(cut):
                return cut[:-1]
            if cut.endswith(("ll", "ss", "zz")):
                return cut
            return cut + "e" if _SHORT.fullmatch(cut) else cut
    return word


@lru_cache(maxsize=1 << 17)
def stem(token: str, min_chars: int = 4) -> str:
    if len(token) < min_chars:
        return token
    if token in IRREGULAR:
        return IRREGULAR[token]
    if not token.endswith(_ENDS):
        return token.lower()
    word = re.sub("yy", "yY", re.sub("(^|[aeiou])y", r"\1Y", token)) if "y" in token else token
    if word.endswith("s"):
        word = word[:-1] if word.endswith("ies") and len(word) == 4 else _by_table(word, STEP_1A)
    word = _cut_ed_ing(word)
    if word.endswith("y"):
        word = _swapped(word, f".+{C}", "y", "i")
    if word.endswith("alli"):
        word = _swapped(word, M0, "alli", "al")
    if word.endswith("logi"):
        met = _LOGI.fullmatch(word)
        word = met[1] + "log" if met else word
    else:
        word = _by_table(word, STEP_2)
    word = _by_table(word, STEP_3)
    if word.endswith("ion"):
        met = _ION.fullmatch(word)
        word = met[1] if met else word
    else:
        word = _by_table(word, STEP_4)
    if word.endswith("e"):
        met = _FINAL_E.fullmatch(word)
        word = met[1] if met else word
    elif word.endswith("ll"):
        met = _FINAL_L.fullmatch(word)
        word = met[1] if met else word
    return word.lower()
