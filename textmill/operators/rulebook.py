"""Guard rules kept in a table, for books of thousands of rules.

A rule is ``(place, pattern, category)``: a ``java.util.regex`` pattern, matched anywhere
in any case. The rule of the least place that hits decides, as in a ``CASE``. A ``CASE`` of
a thousand patterns runs nearly all of them on every text. Here each pattern gives literals
of which every match holds one; one automaton of all literals reads a text once and picks
the rules that can hit, and only their patterns run, in the JVM. Rules without such a
literal run on every text. Nothing is shuffled: picking and matching are row-local.

The book goes to the driver and to each worker, so its size is checked: more than
``MOST_RULES`` rules are an error. Null patterns are left out, a null text is empty.

A book that grows with the data is matched ``spread``: rules of one pattern become one class,
and each class gets keys, hashes of signs that a match must hold: where two literals stand
within ``WIDEST`` signs of each other, the end of one and the beginning of the other, else the
beginning of a literal. Every place of a text makes the same hashes; a bitmap of bounded size
leaves those that some class may have, an equi-join leaves the classes, and their patterns
then run in the JVM. Nothing of the book but the bitmap passes through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from textmill.functions import guards
from textmill.functions.text import once
from textmill.session import materialize

MOST_RULES = 100_000
#: Shorter literals are in nearly every text.
SHORTEST = 3
#: What folds to an ASCII letter when case is ignored, and these letters.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZſKİı"
_LOWER = "abcdefghijklmnopqrstuvwxyzskii"
_FOLD = str.maketrans(_UPPER, _LOWER)
_CANDIDATE = "array<struct<place: bigint, pattern: string, category: string>>"
#: Signs of each of two literals and of a single one in a key: the most of these that it has.
PAIRED, SINGLE = (8, 5, 4, 3, 2), (12, 8, 6, 4, 3)
#: The most signs between the two.
WIDEST = 8
#: Classes that hold nothing that folds to an ASCII letter.
_BARE = ("[^a-z]", "[^A-Z]", "[^a-zA-Z]", "[^A-Za-z]", "\\s")
#: Keys under which classes without a certain literal meet all texts.
SALTS = 64
#: Bits of the map of keys, and signs of text hashed at once.
KEY_BITS, CHUNK = 27, 1 << 18
_KEY = StructType([StructField("key", LongType()), *[StructField(n, IntegerType()) for n in ("head", "tail", "bare", "least", "most")]])
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(2 * max(SINGLE))]


def literals(pattern: str) -> list[str]:
    """Folded ASCII literals of which every match holds at least one, the longest of each
    alternative; none if some alternative has none that is certain."""
    if "\\Q" in pattern or re.search(r"\(\?(?![:=!<>])", pattern):  # quotations, flags
        return []
    best, run, found, depth, i = "", "", [], 0, 0

    def closed() -> str:
        return max(best, run, key=len)

    while i < len(pattern):
        sign, width = pattern[i], 1
        if sign == "\\":
            sign, width = pattern[i : i + 2], 2
            if sign[1:].isalnum():
                if sign[1:] in "xuopPcNk0":  # takes more signs
                    return []
                sign = "."  # a class, a place or a group again
        elif sign == "[":
            width = _class_width(pattern, i)
        plain = depth == 0 and (len(sign) == 2 or sign not in "[](){}|.^$*+?")
        following = pattern[i + width : i + width + 1]
        if sign == "(":
            depth += 1
        elif sign == ")":
            depth -= 1
        if plain and sign[-1].isascii() and following not in ("*", "?", "{"):
            run += sign[-1].translate(_FOLD)
            if following == "+":
                best, run = closed(), ""
        else:
            best, run = closed(), ""
            if sign == "{":
                width = max(1, pattern.find("}", i) + 1 - i)
            if sign == "|" and depth == 0:
                found, best = [*found, best], ""
        i += width
    found = [*found, closed()]
    return found if all(len(f) >= SHORTEST for f in found) else []


def _class_width(pattern: str, at: int) -> int:
    """Signs of the bracketed class that begins at a place, nested ones included."""
    depth, i = 0, at
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == "[":
            depth += 1
        elif pattern[i] == "]" and i > at + 1 and pattern[at + 1 : i] != "^":
            depth -= 1
            if not depth:
                return i + 1 - at
        i += 1
    return len(pattern) - at


def folded(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _picker(book: list[tuple[int, str, str]]):
    """A function from folded texts to the rules that can hit, by place."""
    import ahocorasick

    owners: dict[str, list[int]] = {}
    always = []
    for number, (_, pattern, _) in enumerate(book):
        needed = literals(pattern)
        if not needed:
            always.append(number)
        for literal in set(needed):
            owners.setdefault(literal, []).append(number)
    finder = ahocorasick.Automaton()
    for literal, numbers in owners.items():
        finder.add_word(literal, numbers)
    finder.make_automaton()

    def pick(text: str) -> list[int]:
        met = set(always)
        if owners:
            for _, numbers in finder.iter(text):
                met.update(numbers)
        return sorted(met)

    return pick


def candidates(text: Column, rules: DataFrame) -> Column:
    """Rules whose literals a text holds, by place."""
    rows = (
        rules.where("pattern is not null")
        .select(F.col("place").cast("bigint"), F.concat(F.lit("(?iu)"), "pattern").alias("pattern"), "category")
        .limit(MOST_RULES + 1)
        .collect()
    )
    if len(rows) > MOST_RULES:
        raise ValueError(f"a book holds at most {MOST_RULES} rules")
    # Among rules of one place, pattern and category decide.
    book = sorted(((r.place, r.pattern, r.category) for r in rows), key=lambda r: (r[0], r[1], r[2] or ""))
    shared = rules.sparkSession.sparkContext.broadcast(book)

    @F.arrow_udf(_CANDIDATE)
    def picked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        pick = _picker([(place, pattern[len("(?iu)") :], category) for place, pattern, category in own])
        shape = pa.list_(pa.struct([("place", pa.int64()), ("pattern", pa.string()), ("category", pa.string())]))
        for batch in batches:
            found = [
                [dict(zip(("place", "pattern", "category"), own[i], strict=True)) for i in pick(t)]
                for t in batch.to_pylist()
            ]
            yield pa.array(found, shape)

    return picked(folded(text))


def match_rules(df: DataFrame, text: str, rules: DataFrame, hits: str = "hits", spread: bool = False) -> DataFrame:
    """``df`` with the rules that hit a text column, ``array<struct<place, category>>`` by
    place. ``spread`` is for books of any size: one entry stands for all rules of one pattern,
    ``array<struct<place, category, n_rules>>``, with the first of them and their number."""
    if spread:
        return _match_classes(df, text, rules, hits)
    whole = F.coalesce(F.col(text), F.lit(""))
    real = F.filter("__picked", lambda r: F.rlike(whole, r["pattern"]))
    slim = F.transform(real, lambda r: F.struct(r["place"].alias("place"), r["category"].alias("category")))
    picked = df.select("*", once(candidates(F.col(text), rules)).alias("__picked"))
    return picked.select(*[F.col(f"`{c}`") for c in df.columns], once(slim).alias(hits))


def _atoms(pattern: str) -> list[tuple[str, int, int | None, bool]] | None:
    """A pattern without groups and alternatives as ``(sign, least, most, bare)`` of its signs:
    a folded ASCII sign that stands there once, or nothing and how many signs there can be
    (``None``: any number), and whether those are no letters. None for what this does not read."""
    if re.search(r"(?<!\\)[()|]", pattern) or "\\\\" in pattern or "&&" in pattern:
        return None
    found, i = [], 0
    while i < len(pattern):
        sign, width, signs, start = pattern[i], 1, 1, i
        if sign == "\\":
            sign, width = pattern[i + 1 : i + 2], 2
            if not sign or (sign.isalnum() and sign not in "dDwWsShHvVntrfeabB"):
                return None
            signs = 0 if sign in ("b", "B") else 1
            sign = "" if sign.isalnum() else sign
        elif sign == "[":
            sign, width = "", _class_width(pattern, i)
        elif sign in "^$.":
            sign, signs = "", int(sign == ".")
        i += width
        bare = not signs or pattern[start:i] in _BARE
        quantity = re.match(r"(?:([*+?])|\{(\d+)(,?)(\d*)\})[?+]?", pattern[i:])
        least, most = signs, signs
        if quantity:
            mark, low, comma, high = quantity.groups()
            times = {"*": (0, None), "+": (1, None), "?": (0, 1)}[mark] if mark else (int(low), int(high) if high else None if comma else int(low))
            least, most = least * times[0], None if times[1] is None else most * times[1]
            sign, i = "", i + quantity.end()
        elif sign and sign in "*+?{":
            return None
        found.append((sign.translate(_FOLD) if sign.isascii() else "", least, most, bare))
    return found


def _most(sizes: tuple[int, ...], literal: str) -> int:
    return next(size for size in sizes if size <= len(literal))


def _pair(pattern: str) -> tuple[str, str, bool, int, int] | None:
    """The end of a literal and the beginning of the next one, whether no letter can be
    between them, and the least and the most signs that can; the pair of the most signs."""
    atoms = _atoms(pattern)
    if atoms is None:
        return None
    runs, least, most, bare, opened = [], 0, None, True, False  # literals and what is before each
    for sign, low, high, letterless in atoms:
        if sign and opened:
            runs[-1][0] += sign
        elif sign:
            runs.append([sign, bare, least, most])
            opened = True
        else:
            if opened:
                least, most, bare, opened = 0, 0, True, False
            least, most = least + low, None if most is None or high is None else most + high
            bare = bare and letterless
    pairs = [
        (a[-_most(PAIRED, a) :], b[: _most(PAIRED, b)], *between)
        for (a, *_), (b, *between) in zip(runs, runs[1:])
        if between[2] is not None and between[2] <= WIDEST and min(len(a), len(b)) >= min(PAIRED)
    ]
    best = max(pairs, key=lambda p: len(p[0]) + len(p[1]), default=None)
    return best if best and len(best[0]) + len(best[1]) > SHORTEST else None


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashed(codes: np.ndarray, starts: np.ndarray, head: int, between: int, tail: int) -> np.ndarray:
    """For each start the hash of ``head`` signs from there on and, after so many between, of
    ``tail`` more."""
    hashes = np.full(len(starts), head << 8 | tail, np.uint64)
    places = [*range(head), *range(head + between, head + between + tail)]
    for place, power in zip(places, _POWERS):
        hashes += codes[starts + place] * power
    hashes ^= hashes >> np.uint64(32)
    hashes *= _POWERS[0]
    return hashes ^ hashes >> np.uint64(29)


def _pattern_keys(pattern: str) -> list[tuple[int, int, int, int, int, int]]:
    """A key of each alternative, with its signs of head and tail and what is between; none if
    some alternative has none."""
    needed = set(literals(pattern))
    pair = _pair(pattern) if needed else None
    parts = [pair] if pair else [(n[: _most(SINGLE, n)], "", False, 0, 0) for n in needed]
    return [
        (int(_hashed(_codes(a + b), np.zeros(1, int), len(a), 0, len(b)).view(np.int64)[0]), len(a), len(b), int(bare), least, most)
        for a, b, bare, least, most in parts
    ]


@F.arrow_udf(ArrayType(_KEY))
def _class_keys(patterns: pa.Array) -> pa.Array:
    shape = pa.list_(pa.struct([("key", pa.int64()), *[(n, pa.int32()) for n in _KEY.names[1:]]]))
    keys = [[dict(zip(_KEY.names, key, strict=True)) for key in _pattern_keys(p)] for p in patterns.to_pylist()]
    return pa.array(keys, shape)


def _key_map(keyed: DataFrame) -> np.ndarray:
    """A bit for each key's lowest bits, as bytes."""
    place = F.col("key").bitwiseAND((1 << KEY_BITS) - 1) + 1
    bits = keyed.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    buckets = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    whole = np.zeros(1 << KEY_BITS - 3, np.uint8)
    for bucket, part in buckets:
        whole[(bucket - 1) * len(part) : bucket * len(part)] = np.frombuffer(part, np.uint8)
    return whole


def _text_keys(rows: DataFrame, shapes: list[tuple[int, int, int, int]], key_map: np.ndarray, salted: bool) -> DataFrame:
    """``(row, key)`` of the keys in ``(row, text)`` that some class may have."""
    shared = rows.sparkSession.sparkContext.broadcast(key_map.tobytes())

    def keys(numbers: np.ndarray, texts: list[np.ndarray]) -> pa.RecordBatch:
        # No text holds the sign between two texts.
        codes = np.concatenate([part for text in texts for part in (text, np.array([0x110000], np.uint64))])
        ends = np.cumsum([len(text) + 1 for text in texts])
        bits = np.frombuffer(shared.value, np.uint8)
        owners, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        letters = np.concatenate([[0], np.cumsum((codes >= 97) & (codes <= 122))])
        begun = {}  # where a span of so many signs without a letter begins
        for head, between, tail, bare in shapes:
            last = len(codes) - head - between - tail
            if bare and between not in begun:
                begun[between] = np.flatnonzero(letters[between:] == letters[: len(letters) - between])
            starts = begun[between] - head if bare else np.arange(max(0, last + 1))
            starts = starts[(starts >= 0) & (starts <= last)]
            hashes = _hashed(codes, starts, head, between, tail)
            bit = hashes & np.uint64((1 << KEY_BITS) - 1)
            met = np.flatnonzero(bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            owners.append(np.searchsorted(ends, starts[met], side="right"))
            found.append(hashes[met].view(np.int64))
        if salted:
            owners.append(np.arange(len(texts)))
            found.append(numbers % SALTS)
        owner, key = np.concatenate(owners), np.concatenate(found)
        order = np.lexsort((key, owner))
        owner, key = owner[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (np.diff(owner) != 0) | (key[1:] != key[:-1])
        return pa.RecordBatch.from_arrays([pa.array(numbers[owner[new]]), pa.array(key[new])], ["row", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, texts, size, first = batch.column(0).to_numpy(), [], 0, 0
            for at in range(batch.num_rows):
                texts.append(_codes(batch.column(1)[at].as_py()))
                size += len(texts[-1])
                if size >= CHUNK or at == batch.num_rows - 1:
                    yield keys(numbers[first : at + 1], texts)
                    texts, size, first = [], 0, at + 1

    return rows.mapInArrow(run, "row bigint, key bigint")


def _match_classes(df: DataFrame, text: str, rules: DataFrame, hits: str) -> DataFrame:
    place = F.col("place").cast("bigint").alias("place")
    first = F.min(F.struct(place, F.coalesce("category", F.lit("")).alias("order"), "category")).alias("first")
    classes = rules.where("pattern is not null").groupBy("pattern").agg(first, F.count(F.lit(1)).alias("n_rules"))
    classes = classes.select("pattern", "first.place", "first.category", "n_rules", once(_class_keys("pattern")).alias("keys"))
    salts = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.struct(s.cast("bigint"), *[F.lit(0)] * 5).cast(_KEY))
    keyed = classes.select(
        "place", "category", "n_rules", F.concat(F.lit("(?iu)"), "pattern").alias("pattern"),
        F.inline(F.when(F.size("keys") > 0, F.col("keys")).otherwise(salts)),
    )
    keyed = materialize(keyed, "rule-keys")
    found = [tuple(r) for r in keyed.select(*_KEY.names[1:]).distinct().collect()]
    shapes = sorted({(r[0], between, r[1], r[2]) for r in found if r[0] for between in range(r[3], r[4] + 1)})
    stored = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "rule-texts")
    texts = stored.select(F.col("__row").alias("row"), folded(F.col(text)).alias("text"))
    met = _text_keys(texts, shapes, _key_map(keyed), any(not head for head, *_ in found))
    entry = ("place", "category", "n_rules", "pattern")
    picked = met.join(keyed.select("key", *entry), "key").groupBy("row").agg(F.collect_set(F.struct(*entry)).alias("__picked"))
    whole = F.coalesce(F.col(text), F.lit(""))
    real = F.filter("__picked", lambda r: F.rlike(whole, r["pattern"]))
    slim = F.transform(F.array_sort(real), lambda r: F.struct(*[r[n].alias(n) for n in ("place", "category", "n_rules")]))
    joined = stored.join(picked.withColumnRenamed("row", "__row"), "__row", "left")
    none = F.from_json(F.lit("[]"), "array<struct<place: bigint, category: string, n_rules: bigint>>")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], once(F.coalesce(slim, none)).alias(hits))


def check_inputs(df: DataFrame, rules: DataFrame, prompt: str = "prompt", safe_mode: Column | None = None) -> DataFrame:
    """``df`` with ``verdict``, as ``guards.check_input`` gives it, by the rules of a table."""
    matched = match_rules(df, prompt, rules, "__hits")
    category = F.get("__hits", F.lit(0))["category"]
    verdict = guards.check_input(F.col(prompt), safe_mode, matched=category)
    return matched.select(*[F.col(f"`{c}`") for c in df.columns], verdict.alias("verdict"))
