"""Secret scans with a trigram inverted index, in DataFrame operations only.

Each rule's regular expression is parsed on the driver and turned into a Boolean query
over trigrams (a union of intersections) that every text with a match satisfies. The
index holds postings (trigram, document) of the trigrams that any rule asks for.
Intersecting postings names the candidate documents of each rule; the expression itself
runs on those alone. A rule without a mandatory trigram scans all texts.

Trigrams are compared in lower case, so the same postings serve rules of either case.

Defined cases: a null text is empty; an empty text has no span; repeated rows are each
scanned and give equal rows; columns other than ``doc_id`` and ``text`` are ignored; an
empty table gives an empty result. Spans of one rule never overlap, those of different
rules may. Positions are code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import IGNORECASE, _constants, _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import once, text_rows


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must hold ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("keyblock", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE

#: Literal strings a part of an expression may stand for before it is cut off there.
MOST_STRINGS = 64
#: Matches whose positions are summed in one go; longer lists are summed by chunks.
CHUNK = 512


def _product(left: set[str], right: set[str]) -> set[str]:
    return {a + b for a, b in product(left, right)}


def _grams(strings: set[str]) -> list[frozenset[str]] | None:
    """A union of intersections of trigrams; None if some string has no trigram."""
    terms = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    return terms if all(terms) else None


def _walk(items) -> tuple[set[str] | None, list[list[frozenset[str]]]]:
    """Of a parsed sequence: all strings it can match, if they are few, and else the
    unions that each match satisfies at once."""
    run, exact, needs = {""}, True, []

    def cut() -> None:
        nonlocal run, exact
        terms = _grams(run)
        if terms:
            needs.append(terms)
        run, exact = {""}, False

    for op, arg in items:
        own: set[str] | None = None
        inner: list[list[frozenset[str]]] = []
        if op is _constants.LITERAL:
            own = {chr(arg).lower()}
        elif op is _constants.IN:
            if all(o is _constants.LITERAL for o, _ in arg):
                own = {chr(a).lower() for _, a in arg}
        elif op is _constants.SUBPATTERN:
            own, inner = _walk(arg[3])
        elif op is _constants.BRANCH:
            parts = [_walk(branch) for branch in arg[1]]
            if all(strings is not None for strings, _ in parts):
                own = set().union(*[strings for strings, _ in parts])
            elif all(unions for _, unions in parts):
                # Some branch is matched, so one of their first unions holds.
                inner = [[term for _, unions in parts for term in unions[0]]]
        elif op is _constants.MAX_REPEAT:
            least, most, body = arg
            strings, unions = _walk(body)
            if strings is not None and least == most and least <= 8:
                own = {""}
                for _ in range(least):
                    own = _product(own, strings)
            elif strings is not None and (least, most) == (0, 1):
                own = strings | {""}
            elif least > 0:
                inner = unions or ([_grams(strings)] if strings and _grams(strings) else [])
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = _product(run, own)
            continue
        cut()
        needs.extend(inner)
        if own is not None and len(own) <= MOST_STRINGS:
            run = own
    if exact:
        return run, [terms] if (terms := _grams(run)) else []
    cut()
    return None, needs


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """A union of intersections of lower-case trigrams that every match of the pattern
    satisfies; empty if there is none, and the rule must scan all texts. Of the unions
    that hold at once, the one with the longest shortest intersection is taken."""
    _, needs = _walk(_parser.parse(pattern, IGNORECASE))
    terms = max(needs, key=lambda terms: (min(map(len, terms)), -len(terms)), default=[])
    return [t for t in terms if not any(other < t for other in terms)]


def _terms(rules: tuple[Rule, ...]) -> tuple[list[str], list[tuple[str, int, frozenset[str]]]]:
    terms = [(r.kind, n, term) for r in rules for n, term in enumerate(trigram_query(r.pattern))]
    return sorted(set().union(*[t for *_, t in terms])) if terms else [], terms


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index ``(gram, doc_id)`` of the trigrams that the rules ask for."""
    grams, _ = _terms(rules)
    lowered = once(text_rows(docs), __low=F.lower("text"))
    found = [F.when(F.contains("__low", F.lit(g)), F.lit(g)) for g in grams]
    return lowered.select("doc_id", F.explode(F.array_compact(F.array(*found))).alias("gram")).select("gram", "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, kinds)``: for each document the rules whose query its postings satisfy.
    The table of queries is as long as the rules are, and broadcast."""
    _, terms = _terms(rules)
    rows = [(gram, kind, n, len(term)) for kind, n, term in terms for gram in sorted(term)]
    asked = index.sparkSession.createDataFrame(rows, "gram string, kind string, term int, n_grams int")
    return (
        index.join(F.broadcast(asked), "gram")
        .groupBy("doc_id", "kind", "term", "n_grams")
        .agg(F.count_distinct("gram").alias("n"))
        .where("n = n_grams")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _positions(parts: Column, matches: Column, kept: Column, kind: int) -> Column:
    """Spans from the lengths of what stands between matches and of the matches."""

    def within(first: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans"))
        last = F.least(first + CHUNK - 1, F.size(matches) - 1)

        def step(state: Column, i: Column) -> Column:
            begin = state["at"] + F.get(parts, i)
            end = begin + F.get(matches, i)
            span = F.struct(begin.alias("begin"), end.alias("end"), F.lit(kind).alias("kind"))
            spans = F.when(F.get(kept, i), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(F.sequence(first, last), start, step)

    return F.when(
        F.size(matches) > 0, F.transform(F.sequence(F.lit(0), F.size(matches) - 1, F.lit(CHUNK)), within)
    )


SPANS = "array<struct<begin:bigint,end:bigint,kind:int>>"


def _joined(chunks: Column) -> Column:
    """Chunks of spans with positions relative to their chunk, as one list."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPANS}>").alias("lists"))

    def step(state: Column, chunk: Column) -> Column:
        moved = F.transform(
            chunk["spans"],
            lambda s: F.struct(
                (s["begin"] + state["at"]).alias("begin"), (s["end"] + state["at"]).alias("end"), s["kind"].alias("kind")
            ),
        )
        return F.struct((state["at"] + chunk["at"]).alias("at"), F.concat(state["lists"], F.array(moved)).alias("lists"))

    return F.coalesce(F.flatten(F.aggregate(chunks, start, step)["lists"]), F.array().cast(SPANS))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carried: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text, spans)`` and the columns ``carried``: all spans of each text, by start, then rule; ``kind`` is
    the rule's place in ``rules``. The candidate list joins by a broadcast only when
    Spark has measured it to be small."""
    rows = text_rows(docs, *carried)
    indexed = {r.kind for r in rules if trigram_query(r.pattern)}
    if indexed:
        found_in = candidates(postings(docs, rules), rules).withColumnRenamed("doc_id", "__id")
        rows = rows.join(found_in, F.col("doc_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    found = {}
    for k, r in enumerate(rules):
        regex = F.lit(r.pattern)
        pieces = F.transform(F.split("text", r.pattern, -1), lambda s: F.length(s))
        matches = F.transform(F.regexp_extract_all("text", regex, F.lit(0)), lambda s: F.length(s))
        kept = F.transform(F.regexp_extract_all("text", regex, F.lit(r.group)), lambda s: F.length(s) >= r.least)
        lists = F.struct(pieces.alias("pieces"), matches.alias("matches"), kept.alias("kept"))
        found[f"l{k}"] = F.when(F.array_contains("kinds", r.kind), lists) if r.kind in indexed else lists
    rows = once(rows, **found)
    spans = once(
        rows.select(
            "doc_id",
            "text",
            *carried,
            *[
                _positions(F.col(f"l{k}.pieces"), F.col(f"l{k}.matches"), F.col(f"l{k}.kept"), k).alias(f"p{k}")
                for k in range(len(rules))
            ],
        ),
        spans=F.array_sort(F.concat(*[_joined(F.col(f"p{k}")) for k in range(len(rules))])),
    )
    return spans.select("doc_id", "text", *carried, "spans")


def written(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["begin"], s["end"])), ",")


#: Spans worked on together: the work of a text is its spans times this, not their square.
_FEW = 256


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal covered run replaced by ``mark``."""
    ends = F.transform(spans, lambda s: s["end"])
    first = lambda k: (k * _FEW + 1).cast("int")
    parts = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _FEW).cast("int"))
    peaks = F.transform(parts, lambda k: F.array_max(F.slice(ends, first(k), F.lit(_FEW))))

    def reached(k: Column) -> Column:
        """The spans of a part, each with the furthest end before it."""
        own, until = F.slice(spans, first(k), F.lit(_FEW)), F.slice(ends, first(k), F.lit(_FEW))
        earlier = F.coalesce(F.array_max(F.slice(peaks, F.lit(1), k)), F.lit(0).cast("long"))
        return _bound(
            F.struct(own.alias("own"), until.alias("until"), earlier.alias("earlier")),
            lambda p: F.transform(
                p["own"],
                lambda s, i: F.struct(
                    s["begin"].cast("long").alias("begin"),
                    F.greatest(p["earlier"], F.array_max(F.slice(p["until"], F.lit(1), i))).alias("reach"),
                ),
            ),
        )

    # A run begins where nothing before it reaches; what is kept before it begins there.
    runs = F.filter(F.flatten(F.transform(parts, reached)), lambda s: s["begin"] >= s["reach"])

    def part_text(runs: Column, k: Column) -> Column:
        own = F.slice(runs, first(k), F.lit(_FEW))
        base, stop = F.element_at(own, 1)["reach"], F.element_at(own, -1)["begin"]
        piece = F.substr(text, (base + 1).cast("int"), (stop - base).cast("int"))
        return _bound(
            F.struct(own.alias("own"), base.alias("base"), piece.alias("piece")),
            lambda p: F.array_join(
                F.transform(
                    p["own"],
                    lambda s: F.concat(
                        F.substr(p["piece"], (s["reach"] - p["base"] + 1).cast("int"), (s["begin"] - s["reach"]).cast("int")),
                        F.lit(mark),
                    ),
                ),
                "",
            ),
        )

    def whole(runs: Column) -> Column:
        cuts = F.sequence(F.lit(0), F.floor((F.size(runs) - 1) / _FEW).cast("int"))
        return F.array_join(F.transform(cuts, lambda k: part_text(runs, k)), "")

    done = F.concat(_bound(runs, whole), F.substr(text, (F.array_max(ends) + 1).cast("int")))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redacted_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with their secrets written over, and ``n_chars``, where there is such a
    column, of the new text. Other columns go by place, so they may have any names."""
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]
    others = tuple(c for c in names if c not in ("doc_id", "text"))
    found = scan(docs.toDF(*names), rules, others)
    text = redacted(F.col("text"), F.col("spans"))
    changed = once(found, __text=text).withColumn("text", F.col("__text"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn(names[docs.columns.index("n_chars")], F.length("text").cast("long"))
    return changed.select(*names).toDF(*docs.columns)


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts of the base rules, a digest of their spans, and all
    spans in writing."""
    rows = scan(docs, rules)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    counts = [
        F.size(F.filter("spans.kind", lambda kind: kind == k)).cast("long").alias(f"n_{r.kind}")  # noqa: B023
        for k, r in enumerate(rules[: len(BASE)])
    ]
    return rows.select(
        "doc_id", *counts, F.sha2(written(base, rules), 256).alias("base_sha256"), written(F.col("spans"), rules).alias("spans")
    )
