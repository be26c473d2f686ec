"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report, quote mark, clause end,
other. Three letter-to-letter transducers rewrite the symbols of a clause: negation marks
what stands shortly after a negating word, reported speech what follows a verb of saying
in its clause or stands in its quotation, over as many clauses as that has (a quotation
that no later sign closes ends with its clause), and the target transducer joins an insult or a threat with a
person addressed before or after it. They are composed once into one table; a clause is
one walk through it. What is scored is the matched clauses by kind, not the words.

Learned from labelled rows (never from held-out ones): the insult stems, which are the
shortest word beginnings found almost only in toxic texts, with their log odds as
weights, and the weight of each kind of clause, by logistic regression that starts from
``PRIOR``. The fit uses at most ``FIT_ROWS`` labelled rows of either class, the first by
a hash of the id, which bounds what the driver holds: a stem is in a share of the toxic ones.
Scoring reads each whole text once, row-locally. Elided words count by their parts
("l'imbécile"); a line break inside a sentence, before a small letter, ends no clause. Texts in which an
automaton of all stems finds none are not walked; of those without quotation signs, where
nothing passes from clause to clause, only the clauses with a stem are.

Defined cases: a null or empty text has no clause and gets the score of none; without
labelled rows of both classes ``PRIOR`` decides and there are no insult stems; repeated
rows give equal rows; columns other than those named are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm.common import fold_remainder, text_rows
from textmill.session import materialize

FOLDS = 5
FIT_ROWS = 4096
#: Lengths of word beginnings that can be stems.
SHORTEST, LONGEST = 3, 12
#: Of the texts with a stem, at least this share is toxic; and it is in at least so many
#: toxic texts, by number and by share.
PRECISION = 0.98
SUPPORT, SUPPORT_SHARE = 3, 0.015
#: Log odds above this add no weight.
FULL_WEIGHT = 8.0

THREATS = {
    "kill", "hurt", "destroy", "beat", "shoot", "stab", "murder", "töten", "umbringen", "schlagen", "vernichten",
    "tuer", "tuerai", "frapper", "détruire", "matar", "mataré", "golpear", "destruir",
}
TARGETS = {
    "you", "your", "yours", "yourself", "u", "du", "dich", "dir", "dein", "deine", "euch", "toi", "te", "vous",
    "votre", "tú", "ti", "usted", "ustedes", "vosotros",
}
NEGATIONS = {
    "not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "aucun",
    "nunca", "ningún",
}
REPORTS = {
    "said", "says", "wrote", "called", "quoted", "claimed", "sagte", "schrieb", "nannte", "dit", "écrit", "appelé",
    "dijo", "escribió", "llamó",
}

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
#: What the composed grammar writes: nothing, or a clause of a kind.
NOTHING, PLAIN, AIMED, NEGATED, REPORTED, MENACE = range(6)
KINDS = ("plain", "aimed", "negated", "reported", "menace")
#: Bias, then the weight of each kind.
PRIOR = (-3.0, 5.0, 6.0, 1.0, 1.0, 5.0)
#: Words over which negation, a target before and a target after reach.
NEGATION_REACH, BEFORE, AFTER = 3, 4, 3

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[\"“”«»„]|[.!?;\n]+")
#: A line break inside a sentence.
_WRAPPED = regex.compile(r"(?<=[\p{L}\p{N},])[ \t]*\r?\n[ \t]*(?=\p{Ll})")
_ENDS = ".!?;\n"
_QUOTES = "\"“”«»„"


class Transducer:
    """Deterministic and letter-to-letter: ``step(state, symbol)`` gives the next state
    and the symbol written. States are tuples, the start is given."""

    def __init__(self, start, step) -> None:
        self.start, self.step = start, step

    def __rshift__(self, after: Transducer) -> Transducer:
        """Composition: the output of this one is read by the other."""

        def step(state, symbol):
            own, middle = self.step(state[0], symbol)
            other, out = after.step(state[1], middle)
            return (own, other), out

        return Transducer((self.start, after.start), step)

    def table(self, symbols: Sequence) -> tuple[np.ndarray, list]:
        """All reachable states numbered: next state and output by state and symbol."""
        numbers, rows, queue = {self.start: 0}, [], [self.start]
        for state in queue:
            row = []
            for symbol in symbols:
                following, out = self.step(state, symbol)
                if following not in numbers:
                    numbers[following] = len(numbers)
                    queue.append(following)
                row.append((numbers[following], out))
            rows.append(row)
        return rows


# Symbols between the transducers are (symbol, negated, reported).
def _negation(left: int, symbol: int):
    if symbol == END:
        return 0, (symbol, False)
    if symbol == NEGATION:
        return NEGATION_REACH, (symbol, False)
    return max(0, left - 1), (symbol, left > 0)


def _report(state: tuple[bool, bool], read: tuple[int, bool]):
    said, quoted = state
    symbol, negated = read
    if symbol == REPORT:
        said = True
    elif symbol == QUOTE:
        quoted = said and not quoted
    elif symbol == END:
        said = False  # what is quoted stays so up to the closing sign
    return (said, quoted), (symbol, negated, said or quoted)


def _aim(state: tuple[int, int, int], read: tuple[int, bool, bool]):
    """State: reach of the last target, reach of the last open insult or threat, and
    which of them that is."""
    target, open_, what = state
    symbol, negated, reported = read
    if symbol == END:
        return (0, 0, NOTHING), NOTHING
    target, open_ = max(0, target - 1), max(0, open_ - 1)
    if symbol == TARGET:
        out = {PLAIN: AIMED, MENACE: MENACE}.get(what, NOTHING) if open_ else NOTHING
        return (BEFORE + 1, 0, NOTHING), out
    if symbol in (INSULT, THREAT):
        if reported:
            return (target, 0, NOTHING), REPORTED if symbol == INSULT else NOTHING
        if negated:
            return (target, 0, NOTHING), NEGATED if symbol == INSULT else NOTHING
        if symbol == INSULT:
            return (target, 0 if target else AFTER + 1, PLAIN), AIMED if target else PLAIN
        return (target, 0 if target else AFTER + 1, MENACE), MENACE if target else NOTHING
    return (target, open_, what if open_ else NOTHING), NOTHING


def grammar() -> list:
    cascade = Transducer(0, _negation) >> Transducer((False, False), _report) >> Transducer((0, 0, NOTHING), _aim)
    return cascade.table(range(8))


class Scorer:
    """Clause evidence of texts for given stems and weights."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.stems = stems
        self.lengths = sorted({len(s) for s in stems})
        self.rows = grammar()
        self.classes = {w: c for words, c in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in words}
        self.finder = ahocorasick.Automaton()
        for word in [*stems, *THREATS]:
            self.finder.add_word(word, len(word))
        self.finder.make_automaton()

    def symbol(self, word: str) -> tuple[int, float]:
        if word in self.classes:
            return self.classes[word], 1.0
        if word[0] in _ENDS:
            return END, 0.0
        if not word[0].isalnum():
            return QUOTE, 0.0
        for n in self.lengths:
            weight = self.stems.get(word[:n])
            if weight is not None and len(word) >= n:
                return INSULT, weight
        if "'" in word or "’" in word:
            parts = word.replace("’", "'").split("'")
            joined = "'".join(parts)
            known = self.symbol(joined) if joined != word else (OTHER, 0.0)
            return known if known[0] != OTHER else self._elided(parts)
        return OTHER, 0.0

    def _elided(self, parts: list[str]) -> tuple[int, float]:
        """The symbol of an elided word: of its insult or threat, else of the first part
        that has one."""
        read = [self.symbol(part) for part in parts]
        strong = [r for r in read if r[0] in (INSULT, THREAT)]
        return next(iter(strong or [r for r in read if r[0] != OTHER]), (OTHER, 0.0))

    def _walk(self, low: str, start: int, stop: int, sums: list[float], closing: int = -1) -> None:
        """Adds the clauses between two places; ``closing`` is the place of the last
        quotation sign, behind which no state passes on."""
        state, weight = 0, 0.0
        for match in _WORD.finditer(low, start, stop):
            symbol, own = self.symbol(match.group())
            state, kind = self.rows[state][symbol]
            weight = own if symbol in (INSULT, THREAT) else weight
            if kind:
                sums[kind - 1] += weight
            if symbol == END and match.start() > closing:
                state = 0

    def evidence(self, text: str) -> list[float]:
        """Summed weights of the matched clauses, by kind."""
        low = (_WRAPPED.sub(" ", text) if "\n" in text else text).lower()
        sums, done = [0.0] * len(KINDS), -1
        closing = max(low.rfind(c) for c in _QUOTES)
        for last, n in self.finder.iter(low):
            begin = last - n + 1
            if begin <= done or (begin and low[begin - 1].isalnum()):
                continue
            if closing >= 0:
                self._walk(low, 0, len(low), sums, closing)
                break
            start = max(low.rfind(c, done + 1, begin) for c in _ENDS)
            start = max(start, done) + 1
            stops = [p for c in _ENDS if (p := low.find(c, last)) >= 0]
            stop = min(stops, default=len(low))
            done = stop
            self._walk(low, start, stop, sums)
        return sums


def _beginnings(text: str) -> set[str]:
    words = {m.lower() for m in re.findall(r"[^\W_]+", text)}
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Insult stems and their weights from ``(text, toxic)`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for text, toxic in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                counts[toxic].update(_beginnings(text))
            stems = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(stems, pa.string()), *[pa.array([c[s] for s in stems], pa.int64()) for c in counts]]
            yield pa.RecordBatch.from_arrays(columns, ["stem", "clean", "toxic"])

    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return {}
    found = (
        sample.select("text", "toxic")
        .mapInArrow(count, "stem string, clean bigint, toxic bigint")
        .groupBy("stem")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= max(SUPPORT, SUPPORT_SHARE * n_toxic))
        # Shares, so that the sample's balance does not matter.
        .where(F.col("toxic") / n_toxic >= PRECISION * (F.col("toxic") / n_toxic + F.col("clean") / n_clean))
        .collect()
    )
    kept: dict[str, float] = {}
    for row in sorted(found, key=lambda r: (len(r.stem), r.stem)):
        if any(row.stem[:n] in kept for n in range(SHORTEST, len(row.stem))):
            continue
        odds = np.log((row.toxic + 0.5) / (n_toxic + 1)) - np.log((row.clean + 0.5) / (n_clean + 1))
        kept[row.stem] = float(min(odds, FULL_WEIGHT) / FULL_WEIGHT)
    return kept


def fit_weights(features: np.ndarray, toxic: np.ndarray, share: float, prior: Sequence[float] = PRIOR) -> np.ndarray:
    """Logistic regression by Newton's method, drawn towards ``prior``; the classes are
    weighted to the given share of toxic rows."""
    weights = np.array(prior)
    if len(features) and 0 < toxic.sum() < len(toxic):
        own = toxic.mean()
        row = np.where(toxic == 1, share / own, (1 - share) / (1 - own))
        table = np.column_stack([np.ones(len(features)), np.log1p(features)])
        pull = 0.5
        for _ in range(25):
            p = 1 / (1 + np.exp(-table @ weights))
            slope = table.T @ (row * (p - toxic)) + pull * (weights - prior)
            curve = (table * (row * p * (1 - p))[:, None]).T @ table + pull * np.eye(len(weights))
            step = np.linalg.solve(curve, slope)
            weights = weights - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-9:
                break
    return weights


def _evidence(stems: dict[str, float], at: int, out: list[str]):
    """A row-local pass that puts the evidence after a batch's columns ``out``; the text
    is column ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            table = np.array([scorer.evidence(t or "") for t in texts], float).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out], *[pa.array(c) for c in table.T]], [*out, *KINDS])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """Stems and weights of the kinds of clause. ``labels`` has ``doc_id``, ``toxic``."""
    marked = (
        labels.where("toxic is not null and doc_id is not null")
        .where(fold_remainder(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = [F.xxhash64("doc_id", F.lit("toxic")), F.col("doc_id")]
    share = marked.agg(F.avg("toxic").alias("share")).first().share or 0.0
    parts = [marked.where(F.col("toxic") == toxic).orderBy(*order).limit(FIT_ROWS) for toxic in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]), "toxicity-chosen")  # at most twice FIT_ROWS ids
    sample = text_rows(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    sample = materialize(sample, "toxicity-sample")
    stems = learn_stems(sample)
    shape = "toxic int, " + ", ".join(f"{k} double" for k in KINDS)
    rows = sample.mapInArrow(_evidence(stems, 0, ["toxic"]), shape).toPandas().sort_values(["toxic", *KINDS]).to_numpy(float)
    return stems, fit_weights(rows[:, 1:], rows[:, 0], share)


def _score(weights: np.ndarray):
    logit = F.lit(float(weights[0]))
    for k, w in zip(KINDS, weights[1:], strict=True):
        logit = logit + F.log1p(F.col(k)) * float(w)
    return 1 / (1 + F.exp(-logit))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` and the evidence by kind of clause."""
    stems, weights = fit(docs, labels)
    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, " + ", ".join(f"{k} double" for k in KINDS)
    value = _score(weights)
    return rows.mapInArrow(_evidence(stems, 1, ["doc_id"]), shape).select(
        "doc_id",
        (fold_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        value.alias("score"),
        F.when(value >= 0.5, 1).otherwise(0).alias("predicted"),
        *KINDS,
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not toxic, with all their columns, in one row-local pass. Columns
    go by place, so they may have any names."""
    stems, weights = fit(docs, labels)
    moved = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = [T.StructField(f.name, f.dataType) for f in moved.schema] + [T.StructField(k, T.DoubleType()) for k in KINDS]
    found = moved.mapInArrow(_evidence(stems, docs.columns.index("text"), moved.columns), T.StructType(fields))
    return found.where(_score(weights) < 0.5).select(*moved.columns).toDF(*docs.columns)
