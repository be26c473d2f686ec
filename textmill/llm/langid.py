"""Language identification by sparse multinomial logistic regression.

Character n-grams of one to three code points (lower case, digits and white space each
made one sign) are hashed to ``FEATURES`` places. Features are log counts times inverse
document frequency, scaled to length one. Document frequencies are counted over all
learning documents: each task adds up one vector, and vectors are summed by place. The
model is fitted with the follow-the-regularised-leader rule (per-coordinate rates, L1 and
L2 penalties, so most weights are exactly zero) on a sample that the driver holds as sparse
vectors of bounded length: of each language the first ``LANG_ROWS`` learning documents by a
hash of the id, and the first ``FIT_ROWS`` of all, so every language of the learning rows is
learned, however rare. An id counts once. A part of each language that has enough of them is
kept out of the fit, and on it one temperature is chosen by which the scores are divided, so
that they are probabilities.

Prediction is row-local over whole texts; the model (``FEATURES`` weights a language) is
sent to the workers.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; if nothing
can be learned from, all are; rows without an id are not learned from; of rows with one id
the least text is; repeated rows give equal rows; ties go to the first language
by name; columns other than those named are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import fold_remainder, text_rows
from textmill.session import materialize

FOLDS, HELD_OUT = 4, 2
FEATURES = 1 << 15
FIT_ROWS = 3072
#: Rows of each language that are in the sample, if there are as many.
LANG_ROWS = 256
#: One row in so many of a language's sample is kept for the temperature.
CALIBRATION = 5
#: Hashes are compared in so many steps; rows are thinned out to this multiple of the bound
#: before they are ranked.
_STEPS, _MARGIN = 1 << 31, 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05

_LETTER = regex.compile(r"\p{L}")
_SIGNS = regex.compile(r"[\s\p{N}]+")


def grams(text: str) -> np.ndarray:
    """Counts of hashed n-grams."""
    points = np.frombuffer(_SIGNS.sub(" ", f" {text.lower()} ").encode("utf-32-le"), "<u4").astype(np.uint32)
    counts = np.zeros(FEATURES, np.int64)
    h = points * np.uint32(0x9E3779B1)
    for n in range(3):
        if n:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + points[n:] * np.uint32(0x9E3779B1)
        if len(h):
            mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
            counts += np.bincount(mixed >> np.uint32(17), minlength=FEATURES)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features."""
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    return at, values / max(np.sqrt((values * values).sum()), 1e-12)


class FollowTheLeader:
    """Multinomial logistic regression with the proximal rule."""

    def __init__(self, classes: int) -> None:
        self.z = np.zeros((classes, FEATURES + 1))
        self.n = np.zeros((classes, FEATURES + 1))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        at, values = np.r_[at, FEATURES], np.r_[values, 1.0]  # the last place is the bias
        weights = self.weights(at)
        p = _softmax((weights @ values)[None])[0]
        p[label] -= 1
        slope = p[:, None] * values
        n = self.n[:, at]
        self.z[:, at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA * weights
        self.n[:, at] = n + slope * slope


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by a search over a grid."""
    if not len(labels):
        return 1.0
    choices = np.geomspace(0.02, 20, 121)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in choices]
    return float(choices[int(np.argmin(losses))])


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Of each place the texts that have it, and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += grams(text) > 0
                texts += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[at, FEATURES].astype(np.int32)), pa.array(np.r_[total[at], texts])], ["place", "n"]
        )

    sums = rows.select("text").mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r.place: r.n for r in sums.collect()}
    return np.array([found.get(i, 0) for i in range(FEATURES)]), found.get(FEATURES, 0)


def sampled(learning: DataFrame) -> DataFrame:
    """``(text, lang, mark, doc_id)``: the rows to fit on, one per id. Rows are thinned out
    by their hashes first, so what is ranked is bounded. What is broadcast has a row per
    language, or per row of the sample; the model has far more numbers for each."""
    mark = F.xxhash64("doc_id", F.lit("lang"))
    marked = learning.where("doc_id is not null").select("doc_id", "lang", mark.alias("mark"))
    ids = marked.groupBy("lang").agg(F.greatest(F.approx_count_distinct("doc_id"), F.lit(1)).alias("ids"))
    all_ids = F.sum("ids").over(Window.partitionBy(F.lit(0)))
    kept = F.greatest(F.lit(float(LANG_ROWS)) / F.col("ids"), F.lit(float(FIT_ROWS)) / all_ids)
    shares = ids.select("lang", F.least(F.lit(1.0), kept * _MARGIN).alias("share"))
    step = F.pmod(F.shiftright("mark", 8), F.lit(_STEPS))
    low = step < F.col("share") * _STEPS
    thin = materialize(marked.join(F.broadcast(shares), "lang").where(low).dropDuplicates(["doc_id"]).drop("share"), "langid-thin")
    order = [step, F.col("mark"), F.col("doc_id")]
    of_lang = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    of_all = F.row_number().over(Window.orderBy(*order))
    chosen = thin.select("doc_id", "mark", of_lang.alias("of_lang"), of_all.alias("of_all"))
    chosen = chosen.where((F.col("of_lang") <= LANG_ROWS) | (F.col("of_all") <= FIT_ROWS)).select("doc_id", "mark")
    rows = learning.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "mark").agg(F.min(F.struct("text", "lang")).alias("one"))
    return one.select("one.text", "one.lang", "mark", "doc_id")


def fit(learning: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float] | None:
    """Languages, idf, weights and temperature from ``(doc_id, text, lang)``."""
    df, n = document_frequencies(learning)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    sample = sampled(learning)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = [], []
            for text in batch.column(0).to_pylist():
                at, value = weighted(grams(text), idf)
                places.append(at.astype(np.int16))
                values.append(value.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.float32())), *batch.columns[1:]],
                ["places", "vals", "lang", "mark", "doc_id"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(
        vectors, f"places array<smallint>, vals array<float>, lang string, mark bigint, doc_id {kind}"
    ).toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["mark", "doc_id"], kind="stable")
    langs = sorted(set(rows["lang"]))
    label = rows["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy()
    data = [(np.asarray(p, np.int64), np.asarray(v, float)) for p, v in zip(rows["places"], rows["vals"], strict=True)]
    model = FollowTheLeader(len(langs))
    nth = rows.groupby("lang").cumcount().to_numpy()
    sizes = np.bincount(label)[label]
    out = (nth % CALIBRATION == 0) & (sizes >= 2 * CALIBRATION)
    fitted, kept_out = np.flatnonzero(~out), np.flatnonzero(out)
    for _ in range(EPOCHS):
        for i in fitted:
            model.learn(*data[i], label[i])
    weights = model.weights(slice(None))
    logits = np.array([weights[:, at] @ v + weights[:, FEATURES] for at, v in (data[i] for i in kept_out)])
    return langs, idf, weights, temperature(logits, label[kept_out])


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``."""
    learning = docs.where("text is not null and lang is not null").where(
        fold_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    )
    model = fit(learning.select("doc_id", "text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                if model is None or not _LETTER.search(text):
                    names.append("und")
                    scores.append(0.0)
                    continue
                langs, idf, weights, heat = model
                at, values = weighted(grams(text), idf)
                p = _softmax((weights[:, at] @ values + weights[:, FEATURES])[None] / heat)[0]
                names.append(langs[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    held = fold_remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
