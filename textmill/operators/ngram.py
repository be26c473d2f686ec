"""A count-based n-gram language model: the scorer behind perplexity.

Counts of a training table, interpolated from order to order with absolute discounting
(Ney, Essen and Kneser, 1994): of what was seen after a context, ``DISCOUNT`` is taken from
every count and given to the next shorter context; at the bottom are words with one added
to each count and one unseen word. A context that was never seen says nothing, and the
shorter one counts alone.

    P(w | h) = max(c(hw) - D, 0) / c(h) + D kinds(h) / c(h) P(w | shorter h)
    P(w)     = (c(w) + 1) / (N + V + 1)

``probabilities`` is counts, combined on the map side, and equi-joins on a table of n-grams.
``token_losses`` has the n-grams of texts counted and looked up packed, a block of texts at a
time (``gramblocks``), as a row of words for every n-gram of every text fills the disks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textmill.operators import gramblocks
from textmill.session import materialize

ORDER = 2
DISCOUNT = 0.75
#: N-grams a task holds before it hands them on.
MOST_HELD = 200_000


def _tally(texts: DataFrame, order: int, max_length: int | None, key: str | None) -> DataFrame:
    """``(word, h1 .., times)`` of the places of tokens: ``h1`` .. are the words before it, 1
    to ``order - 1`` of them; empty where the text has not as many. With a ``key``, one row per
    text and n-gram, next to the key; without, partial counts over many texts, each counted
    once. A text is split once and its n-grams are counted where it is read."""
    names = ["word", *[f"h{k}" for k in range(1, order)]]

    def count(tokens: list[str], into: Counter) -> None:
        before = [
            chain([""] * min(k, len(tokens)), map(" ".join, zip(*[tokens[j:] for j in range(k)])))
            for k in range(1, order)
        ]
        into.update(zip(tokens, *before))

    def batch(keys: list, counted: list[Counter]) -> pa.RecordBatch:
        grams = list(chain.from_iterable(counted))
        columns = [pa.array(c, pa.string()) for c in (zip(*grams) if grams else [[] for _ in names])]
        columns.append(pa.array(list(chain.from_iterable(c.values() for c in counted)), pa.int64()))
        if key:
            rows = np.repeat(np.arange(len(counted)), [len(c) for c in counted])
            columns.insert(0, pa.array(keys, kind).take(pa.array(rows)))
        return pa.RecordBatch.from_arrays(columns, [key] * bool(key) + [*names, "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counted, size = [], [Counter()] * (not key), 0
        for part in batches:
            for at in range(part.num_rows):
                tokens = part.column(1)[at].as_py().split()[:max_length]
                if key:
                    keys.append(part.column(0)[at].as_py())
                    counted.append(Counter())
                count(tokens, counted[-1])
                size = size + len(counted[-1]) if key else len(counted[0])
                if size >= MOST_HELD:
                    yield batch(keys, counted)
                    keys, counted, size = [], [Counter()] * (not key), 0
        yield batch(keys, counted)

    # Python splits at the 29 code points of ``words``; lower case is Spark's.
    rows = texts.select(key or F.lit(0).alias("none"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    kind = to_arrow_type(rows.schema[0].dataType)
    shape = StructType([*rows.schema.fields[: bool(key)], *[StructField(n, StringType()) for n in names], StructField("times", LongType())])
    return rows.mapInArrow(run, shape)


def _counted(train: DataFrame, order: int) -> dict[int, DataFrame]:
    """Per order, ``(h, word, n)`` of the n-grams, without ``h`` for single words."""
    contexts = [f"h{k}" for k in range(1, order)]
    whole = _tally(train, order, None, None).groupBy("word", *contexts).agg(F.sum("times").alias("n"))
    whole = materialize(whole, "ngrams")
    counts = {1: materialize(whole.groupBy("word").agg(F.sum("n").alias("n")), "ngrams-1")}
    for k in range(1, order):
        grams = whole.where(F.col(f"h{k}") != "").select(F.col(f"h{k}").alias("h"), "word", "n")
        # The longest n-grams are told apart already.
        counts[k + 1] = grams if k == order - 1 else materialize(grams.groupBy("h", "word").agg(F.sum("n").alias("n")), f"ngrams-{k + 1}")
    return counts


def probabilities(grams: DataFrame, train: DataFrame, order: int = ORDER) -> DataFrame:
    """``grams`` (``word``, ``h1`` ..) with ``p``, under the model of ``(doc_id, text)``
    rows. A training table without a word gives every word probability 1."""
    counts = _counted(train, order)
    size = counts[1].agg((F.coalesce(F.sum("n"), F.lit(0)) + F.count(F.lit(1)) + 1).alias("size")).scalar()
    told = grams.join(counts[1], "word", "left")
    told = told.withColumn("p", (F.coalesce("n", F.lit(0)) + 1) / size).drop("n")
    for k in range(1, order):
        seen = counts[k + 1]
        context = seen.groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        found = told.join(seen.withColumnRenamed("h", f"h{k}"), [f"h{k}", "word"], "left")
        found = found.join(context.withColumnRenamed("h", f"h{k}"), f"h{k}", "left")
        own = F.greatest(F.coalesce("n", F.lit(0)) - F.lit(DISCOUNT), F.lit(0.0)) / F.col("total")
        shared = F.lit(DISCOUNT) * F.col("kinds") / F.col("total") * F.col("p")
        told = found.withColumn("p", F.when(F.col("total") > 0, own + shared).otherwise(F.col("p"))).drop("n", "total", "kinds")
    return told


def token_losses(texts: DataFrame, train: DataFrame, order: int = ORDER, max_length: int | None = None) -> DataFrame:
    """``(doc_id, loss, n_tokens)`` of every text: the mean negative log-probability of its
    tokens from the second on, given those before; null for fewer than two tokens. Texts are
    cut to ``max_length`` tokens, if given. ``doc_id`` is not repeated."""
    return gramblocks.losses(texts, train, order, max_length, DISCOUNT)
