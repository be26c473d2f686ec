"""N-gram counts for the places of texts, asked for a block of texts at a time.

Texts are read once into blocks: a block holds its texts as numbers of its own words. It
asks for each different n-gram once, and packed: what is shuffled are a few bytes for an
n-gram of a block, not a row of words for an n-gram of a text. Step 1 deals words into
buckets by their bytes; a bucket counts them and gives each a number. Step k deals pairs of a
context, the number of the ``k - 1`` words before, and a word into buckets by the context. The
bucket adds up the counts of the training blocks and answers every block that asked.

A context seen more often than ``SPLIT`` is shared out among several buckets by the word
after it, as its count, known from the step before, tells each block alike. So no bucket
grows with the text; the block adds up what they say of the context.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from textmill.session import materialize

#: Places of tokens in a block, and those whose n-grams a bucket answers for, about.
BLOCK, BUCKET = 1_000_000, 2_000_000
#: Occurrences of a context that one bucket takes, about.
SPLIT = 250_000
TRAIN, JUDGED = 1, 2


class Job(NamedTuple):
    """Buckets; occurrences of a context that one takes; more than the shares of any context;
    the model's discount and the size that single words are counted against."""

    buckets: int
    split: int
    most: int
    discount: float
    size: int


_BODY = StructField("body", ArrayType(BinaryType()))
#: What a block asks a bucket.
_ASKED = StructType([StructField("part", IntegerType()), StructField("block", LongType()), StructField("role", IntegerType()), _BODY])


def _rows(kind: StructType) -> StructType:
    """Blocks (step 0; the part is the role) and what they were answered in each later step."""
    names = [("block", LongType()), ("step", IntegerType()), ("part", IntegerType()), ("ids", ArrayType(kind)), ("size", LongType())]
    return StructType([*[StructField(*n) for n in names], _BODY])


def _batch(rows: list[tuple], shape: StructType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(shape)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(shape))], shape.names)


# --- Packing --------------------------------------------------------------------
def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, by the bytes that the largest needs, first bytes first."""
    values = np.ascontiguousarray(values, "<i8")
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.view("u1").reshape(-1, 8)[:, :width].T.tobytes()
    return struct.pack("<QB", len(values), width) + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    planes = np.frombuffer(pa.decompress(data[9:], n * width, "zstd"), "u1")
    values = np.zeros((n, 8), "u1")
    values[:, :width] = planes.reshape(width, n).T
    return values.reshape(-1).view("<i8")


def _pack_words(words: list[bytes]) -> bytes:
    data = b" ".join(words)
    return struct.pack("<Q", len(data)) + pa.compress(data, "zstd", asbytes=True)


def _unpack_words(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], *struct.unpack_from("<Q", data), "zstd", asbytes=True).split(b" ")


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *arrays])


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(np.int64)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    return ((numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def _back(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.empty(len(order), np.int64)
    found[order] = values
    return found


def _keyed(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, int]:
    """One number for each pair of numbers, in the order of the pairs, and the bits of the second."""
    bits = int(second.max(initial=0)).bit_length()
    if bits + int(first.max(initial=0)).bit_length() > 63:
        raise OverflowError(f"pairs of numbers up to {first.max()} and {second.max()}")
    return (first << bits) | second, bits


def _order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The places of different pairs of numbers in the order of the pairs."""
    return np.argsort(_keyed(first, second)[0])


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    values, starts = np.unique(sorted_values, return_index=True)
    yield from zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(sorted_values)])


# --- Blocks ---------------------------------------------------------------------
def _encoded(texts: DataFrame, role: int, max_length: int | None) -> DataFrame:
    """Texts as blocks: ids, lengths, places as numbers of the block's words, and the words."""
    # Python splits at the 29 code points of ``words``; lower case is Spark's.
    rows = texts.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    shape = _rows(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, lengths, places, words, size = [], [], [], defaultdict(), 0

        def block() -> pa.RecordBatch:
            body = [pack(np.array(lengths)), pack(_joined(places)), _pack_words([w.encode() for w in words])]
            # Blocks of both roles are told apart by the last bits.
            return _batch([(number * 4 + role, 0, role, ids, int(sum(lengths)), body)], shape)

        words.default_factory = words.__len__
        for part in batches:
            for at in range(part.num_rows):
                tokens = part.column(1)[at].as_py().split()[:max_length]
                ids.append(part.column(0)[at].as_py())
                lengths.append(len(tokens))
                places.append(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
                size += 1 + len(tokens)
                if size >= BLOCK:
                    yield block()
                    ids, lengths, places, words, size = [], [], [], defaultdict(), 0
                    words.default_factory = words.__len__
                    number += 1
        if ids:
            yield block()

    return rows.mapInArrow(run, shape)


class _Block:
    """The places of a block, and their probabilities as far as steps 1 to ``steps`` tell."""

    def __init__(self, rows: list[dict], steps: int, job: Job):
        own = next(row for row in rows if row["step"] == 0)
        answers = defaultdict(list)
        for row in sorted(rows, key=lambda r: r["part"]):
            answers[row["step"]].append([unpack(b) for b in row["body"]] if row["step"] else None)
        self.number, self.role, self.ids = own["block"], own["part"], own["ids"]
        self.job = job
        self.lengths, self.places = (unpack(b) for b in own["body"][:2])
        self.words = _unpack_words(own["body"][2]) if len(self.places) else []
        #: Place within its text; places that have an n-gram of the step, and its number in the block.
        self.inside = np.arange(len(self.places)) - np.repeat(_starts(self.lengths), self.lengths)
        self.at, self.here = np.arange(len(self.places)), self.places
        for step in range(1, steps + 1):
            parts = answers[step]
            columns = [_joined(list(c)) for c in zip(*parts)] or [np.zeros(0, np.int64)] * 5
            if step == 1:
                self._told_words(columns)
            else:
                self._pair(step)
                self._told_pairs(columns)

    def _told_words(self, columns: list[np.ndarray]) -> None:
        order, _ = self._by_word()
        n, self.n_all, self.numbers = (_back(order, c) for c in columns[:3])
        self.word_numbers = self.numbers
        self.p = ((n + 1) / self.job.size)[self.places]

    def _told_pairs(self, columns: list[np.ndarray]) -> None:
        n = _back(self.order, columns[0])
        of_group = self.group_context[self.group_order]
        total, kinds = (_sums(of_group, c, len(self.contexts))[self.context_of] for c in columns[1:3])
        self.n_all, self.numbers = (_back(self.order, c) for c in columns[3:5]) if len(columns) > 3 else (None, None)
        seen, all_of = (total > 0)[self.here], np.maximum(total, 1)
        own, shared = np.maximum(n - self.job.discount, 0) / all_of, self.job.discount * kinds / all_of
        shorter = self.p[self.at]
        self.p[self.at] = np.where(seen, own[self.here] + shared[self.here] * shorter, shorter)

    def _by_word(self) -> tuple[np.ndarray, np.ndarray]:
        buckets = np.fromiter(map(crc32, self.words), np.int64, len(self.words)) % self.job.buckets
        order = np.argsort(buckets, kind="stable")
        return order, buckets[order]

    def ask_words(self) -> Iterator[tuple]:
        order, buckets = self._by_word()
        counts = np.bincount(self.places, minlength=len(self.words))[order]
        for part, a, b in _runs(buckets):
            yield part, self.number, self.role, [_pack_words([self.words[i] for i in order[a:b]]), pack(counts[a:b])]

    def _pair(self, step: int) -> None:
        """The different pairs of a context and a word after it, put in order by bucket and
        group; a group is a context, or one share of a frequent one."""
        before = np.empty(len(self.places), np.int64)
        before[self.at] = self.here
        self.at = np.flatnonzero(self.inside >= step - 1)
        pairs = (before[self.at - 1] << 32) | self.places[self.at]
        pairs, self.here, self.times = np.unique(pairs, return_inverse=True, return_counts=True)
        words = self.word_numbers[pairs & 0xFFFFFFFF]
        self.contexts, self.context_of = np.unique(pairs >> 32, return_inverse=True)
        shares = 1 + self.n_all[self.contexts] // self.job.split
        first = _starts(shares)
        self.group_context = np.repeat(np.arange(len(self.contexts)), shares)
        share = np.arange(len(self.group_context)) - first[self.group_context]
        keys = self.numbers[self.contexts][self.group_context] * self.job.most + share
        buckets = _mixed(keys) % self.job.buckets
        self.group_order = _order(buckets, keys)
        self.group_keys, self.group_buckets = keys[self.group_order], buckets[self.group_order]
        rank = _back(self.group_order, np.arange(len(keys)))
        group = rank[first[self.context_of] + _mixed(words) % shares[self.context_of]]
        self.order = _order(group, words)
        self.sizes = np.bincount(group, minlength=len(keys))
        self.asked = words[self.order]

    def ask_pairs(self, step: int) -> Iterator[tuple]:
        self._pair(step)
        bounds, times = np.concatenate([[0], np.cumsum(self.sizes)]), self.times[self.order]
        for part, a, b in _runs(self.group_buckets):
            sizes, own = self.sizes[a:b], slice(bounds[a], bounds[b])
            # Keys rise, and so do the words of a group.
            rises = np.diff(self.asked[own], prepend=0)
            firsts = _starts(sizes)[sizes > 0]
            rises[firsts] = self.asked[own][firsts]
            body = [np.diff(self.group_keys[a:b], prepend=0), sizes, rises, times[own]]
            yield part, self.number, self.role, [pack(values) for values in body]

    def losses(self) -> tuple[np.ndarray, np.ndarray]:
        """Per text, the mean over its tokens from the second on, and whether it has one."""
        judged = self.inside > 0
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)[judged]
        lost = np.bincount(text, -np.log(self.p[judged]), len(self.lengths))
        return lost / np.maximum(self.lengths - 1, 1), self.lengths > 1


# --- Buckets --------------------------------------------------------------------
def _ranked(n_all: np.ndarray, part: int, buckets: int) -> np.ndarray:
    """Numbers that no other bucket gives, small ones to what is frequent."""
    return _back(np.argsort(-n_all, kind="stable"), np.arange(len(n_all))) * buckets + part


def _told_words(part: int, rows: list[dict], buckets: int) -> list[tuple]:
    places: dict[bytes, int] = defaultdict()
    places.default_factory = places.__len__
    asked = [np.fromiter(map(places.__getitem__, _unpack_words(r["body"][0])), np.int64) for r in rows]
    times = [unpack(r["body"][1]) for r in rows]
    at = _joined(asked)
    n_all = _sums(at, _joined(times), len(places))
    n = _sums(at, _joined([t * (r["role"] & TRAIN) for t, r in zip(times, rows)]), len(places))
    numbers = _ranked(n_all, part, buckets)
    # Words and different words of the training texts are told once.
    sizes = [int(n.sum() + np.count_nonzero(n)), *[0] * len(rows)]
    return [
        (r["block"], 1, part, None, size, [pack(n[own]), pack(n_all[own]), pack(numbers[own])])
        for r, own, size in zip(rows, asked, sizes)
    ]


def _told_pairs(part: int, rows: list[dict], buckets: int, step: int, last: bool) -> list[tuple]:
    keys, sizes, words, times = [], [], [], []
    for r in rows:
        key_rises, size, rises, n = (unpack(b) for b in r["body"])
        upto = np.cumsum(rises)
        before = np.concatenate([[0], upto])[_starts(size)]
        keys.append(np.cumsum(key_rises))
        sizes.append(size)
        words.append(upto - np.repeat(before, size))
        times.append(n)
    contexts, context = np.unique(_joined(keys), return_inverse=True)
    keyed, bits = _keyed(np.repeat(context, _joined(sizes)), _joined(words))
    pairs, at = np.unique(keyed, return_inverse=True)
    of = pairs >> bits
    n = _sums(at, _joined([t * (r["role"] & TRAIN) for t, r in zip(times, rows)]), len(pairs))
    total, kinds = _sums(of, n, len(contexts)), _sums(of, n > 0, len(contexts))
    if not last:
        n_all = _sums(at, _joined(times), len(pairs))
        numbers = _ranked(n_all, part, buckets)
    told, group, pair = [], 0, 0
    for r, k, w in zip(rows, keys, words):
        groups, own = context[group : group + len(k)], at[pair : pair + len(w)]
        group, pair = group + len(k), pair + len(w)
        if not last or r["role"] & JUDGED:
            body = [n[own], total[groups], kinds[groups], *([] if last else [n_all[own], numbers[own]])]
            told.append((r["block"], step, part, None, 0, [pack(values) for values in body]))
    return told


# --- Steps ----------------------------------------------------------------------
def losses(texts: DataFrame, train: DataFrame, order: int, max_length: int | None, discount: float) -> DataFrame:
    """``(doc_id, loss, n_tokens)`` of ``texts`` under the model of ``train`` (see ``ngram``)."""
    if texts is train and max_length is None:
        blocks = _encoded(texts, TRAIN + JUDGED, None)
    else:
        judged, none = _encoded(texts, JUDGED, max_length), F.lit(None).cast(texts.schema["doc_id"].dataType)
        blocks = _encoded(train.select(none.alias("doc_id"), "text"), TRAIN, None).unionByName(judged)
    blocks = materialize(blocks, "gram-blocks", release=True)
    shape = blocks.schema
    places = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(2 * texts.sparkSession.sparkContext.defaultParallelism, 1 + places // BUCKET)
    # No context has as many shares as ``most``.
    job = Job(buckets, SPLIT, 2 + places // SPLIT, discount, 1)

    def dealt(rows: DataFrame, key: str) -> GroupedData:
        return rows.repartition(buckets, key).groupBy(key)

    known = blocks
    for step in range(1, order + 1):
        if step == 1:
            asked = blocks.mapInArrow(_asking_words(job), _ASKED)
        else:
            asked = dealt(known, "block").applyInArrow(_asking_pairs(job, step), _ASKED)
        told = dealt(asked, "part").applyInArrow(_telling(buckets, step, step == order, shape), shape)
        told = materialize(told, f"gram-answers-{step}", release=True)
        if step == 1:
            job = job._replace(size=1 + (told.agg(F.sum("size")).first()[0] or 0))
        known = known.unionByName(told)

    fields = [StructField("doc_id", shape["ids"].dataType.elementType), StructField("loss", DoubleType()), StructField("n_tokens", IntegerType())]
    judged = known.where(F.col("block").bitwiseAND(F.lit(JUDGED)) > 0)
    return dealt(judged, "block").applyInArrow(_scoring(job, order, StructType(fields)), StructType(fields))


def _asking_words(job: Job) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(part.num_rows):
                yield _batch(list(_Block(part.slice(at, 1).to_pylist(), 0, job).ask_words()), _ASKED)

    return run


def _asking_pairs(job: Job, step: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table.to_pylist(), step - 1, job)
        return pa.Table.from_batches([_batch(list(block.ask_pairs(step)), _ASKED)])

    return run


def _telling(buckets: int, step: int, last: bool, shape: StructType) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        # In one order, whatever order they came in.
        part, rows = key[0].as_py(), sorted(table.to_pylist(), key=lambda r: r["block"])
        told = _told_words(part, rows, buckets) if step == 1 else _told_pairs(part, rows, buckets, step, last)
        return pa.Table.from_batches([_batch(told, shape)])

    return run


def _scoring(job: Job, order: int, shape: StructType) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        block = _Block(table.to_pylist(), order, job)
        lost, judged = block.losses()
        # A text without an id is told its length only.
        lost = [x if j and i is not None else None for i, x, j in zip(block.ids, lost.tolist(), judged)]
        return pa.Table.from_batches([_batch(list(zip(block.ids, lost, block.lengths.tolist())), shape)])

    return run
