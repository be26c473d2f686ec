"""Collocations: phrases of two and three words that occur together more than their parts
would, per language.

A text is lower-cased (A-Z), cut into pieces and those into words. Every word begins a
suffix of its piece; a suffix pointer is the word's place. Pointers are sorted by multikey
three-way quicksort (Bentley and Sedgewick, 1997) to a depth of ``DEPTH`` words: a segment
is parted into smaller, equal and greater by one word of a pivot, the equal part goes on
with the next word. The size of an equal part of depth d is the count of its d words. All
segments of a round are parted at once, by array operations.

Partitions that cannot hold a frequent phrase are abandoned on the way, in three steps.
First the leading pairs of words of all suffixes are routed by hash and counted, as one
number per different pair and block. The hashes of the frequent ones set bits in a bitmap
of ``FILTER_BITS`` bits, the only thing sent to the workers; a pair without its bit is
infrequent for certain, the reverse need not hold. Then each task sorts the pointers of
blocks of its own texts, without suffixes that begin with an infrequent pair, and cut
before one. What leaves it is one row per different suffix and block, however hot a word
is. These rows are routed by language and their two leading words, which brings all
suffixes of a phrase together, and sorted again with the first sort's sizes as weights;
here a part lighter than ``least`` is final and abandoned at once, with all phrases in it.
Words are counted in the same pass (as suffixes with a route of their own).

Scores come from joins of the frequent phrases with the counts of their parts. Parts of a
frequent phrase are at least as frequent, so nothing that was abandoned is missed.

Memory: a block of ``BLOCK_BYTES`` of text (one longer text makes a block of its own);
after routing, ``CHUNK_ROWS`` rows plus the different continuations of one pair of words.

Defined cases: null and empty texts have no words; a null language is ``und``; equal texts
count each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.hashing import ODD, mixed, word_hashes
from textmill.session import materialize

DEPTH = 3
LEAST = 10
TOP = 2000
#: A phrase is dropped for a longer one that has so many hundredths of its count.
COVERED = 50
BLOCK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 17
#: A power of two, at least that of one bitmap row of Spark's (32,768 bits).
FILTER_BITS = 1 << 27
UNKNOWN = "und"
#: In place of a second word: the row counts its first word alone. No word holds a space.
ALONE = " "

_END = -1
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SUFFIX = "lang string, w1 string, w2 string, w3 string, n bigint"
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(sorted_values)]]))


def three_way(
    keys: list[np.ndarray],
    order: np.ndarray,
    starts: np.ndarray,
    lengths: np.ndarray,
    weights: np.ndarray | None = None,
    least: int = 1,
):
    """Multikey three-way quicksort of the pointers in ``order``, segment by segment, in
    place; ``keys[d]`` is a pointer's word at depth d, ``_END`` behind its last word.

    Yields ``(depth, pointers, sizes, ended)`` for the equal parts found in each round: a
    pointer into each part, how many words of it are equal, the part's size (or weight), and
    whether that is all of its suffixes. A part of words that go on is yielded once for
    itself (not ended) before it is gone into, but for a part of one pointer, which is
    ended at once where nothing is weighed. Parts lighter than ``least`` are neither yielded
    nor gone into."""
    stacked = np.stack(keys)
    depths = np.zeros(len(starts), np.int8)
    while len(starts):
        if weights is None:
            one = lengths == 1
            if one.any():
                yield len(keys), order[starts[one]], lengths[one], True
        else:
            at = _ranges(starts, lengths)
            one = np.add.reduceat(weights[order[at]], np.cumsum(lengths) - lengths) < least
        starts, lengths, depths = starts[~one], lengths[~one], depths[~one]
        if not len(starts):
            return
        first = np.cumsum(lengths) - lengths
        segment = np.repeat(np.arange(len(starts), dtype=np.int32), lengths)
        at = np.arange(len(segment), dtype=np.int32) + np.repeat((starts - first).astype(np.int32), lengths)
        pointers = order[at]
        words = stacked[depths[segment], pointers] if len(keys) > 1 else stacked[0][pointers]
        trio = np.stack([words[first], words[first + lengths // 2], words[first + lengths - 1]])
        pivots = np.sort(trio, axis=0)[1][segment]
        side = (words >= pivots).view(np.int8) + (words > pivots).view(np.int8)
        # Where each side of each segment begins, and a stable partition into them.
        counts = np.bincount(segment * np.int64(3) + side, minlength=3 * len(starts))
        part_starts = np.repeat(starts, 3)
        part_starts[1::3] += counts[0::3]
        part_starts[2::3] += counts[0::3] + counts[1::3]
        for s in range(3):
            mine = np.flatnonzero(side == s)
            whose = segment[mine]
            earlier = (np.cumsum(counts[s::3]) - counts[s::3])[whose]
            order[np.arange(len(mine)) - earlier + part_starts[s::3][whose]] = pointers[mine]
        # Equal parts are phrases; they go on with the next word unless they end here.
        equal_starts, sizes = part_starts[1::3], counts[1::3]
        found = order[equal_starts]
        stop = stacked[depths, found] == _END
        if weights is not None:
            inside = _ranges(equal_starts, sizes)
            sizes = np.add.reduceat(weights[order[inside]], np.cumsum(sizes) - sizes)
        kept = sizes >= least
        for depth in range(len(keys)):
            for pick, ended in ((kept & stop & (depths == depth), True), (kept & ~stop & (depths == depth), False)):
                if pick.any():
                    yield depth + 1 - ended, found[pick], sizes[pick], ended or depth + 1 == len(keys)
        outer = np.ones(len(starts), bool)
        keep = np.stack([outer, kept & ~stop & (depths + 1 < len(keys)), outer], axis=1).ravel() & (counts > 0)
        depths = np.stack([depths, depths + 1, depths], axis=1).ravel()[keep].astype(np.int8)
        starts, lengths = part_starts[keep], counts[keep]


def _words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of the texts, and for each its piece and its text."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = _KIND[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind == 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    pieces = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else starts
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    owner = (np.searchsorted(begins, starts, side="right") - 1).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[kind == 0]))
    return words.dictionary_encode(), pieces, owner


def _batch(schema: str, *columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [
        (pa.array(c) if isinstance(c, np.ndarray) else c).cast(_TYPES[kind])
        for c, (_, kind) in zip(columns, fields, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _give_back() -> None:
    """Free memory that Arrow keeps goes back to the system: a worker lives on after its task,
    beside those of the next stage."""
    pa.default_memory_pool().release_unused()


def _gathered(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])


class _Block:
    """The words of some texts, with the languages they belong to."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.words, pieces, owner = _words(texts)
        self.tongues = pa.array(langs).dictionary_encode()
        self.tongue = self.tongues.indices.to_numpy().astype(np.int64)[owner]
        self.goes_on = np.zeros(len(owner), bool)
        self.goes_on[:-1] = pieces[1:] == pieces[:-1]
        names = self.tongues.dictionary.to_pylist()
        tongue_hash = np.array([zlib.crc32(name.encode()) for name in names], np.uint64)
        known = np.frombuffer(b" ".join(self.words.dictionary.cast(pa.large_binary()).to_pylist()), np.uint8)
        hashes = word_hashes(known)[2][self.words.indices.to_numpy()]
        with np.errstate(over="ignore"):
            two = hashes * ODD + np.roll(hashes, -1)
            self.pair = mixed(two + tongue_hash[self.tongue] * ODD) if len(two) else two


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    texts, langs, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            more = some.column(0).cast(pa.binary()).to_pylist()
            texts += more
            langs += some.column(1).to_pylist()
            size += sum(map(len, more)) + len(more)
            if size >= BLOCK_BYTES:
                yield _Block(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield _Block(texts, langs)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        pairs, sizes = np.unique(block.pair[block.goes_on], return_counts=True)
        yield _batch("pair bigint, n bigint", pairs.view(np.int64), sizes)
    _give_back()


def _frequent_pairs(rows: DataFrame, least: int) -> Broadcast:
    """A bit for the hash of every pair of neighbours found ``least`` times. Where hashes
    are equal their counts add up, so no frequent pair is missed."""
    sums = rows.mapInArrow(_pair_counts, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    place = F.col("pair").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1  # Spark's buckets count from 1
    parts = (
        sums.where(F.col("n") >= least)
        .groupBy((F.bitmap_bucket_number(place) - 1).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )
    width = 4096  # bytes of one of Spark's bitmaps; all parts together have FILTER_BITS bits
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, found in parts.collect():
        bits[part * width : part * width + width] = np.frombuffer(found, np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bits)


def _block_suffixes(block: _Block, frequent: np.ndarray) -> pa.RecordBatch | None:
    """The different suffixes of a block with their sizes, and its words."""
    n, names, tongues, tongue = len(block.words), block.words.dictionary, block.tongues, block.tongue
    if not n:
        return None
    ids = block.words.indices.to_numpy()
    place = (block.pair & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    on = block.goes_on & ((frequent[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
    keys = [np.full(n, _END, np.int32) for _ in range(1, DEPTH)]
    keys[0][on] = np.roll(ids, -1)[on]
    further = on & np.roll(on, -1)
    keys[1][further] = np.roll(ids, -2)[further]
    # Pointers are dealt to their leading words first; those parts count the words.
    lead = tongue * len(names) + ids
    order = np.argsort(lead, kind="stable").astype(np.int32)
    starts, alone_n = _runs(lead[order])
    alone = order[starts]
    order = order[on[order]]
    whole = []
    if len(order):
        whole = [(f, size) for _, f, size, ended in three_way(keys, order, *_runs(lead[order])) if ended]
    found, found_n = _gathered(whole)
    at = np.concatenate([alone, found])

    def said(column: np.ndarray) -> pa.Array:
        return names.take(pa.array(column, mask=column == _END))

    second = pa.concat_arrays([pa.array([ALONE] * len(alone), names.type), said(keys[0][found])])
    third = pa.concat_arrays([pa.nulls(len(alone), names.type), said(keys[1][found])])
    return _batch(
        _SUFFIX,
        tongues.dictionary.take(pa.array(tongue[at])),
        said(ids[at]),
        second,
        third,
        np.concatenate([alone_n, found_n]),
    )


def _suffixes(frequent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in _blocks(batches):
            found = _block_suffixes(block, frequent.value)
            if found is None:
                continue
            held.append(found)
            size += found.num_rows
            if size > CHUNK_ROWS:  # blocks of one task have much in common
                held = _added_up(held).to_batches()
                size = sum(rows.num_rows for rows in held)
                if size > CHUNK_ROWS // 2:
                    yield from held
                    held, size = [], 0
                    _give_back()
        if held:
            yield from _added_up(held).to_batches()
        del held
        _give_back()

    return run


def _added_up(batches: list[pa.RecordBatch]) -> pa.Table:
    keys = ["lang", "w1", "w2", "w3"]
    rows = pa.Table.from_batches(batches).group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return rows.select([*keys, "n_sum"]).rename_columns([*keys, "n"]).combine_chunks()


_COUNT = "lang string, depth int, w1 string, w2 string, w3 string, n bigint"


class _Routed:
    """Rows of whole routes, in order of routes, as segments for the sort."""

    def __init__(self, rows: pa.Table):
        n = len(rows)
        coded = pa.concat_arrays([rows.column(c).combine_chunks() for c in ("w1", "w2", "w3")]).dictionary_encode()
        self.names = coded.dictionary
        self.codes = coded.indices.fill_null(_END).to_numpy().reshape(3, n)
        self.tongues = rows.column("lang").combine_chunks().dictionary_encode()
        self.tongue = self.tongues.indices.to_numpy()
        self.weights = rows.column("n").to_numpy()
        self.starts, self.lengths = _runs(rows.column("route").to_numpy())
        # A route is one language and pair of words, unless two have the same hash.
        size = np.int64(len(self.names) + 1)
        lead = (self.tongue * size + self.codes[0]) * size + self.codes[1]
        self.keys = [lead, self.codes[2].astype(np.int64)]

    def sorted_parts(self, least: int):
        return three_way(self.keys, np.arange(len(self.weights)), self.starts, self.lengths, self.weights, least)

    def said(self, word: int, at: np.ndarray) -> pa.Array:
        column = self.codes[word][at]
        return self.names.take(pa.array(column, mask=column == _END))

    def lang(self, at: np.ndarray) -> pa.Array:
        return self.tongues.dictionary.take(pa.array(self.tongue[at]))

    def merged(self) -> pa.Table:
        """The same suffixes, one row each."""
        at, sizes = _gathered([(f, n) for _, f, n, ended in self.sorted_parts(1) if ended])
        return pa.Table.from_batches([_batch(_SUFFIX, self.lang(at), *[self.said(w, at) for w in range(3)], sizes)])

    def counted(self, least: int) -> pa.RecordBatch:
        """Phrases of two and three words and single words (depth 1) that are frequent; under
        depth 0, what these routes' words add to the total of each language."""
        alone = self.codes[1] == self.names.index(pa.scalar(ALONE, self.names.type)).as_py()
        totals = np.zeros(len(self.tongues.dictionary), np.int64)
        np.add.at(totals, self.tongue[alone], self.weights[alone])
        twos, threes = [], []
        for depth, found, sizes, ended in self.sorted_parts(least):
            if depth == 2:
                threes.append((found, sizes))
            elif not ended:
                twos.append((found, sizes))
        (two, two_n), (three, three_n) = _gathered(twos), _gathered(threes)
        at, none = np.concatenate([two, three]), pa.nulls(len(totals), self.names.type)
        depths = np.concatenate([np.where(alone[two], 1, 2), np.full(len(three), 3)])
        third = pa.concat_arrays([pa.nulls(len(two), self.names.type), self.said(2, three)])
        return _batch(
            _COUNT,
            pa.concat_arrays([self.tongues.dictionary, self.lang(at)]),
            np.concatenate([np.zeros(len(totals), np.int64), depths]),
            pa.concat_arrays([none, self.said(0, at)]),
            pa.concat_arrays([none, self.said(1, at)]),
            pa.concat_arrays([none, third]),
            np.concatenate([totals, two_n, three_n]),
        )


def _counts(least: int):
    """Rows come sorted by route."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, bound = [], 0, CHUNK_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < bound:
                continue
            rows = pa.Table.from_batches(held)
            route = rows.column("route").to_numpy()
            cut = int(np.searchsorted(route, route[-1]))
            if cut:
                yield _Routed(rows.slice(0, cut)).counted(least)
            rest = rows.slice(cut)
            if len(rest) > CHUNK_ROWS // 2:  # one route by itself
                rest = _Routed(rest).merged()
                route_of = pa.array(np.full(len(rest), route[-1]))
                rest = pa.Table.from_arrays([*rest.columns, route_of], schema=rows.schema)
            held, size = rest.to_batches(), len(rest)
            bound = max(CHUNK_ROWS, 2 * size)
        if size:
            yield _Routed(pa.Table.from_batches(held)).counted(least)
        del held
        _give_back()

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, depth, w1, w2, w3, n)``: words, pairs and triples of words that occur
    ``least`` times or more in their language, and all words' number (depth 0, in parts)."""
    rows = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    )
    routed = rows.mapInArrow(_suffixes(_frequent_pairs(rows, least)), _SUFFIX).repartition("lang", "w1", "w2")
    routed = routed.withColumn("route", F.xxhash64("lang", "w1", "w2")).sortWithinPartitions("route")
    return routed.mapInArrow(_counts(least), _COUNT)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (l r)); the products may pass 64 bits."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    square = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000)
    return F.call_function("div", square.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases by their
    lowest-scoring cut."""
    counts = materialize(phrase_counts(docs, least), "phrase-counts")
    total = counts.where("depth = 0").groupBy("lang").agg(F.sum("n").alias("total"))
    word = counts.where("depth = 1").select("lang", F.col("w1").alias("w"), F.col("n").alias("f"))
    pair = counts.where("depth = 2").select("lang", "w1", "w2", F.col("n").alias("a"))
    triple = counts.where("depth = 3").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))

    def with_word(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.join(word.select("lang", F.col("w").alias(column), F.col("f").alias(name)), ["lang", column])

    def with_pair(rows: DataFrame, first: str, second: str, name: str) -> DataFrame:
        return rows.join(pair.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name)), ["lang", first, second])

    def cut(left: str, right: str, k: int) -> Column:
        a, le, r = F.col("a"), F.col(left), F.col(right)
        return F.struct(_score(a, le, r).alias("score"), F.lit(k).alias("k"), le.alias("l"), r.alias("r"))

    covering = triple.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    covering = covering.groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    free = pair.join(covering, ["lang", "w1", "w2"], "left").where(
        F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True))
    )
    pairs = with_word(with_word(free, "w1", "f1"), "w2", "f2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut("f1", "f2", 1).alias("cut")
    )
    triples = with_pair(with_pair(with_word(with_word(triple, "w1", "f1"), "w3", "f3"), "w1", "w2", "f12"), "w2", "w3", "f23")
    triples = triples.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.least(cut("f1", "f23", 1), cut("f12", "f3", 2)).alias("cut"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        "a",
        "cut.l",
        "cut.r",
        F.col("total").alias("n"),
        F.col("cut.score").alias("score"),
    )
