"""Removal of repeated 200-byte strings by blockwise suffix sorting with a difference cover.

A byte goes if some ``LENGTH``-byte string covers it that also starts anywhere else, in
the same text or another. Strings are the suffixes of the texts, looked at to that depth.

1. *Buckets.* Every string of ``LENGTH`` bytes contains ``WINDOW`` runs of ``GRAM`` bytes.
   The run of least hash, the leftmost of equal ones, is its anchor, so equal strings
   have equal anchors at equal places, and the anchor names the string's bucket.
   Neighbouring strings with one anchor make a group; there is about one group in
   seventy bytes. Strings whose anchor occurs once are alone in their bucket and done.
2. *Copies.* Groups that are equal to the last byte (128 bits of hashes) are repeated as a
   whole. One of them stands for all from here on.
3. *Sorting.* Where a bucket holds different groups, their bytes (at most ``LENGTH`` +
   ``WINDOW``) are fetched, and the bucket's suffixes are sorted. Buckets are sorted in
   blocks of bounded size, and inside a block one leading byte at a time: first by
   ``PERIOD`` bytes; longer ties are resolved by ranks of a difference cover sample,
   computed once for the block: for any two positions there is a shift below ``PERIOD``
   that brings both into the sample, so one look at two ranks decides. Neighbours in the
   order are compared over ``LENGTH`` bytes, and equal ones are repeated.
   A bucket of more than ``HOT`` different groups is not sorted in one task: each of its
   strings becomes a row, and rows are counted by 128 bits of hash, with map-side combine.
4. *Removal.* Starts of repeated strings go back to their texts.

Everything is linear in the input: no pairs are made. Shuffled are groups (some 50 bytes
for 70 of text), and texts, compressed, twice.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` keeps all bytes; two
rows of equal text are two texts, and repeat each other; rows that repeat an id, or have
none, are told apart by 128 bits of a digest of their text; columns other than ``doc_id`` and ``text`` are ignored; an empty
table gives an empty result. What is left need not be valid UTF-8 and is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import text_rows
from textmill.llm.hashing import ODD, mixed, window_least
from textmill.session import materialize

LENGTH, GRAM = 200, 64
WINDOW = LENGTH - GRAM + 1
#: Bytes compared before ranks of the cover decide.
PERIOD = 64
#: Bytes of text sorted at a time.
BLOCK = 1 << 20
#: Different groups of a bucket that are sorted in one task.
HOT = 2048

_PLACE = 20
_WINDOWS = 1 << (_PLACE - 1)
_MASK = np.uint64((1 << _PLACE) - 1)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
_SALT = np.uint64(0xD1B54A32D192ED03)


@lru_cache(maxsize=2)
def difference_cover(period: int = PERIOD) -> tuple[tuple[int, ...], np.ndarray]:
    """Residues whose differences are all residues, chosen greedily, and for each two
    residues the shift that brings both into the cover."""
    cover, open_ = [0], set(range(1, period))
    while open_:

        def gain(c: int) -> int:
            return len(open_ & {d for x in cover for d in ((c - x) % period, (x - c) % period)})

        best = max((c for c in range(period) if c not in cover), key=lambda c: (gain(c), -c))
        open_ -= {d for x in cover for d in ((best - x) % period, (x - best) % period)}
        cover.append(best)
    inside = set(cover)
    shift = np.array(
        [[next(k for k in range(period) if {(i + k) % period, (j + k) % period} <= inside) for j in range(period)] for i in range(period)]
    )
    return tuple(sorted(cover)), shift


def sorted_repeats(text: bytes, starts: list[int], length: int = LENGTH, period: int = PERIOD) -> list[int]:
    """Those of ``starts`` whose ``length`` bytes also start at another of them."""
    cover, shift = difference_cover(period)
    sample = [p for base in range(0, len(text), period) for c in cover if (p := base + c) < len(text)]
    slices = {p: text[p : p + length] for p in sample}
    rank, last, n = {}, None, -1
    for p in sorted(sample, key=slices.__getitem__):
        if slices[p] != last:
            last, n = slices[p], n + 1
        rank[p] = n
    del slices
    shifts = shift.tolist()

    def by_rank(i: int, j: int) -> int:
        k = shifts[i % period][j % period]
        # Past the end of the text there is nothing, which sorts first.
        return rank.get(i + k, -1) - rank.get(j + k, -1)

    buckets: dict[int, list[int]] = {}
    for i in starts:
        buckets.setdefault(text[i], []).append(i)
    found = []
    for first in sorted(buckets):
        keyed = sorted((text[i : i + period], i) for i in buckets[first])
        order, tie = [], []
        for n, (key, i) in enumerate(keyed):
            tie.append(i)
            if n + 1 == len(keyed) or keyed[n + 1][0] != key:
                order += sorted(tie, key=cmp_to_key(by_rank)) if len(tie) > 1 else tie
                tie = []
        strings = [text[i : i + length] for i in order]
        same = [a == b for a, b in zip(strings, strings[1:], strict=False)]
        found += [i for i, a, b in zip(order, [False, *same], [*same, False], strict=True) if a or b]
    return found


def text_groups(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups of the strings of a text: first start, number of starts, anchor hash, hash
    of all their bytes."""
    columns = []
    with np.errstate(over="ignore"):
        for begin in range(0, len(data) - LENGTH + 1, _WINDOWS - LENGTH):
            part = data[begin : begin + _WINDOWS]
            if len(part) < LENGTH:
                break
            h, size, half = _BYTES[part], 1, None
            while size < 2 * GRAM:
                h = mixed(h[:-size] * ODD + h[size:])
                size *= 2
                half = h if size == GRAM else half
            # ``half`` hashes runs of GRAM bytes, ``h`` runs of twice as many.
            packed = (half & ~_MASK) | np.arange(len(half), dtype=np.uint64)
            least = window_least(packed, WINDOW)
            # The next block begins where this one's last strings end.
            ends = begin + len(part) == len(data)
            limit = len(part) - LENGTH + 1 if ends else _WINDOWS - LENGTH
            anchors = (least[:limit] & _MASK).astype(np.int64)
            first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
            last = np.r_[first[1:], len(anchors)] - 1
            span = h[first]
            for at in (first + LENGTH - 2 * GRAM, last, last + LENGTH - 2 * GRAM):
                span = mixed(span * ODD + h[at])
            anchor = mixed(half[anchors[first]] ^ _SALT)
            columns.append((first + begin, last - first + 1, anchor, mixed(span + (last - first).astype(np.uint64))))
            if ends:
                break
    if not columns:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*columns, strict=True))


def _merged(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts, adjacent ones joined; ``first`` ascends."""
    if not len(first):
        return first, n
    new = np.r_[True, first[1:] > first[:-1] + n[:-1]]
    at = np.flatnonzero(new)
    ends = (first + n)[np.r_[at[1:] - 1, len(first) - 1]]
    return first[at], ends - first[at]


def _groups(rows: DataFrame) -> DataFrame:
    """Of each text one row per different group, with the number of its places, and runs
    of starts that the text alone shows to be repeated (``anchor`` null)."""
    names = ["doc_id", "mark", "anchor", "span", "first", "n", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, index = [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                data = np.frombuffer(text.encode(), np.uint8)
                if len(data) < LENGTH:
                    continue
                first, n, anchor, span = text_groups(data)
                order = np.lexsort((first, span, anchor))
                a, s = anchor[order], span[order]
                at = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])])
                places = np.diff(np.r_[at, len(order)])
                one = order[at]
                out.append((anchor[one].astype(np.int64), span[one].astype(np.int64), first[one], n[one], places, np.zeros(len(one), bool)))
                index.append(np.full(len(one), row))
                again = np.sort(order[np.repeat(places > 1, places)])
                runs, lengths = _merged(first[again], n[again])
                none = np.zeros(len(runs), np.int64)
                out.append((none, none, runs, lengths, none, np.ones(len(runs), bool)))
                index.append(np.full(len(runs), row))
            if not out:
                continue
            anchor, span, first, n, places, own = (np.concatenate(c) for c in zip(*out, strict=True))
            at = pa.array(np.concatenate(index))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(anchor, mask=own),
                    pa.array(span, mask=own),
                    pa.array(first.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(places.astype(np.int32)),
                ],
                names,
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "mark", "text").mapInArrow(
        run, f"doc_id {kind}, mark binary, anchor bigint, span bigint, first int, n int, places int"
    )


def _packed(rows: DataFrame) -> DataFrame:
    """Texts as compressed UTF-8, for a smaller shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [press.compress(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "mark", "packed"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "mark", "text").mapInArrow(run, f"doc_id {kind}, mark binary, packed binary")


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _met(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on id and mark, where null ids meet, too."""
    right = right.withColumnsRenamed({"doc_id": "__id", "mark": "__mark"})
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    return left.join(right, on, how).drop("__id", "__mark")


def _fetched(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """``asked`` (doc_id, mark, anchor, span, first, n, single, hot) with the bytes of each
    group's strings."""
    lists = asked.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("anchor", "span", "first", "n", "single", "hot")).alias("asked")
    )
    met = _met(_packed(rows), lists).dropDuplicates(["doc_id", "mark"]).select("doc_id", "mark", "packed", "asked")
    fields = ["anchor", "span", "first", "n", "single", "hot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, columns, pieces = [], {f: [] for f in fields}, []
            for row, (packed, groups) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                text = _unpacked(packed)
                for group in groups:
                    index.append(row)
                    for f in fields:
                        columns[f].append(group[f])
                    pieces.append(text[group["first"] : group["first"] + group["n"] - 1 + LENGTH])
            at = pa.array(index, pa.int32())
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(columns[f], k) for f, k in zip(fields, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *arrays, pa.array(pieces, pa.binary())],
                ["doc_id", "mark", *fields, "piece"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, mark binary, anchor bigint, span bigint, first int, n int, single boolean, hot boolean"
    return met.mapInArrow(run, f"{shape}, piece binary")


def _sorted_buckets(pieces: DataFrame) -> DataFrame:
    """Runs (doc_id, mark, first, n) of repeated starts of groups that stand alone, from
    buckets sorted block by block."""
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, shape = [], 0, None, None

        def flush() -> pa.RecordBatch:
            offsets, starts, at = [], [], 0
            for *_, n, _, piece in held:
                offsets.append(at)
                starts += range(at, at + n)
                at += len(piece)
            found = np.sort(np.array(sorted_repeats(b"".join(h[-1] for h in held), starts), np.int64))
            owner = np.searchsorted(np.array(offsets), found, "right") - 1
            ids, marks, firsts, lengths = [], [], [], []
            for o in np.unique(owner):
                doc_id, mark, first, _, single, _ = held[o]
                if not single:
                    continue
                own = found[np.searchsorted(owner, o) : np.searchsorted(owner, o, "right")] - offsets[o] + first
                for f, n in zip(*_merged(own, np.ones(len(own), np.int64)), strict=True):
                    ids.append(doc_id)
                    marks.append(mark)
                    firsts.append(int(f))
                    lengths.append(int(n))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, shape), pa.array(marks, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lengths, pa.int32())],
                ["doc_id", "mark", "first", "n"],
            )

        for batch in batches:
            shape = batch.column(0).type
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                anchor, *rest = row
                if size > BLOCK and anchor != last:
                    yield flush()
                    held, size = [], 0
                held.append(tuple(rest))
                size += len(rest[-1])
                last = anchor
        if held:
            yield flush()

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.select("anchor", "doc_id", "mark", "first", "n", "single", "piece")
    return (
        dealt.repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(run, f"doc_id {kind}, mark binary, first int, n int")
    )


def _counted_strings(pieces: DataFrame) -> DataFrame:
    """Runs of repeated starts of groups that stand alone, from buckets too large for one
    task: every string is a row."""
    strings = pieces.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "doc_id", "mark", (F.col("first") + F.col("i")).alias("first"), "single", F.unhex(F.md5(F.substr("piece", F.col("i") + 1, F.lit(LENGTH)))).alias("key")
    )
    strings = materialize(strings, "suffix-strings")
    again = strings.groupBy("key").agg(F.count(F.lit(1)).alias("n_key")).where("n_key > 1").select("key")
    return strings.where("single").join(again, "key", "left_semi").select("doc_id", "mark", "first", F.lit(1).alias("n"))


def repeated_starts(rows: DataFrame) -> DataFrame:
    """``(doc_id, mark, runs)``: runs (first, n) of the starts of repeated strings."""
    groups = materialize(_groups(rows), "suffix-groups")
    named = groups.where("anchor is not null")
    shared = named.groupBy("anchor").agg(F.sum("places").alias("total")).where("total > 1").select("anchor")
    met = materialize(named.join(shared, "anchor", "left_semi"), "suffix-shared")
    different = met.groupBy("anchor", "span").agg(
        F.sum("places").alias("copies"), F.min(F.struct("doc_id", "mark", "first", "n")).alias("one")
    )
    different = materialize(different, "suffix-different")
    whole = met.join(different.where("copies > 1").select("anchor", "span"), ["anchor", "span"], "left_semi")
    buckets = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    asked = different.join(buckets, "anchor").select(
        "one.doc_id", "one.mark", "anchor", "span", "one.first", "one.n", (F.col("copies") == 1).alias("single"), (F.col("kinds") > HOT).alias("hot")
    )
    pieces = materialize(_fetched(asked, rows), "suffix-pieces")
    runs = (
        groups.where("anchor is null")
        .select("doc_id", "mark", "first", "n")
        .unionByName(whole.select("doc_id", "mark", "first", "n"))
        .unionByName(_sorted_buckets(pieces.where("not hot")))
        .unionByName(_counted_strings(pieces.where("hot")))
    )
    return runs.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "n")).alias("runs"))


def deduplicated(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` and, if asked for, ``kept``,
    the bytes that stay."""
    rows = text_rows(docs).withColumn("mark", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    met = _met(_packed(rows), repeated_starts(rows), "left").select("doc_id", "packed", "runs")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = _unpacked(packed)
                change = np.zeros(len(text) + 1, np.int32)
                for r in runs or ():
                    change[r["first"]] += 1
                    change[r["first"] + r["n"] - 1 + LENGTH] -= 1
                gone = np.cumsum(change[:-1]) > 0
                edges = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((len(text), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays][: len(names)], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return met.mapInArrow(run, shape + ", kept binary" * keep_bytes)
