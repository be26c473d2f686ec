"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed by doubling (a rolling polynomial hash: each
length's hashes are made from those of half the length). In every window of ``w``
consecutive hashes the least is chosen, the rightmost of equal ones. Chosen hashes and
their positions are the fingerprint. Two texts that share ``w + k - 1`` code points in a
row share a chosen hash there, at the matching place; matches under ``k`` are not seen.

Documents follow each other by id. Ids are dealt into ranges by quantiles (one id per
range goes to the driver), an id with many rows into several; texts are shuffled once, and
every range gets a copy of the text that follows its last one, so neighbours meet in one
pass over sorted rows.

Defined cases: a null text is empty; a text of fewer than ``k`` code points is hashed as
a whole, an empty one has no hash; two empty fingerprints are alike (1), an empty and
another are not (0); rows of equal id follow each other by a hash of the text, then by text;
null ids come first; ids are whole numbers;
a table of one row is its own next; columns other than ``doc_id`` and ``text`` are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import text_rows
from textmill.llm.hashing import window_least

#: Code points of a gram, a power of two, and grams of a window: matches of 100 are kept.
GRAM = 16
WINDOW = 85
#: Low bits of a packed hash that hold the place, so blocks have fewer grams than this.
_PLACE = 20
_BLOCK = 1 << (_PLACE - 1)
_MASK = np.uint64((1 << _PLACE) - 1)
_ODD = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * i & 0xFFFFFFFFFFFFFFFF | 1) for i in range(8)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(points: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Hashes of all runs of ``k`` points; of all points at once if there are fewer."""
    h = _mixed(points.astype(np.uint64) + np.uint64(1))
    if len(h) < k:
        whole = np.uint64(len(h))
        for x in h.tolist():
            whole = _mixed(np.array([whole * _ODD[0] + np.uint64(x)]))[0]
        return np.array([whole] * bool(len(h)), np.uint64)
    size, step = 1, 0
    while size < k:
        h = h[:-size] * _ODD[step] + h[size:]
        size, step = size * 2, step + 1
    return _mixed(h)


def winnow(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes (44 bits) and their positions, by position."""
    with np.errstate(over="ignore"):
        grams = gram_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), k)
    n = len(grams)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    places = []
    for begin in range(0, max(1, n - w + 1), _BLOCK - w):
        part = grams[begin : begin + _BLOCK]
        place = np.arange(len(part), dtype=np.uint64)
        # Of equal hashes the one further right is the lesser number.
        packed = (part & ~_MASK) | (_MASK - place)
        least = window_least(packed, w)
        least = least[np.r_[True, least[1:] != least[:-1]]]
        places.append((_MASK - (least & _MASK)).astype(np.int64) + begin)
    at = np.unique(np.concatenate(places)) if len(places) > 1 else places[0]
    return grams[at] >> np.uint64(_PLACE), at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(hashes: np.ndarray) -> str:
    """Chosen hashes in order, eleven hexadecimal digits (all 44 bits) each."""
    digits = np.frombuffer((hashes << np.uint64(20)).astype(">u8").tobytes().hex().encode(), "S1").reshape(-1, 16)
    return digits[:, :11].tobytes().decode()


def places_digest(at: np.ndarray) -> str:
    """SHA-256 of the positions as little-endian unsigned 64-bit integers."""
    return hashlib.sha256(at.astype("<u8").tobytes()).hexdigest()


def fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """``(doc_id, hashes, positions)`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(text, k, w) for text in batch.column(1).to_pylist()]
            hashes = pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64()))
            places = pa.array([p for _, p in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes, places], ["doc_id", "hashes", "positions"])

    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, hashes array<bigint>, positions array<bigint>")


def followed(docs: DataFrame) -> DataFrame:
    """``(part, last, doc_id, text)``: each range sorted by ``last``, id, hash of the text and
    text, closed by one row with ``last`` true, the text after the range's own. An id that
    holds more rows than a range is dealt into ranges of text hashes."""
    rows = text_rows(docs)
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)]
    id_type = rows.schema["doc_id"].dataType
    # Null ids come first; the place before all others is theirs.
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    keyed = rows.select(key.alias("key"), F.shiftrightunsigned(F.xxhash64("text"), 33).alias("mark"), "doc_id", "text")
    found = keyed.select(F.percentile_approx("key", cuts, 100 * parts).alias("b")).first().b if cuts else None
    # A bound met several times is an id of about so many ranges.
    bounds = sorted(Counter(found or []).items())
    first_part = list(accumulate([n for _, n in bounds], initial=0))

    def tree(low: int, high: int):
        """Part of a row, its first bound that is not below the id found by halving."""
        if low == high:
            if low == len(bounds):
                return F.lit(first_part[low])
            bound, n = bounds[low]
            if n == 1:
                return F.lit(first_part[low])
            own = first_part[low] + F.floor(F.col("mark") * n / F.lit(1 << 31))
            return F.when(F.col("key") == bound, own).otherwise(F.lit(first_part[low]))
        mid = (low + high) // 2
        return F.when(F.col("key") <= bounds[mid][0], tree(low, mid)).otherwise(tree(mid + 1, high))

    rows = keyed.select(tree(0, len(bounds)).cast("int").alias("part"), F.lit(False).alias("last"), "key", "mark", "doc_id", "text")
    # Of each range the first id and hash, and the least text that has them; then each range
    # gets the first row of the next range that has rows, the last one that of the first.
    firsts = rows.groupBy("part").agg(F.min(F.struct("key", "mark")).alias("least"))
    order = Window.orderBy("part")
    follows = firsts.select(
        F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy(F.lit(0)))).alias("part"),
        F.col("least.key").alias("key"),
        F.col("least.mark").alias("mark"),
    )
    closing = (
        rows.drop("part")
        .join(F.broadcast(follows), ["key", "mark"])
        .groupBy("part")
        .agg(F.min("text").alias("text"))
        .select(
            "part", F.lit(True).alias("last"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("mark"),
            F.lit(None).cast(id_type).alias("doc_id"), "text",
        )
    )
    return (
        rows.unionByName(closing)
        .repartitionById(first_part[-1] + 1, F.col("part"))
        .sortWithinPartitions("part", "last", "key", "mark", "text")
        .select("part", "last", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by the first as many code points of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_report(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per document: fingerprints of the text and of its edited text, and how
    alike the text's is to that and to the next document's. Positions are kept as a digest;
    ``fingerprints`` has them."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "positions_sha256", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), *[pa.string()] * 4, pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next text: id, text, hashes, places, sorted hashes
        for batch in batches:
            ids, out = [], []
            for last, doc_id, text in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                hashes, at = winnow(text, k, w)
                distinct = np.unique(hashes)
                if held:
                    own_id, own, own_hashes, own_at, own_distinct = held
                    new = edited(own, text)
                    new_hashes = winnow(new, k, w)[0]
                    ids.append(own_id)
                    out.append(
                        (
                            len(own),
                            hashlib.sha256(new.encode()).hexdigest(),
                            written(own_hashes),
                            places_digest(own_at),
                            written(new_hashes),
                            likeness(own_distinct, np.unique(new_hashes)),
                            likeness(own_distinct, distinct),
                        )
                    )
                held = None if last else (doc_id, text, hashes, at, distinct)
            columns = list(zip(*out, strict=True)) if out else [[] for _ in kinds]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(2).type), *arrays], names)

    rows = followed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, positions_sha256 string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
