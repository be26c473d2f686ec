"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

Texts are weighted sets of five-word shingles: the count of a shingle in the text times
its inverse document frequency, ``1 + log10(1 / share of documents that have it)``, where
shares below ``COMMON`` count as ``COMMON``: what everybody writes weighs half, and a group
of copies does not make its own text light. Document frequencies are counted over all
documents, by hash, in ``PLACES`` places; a shingle's frequency is that of its place, so
the table sent to the workers has one size for any corpus. ``BANDS`` times ``ROWS`` consistent samples are drawn from each text;
two texts of weighted Jaccard similarity s agree on a sample with probability s, and are
candidates if all samples of a band agree: for s = 0.8 with probability 0.9994.

Equal texts are one node. In each bucket of a band all texts are compared with the first
one. What two texts x and y have in common is at most the lesser of what each has in
common with a profile, and what they have in common outside it. The profile of a first
text is itself and what more than ``CROWD`` of its bucket fellows have besides. So texts
that its links leave in different components can only be near duplicates if they share a
shingle outside the profile, which few do, or if their sizes and their parts in the profile
allow it; such pairs, and no others, are compared, too. No candidate pair that could
join two classes is left out, and a group of near copies costs a star of comparisons, not
all pairs. Classes are the components of the verified links, found by alternating
large-star and small-star rounds.

Defined cases: a null text is empty; texts without a word are near duplicates only of
equal texts; a text of fewer than five words is one shingle; a class's id is the least
``doc_id`` of its documents, null only if all are; repeated rows are equal texts and stay,
one row each, and an id that comes with several texts can name several classes; columns
other than ``doc_id``
and ``text`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import text_rows
from textmill.llm.hashing import ODD, mixed, run_hashes, word_hashes
from textmill.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
PLACES = 1 << 18
COMMON = 0.1
#: Bucket fellows that make a shingle part of the profile.
CROWD = 12
#: Sizes are joined by bins of this ratio.
BIN = 1.04
#: Shingles whose samples are drawn in one go.
_CHUNK = 1024

_rng = np.random.default_rng(5)
#: Gamma(2, 1) draws and uniform draws, chosen by bits of a hash.
_GAMMA = (-np.log(_rng.random(1 << 16) * _rng.random(1 << 16))).astype(np.float32)
_LOG_GAMMA = np.log(-np.log(_rng.random(1 << 16)) - np.log(_rng.random(1 << 16))).astype(np.float32)
_UNIFORM = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
_SALTS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_LOW = np.uint64(0xFFFF)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (hashes, sorted) and their counts."""
    words = word_hashes(np.frombuffer(text.encode(), np.uint8))[2]
    return np.unique(run_hashes(words, SHINGLE), return_counts=True)


def places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(math.log2(PLACES)))).astype(np.int64)


def weights(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return counts * idf[places(hashes)]


def samples(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One consistent weighted sample per salt: a hash of the shingle and its level."""
    best = np.full(len(_SALTS), np.inf, np.float32)
    found = np.zeros(len(_SALTS), np.uint64)
    with np.errstate(over="ignore"):
        for begin in range(0, len(hashes), _CHUNK):
            own = hashes[begin : begin + _CHUNK]
            h = mixed(own[:, None] ^ _SALTS)
            r = _GAMMA[h & _LOW]
            beta = _UNIFORM[(h >> np.uint64(16)) & _LOW]
            log_c = _LOG_GAMMA[(h >> np.uint64(32)) & _LOW]
            level = np.floor(np.log(weight[begin : begin + _CHUNK]).astype(np.float32)[:, None] / r + beta)
            log_a = log_c - r * (level - beta + 1)
            at = log_a.argmin(axis=0)
            value = log_a[at, np.arange(len(_SALTS))]
            chosen = mixed(own[at] * ODD + level[at, np.arange(len(_SALTS))].astype(np.int64).astype(np.uint64))
            # Equal values, which differ only in rare ties, go to the lesser hash.
            better = (value < best) | ((value == best) & (chosen < found))
            best, found = np.where(better, value, best), np.where(better, chosen, found)
    return found


def bands(found: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        table = found.reshape(BANDS, ROWS)
        key = np.zeros(BANDS, np.uint64)
        for column in table.T:
            key = mixed(key * ODD + column)
    return key.astype(np.int64)


def similarity(a: str, b: str, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity."""
    (h1, c1), (h2, c2) = shingles(a), shingles(b)
    if not len(h1) or not len(h2):
        return float(len(h1) == len(h2))
    w1, w2 = weights(h1, c1, idf), weights(h2, c2, idf)
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    both = np.minimum(w1[i], w2[j]).sum()
    return float(both / (w1.sum() + w2.sum() - both))


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """Weight of a shingle by its place, from 1 to 1 - log10(COMMON)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(PLACES + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[np.unique(places(shingles(text)[0]))] += 1
                texts += 1
        total[PLACES] = texts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "n"])

    sums = rows.select("text").mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    df = np.zeros(PLACES + 1)
    df[found["place"].to_numpy()] = found["n"].to_numpy()
    return 1 - np.log10(np.maximum(df[:PLACES] / max(df[PLACES], 1), COMMON))


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` of every node of ``edges`` (a, b): the least node of its
    component. Rounds of large stars and small stars, each stored."""
    edges = materialize(edges.where("a != b").select("a", "b").distinct(), name)
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        edges = materialize(small, name)
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if new == mark:
            break
        mark = new
    rooted = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(rooted.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), name)


def compared(a: str, b: str, idf: np.ndarray) -> tuple[float, float, float, np.ndarray, np.ndarray]:
    """Weighted Jaccard similarity, the weight of b, what it has in common with a, and the
    shingles, with weights, of which it has more."""
    (h1, c1), (h2, c2) = shingles(a), shingles(b)
    w1, w2 = weights(h1, c1, idf), weights(h2, c2, idf)
    at = np.minimum(np.searchsorted(h1, h2), max(len(h1) - 1, 0))
    same = h1[at] == h2 if len(h1) else np.zeros(len(h2), bool)
    own = np.where(same, np.minimum(w1[at], w2), 0.0) if len(h1) else np.zeros(len(h2))
    both, more = own.sum(), w2 - own
    total = w1.sum() + w2.sum() - both
    besides = more > 1e-12
    return float(both / total) if total else 1.0, float(w2.sum()), float(both), h2[besides], more[besides]


def _verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, profile: bool = False) -> DataFrame:
    """``pairs`` (a, b) with the similarity of their texts; with what the profile needs of
    b, if asked for."""
    table = pairs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                compared(x, y, table.value)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            sim, size, both, besides, more = list(zip(*found, strict=True)) if found else [()] * 5
            columns = [batch.column(0), batch.column(1), pa.array(sim, pa.float64())]
            if profile:
                columns += [pa.array(size, pa.float64()), pa.array(both, pa.float64())]
                columns.append(pa.array([h.astype(np.int64) for h in besides], pa.list_(pa.int64())))
                columns.append(pa.array(more, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "sim", "size", "both", "besides", "more"][: len(columns)])

    first = texts.select(F.col("digest").alias("a"), F.col("text").alias("x"))
    second = texts.select(F.col("digest").alias("b"), F.col("text").alias("y"))
    met = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    shape = "a binary, b binary, sim double"
    return met.mapInArrow(
        run, shape + ", size double, both double, besides array<bigint>, more array<double>" * profile
    )


def _still_possible(checked: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """``(a, b)``: pairs of texts with one first text (``a`` of ``checked``) that are in
    different components and can be near duplicates, by the bound of the profile."""
    root = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    rows = checked.join(root("a"), "a", "left").join(root("b"), "b", "left").select(
        F.col("a").alias("lead"), F.col("b").alias("node"), "size", "both", "besides", "more",
        F.coalesce("root_a", "a").alias("home"), F.coalesce("root_b", "b").alias("root"),
    )
    open_ = rows.where("root != home").select("lead").distinct()
    rows = materialize(rows.join(open_, "lead", "left_semi"), "neardup-open")
    besides = rows.select("lead", "node", "home", "root", F.inline(F.arrays_zip("besides", "more")))
    crowd = besides.groupBy("lead", "besides").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    crowd = materialize(crowd.select("lead", "besides"), "neardup-crowd")
    in_crowd = (
        besides.join(crowd, ["lead", "besides"]).groupBy("lead", "node").agg(F.sum("more").alias("added"))
    )
    rare = besides.join(crowd, ["lead", "besides"], "left_anti").select("lead", "besides", "node", "home", "root")
    key = lambda df, n: df.withColumnsRenamed({c: f"{c}_{n}" for c in df.columns if c not in ("lead", "besides", "bin")})
    wanted = (F.col("root_x") != F.col("root_y")) & (
        (F.col("root_y") == F.col("home_y")) | (F.col("node_x") < F.col("node_y"))
    )
    pair = [F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")]
    sharing = key(rare.where("root != home"), "x").join(key(rare, "y"), ["lead", "besides"]).where(wanted).select(*pair)

    # Common weight c allows a similarity of ``least`` up to a sum of sizes of c * factor.
    factor, step = (1 + least) / least, F.log(F.lit(BIN))
    sized = (
        rows.join(in_crowd, ["lead", "node"], "left")
        .withColumn("room", (F.col("both") + F.coalesce("added", F.lit(0.0))) * factor - F.col("size") + 1e-9)
        .select("lead", "node", "home", "root", "size", "room")
        .where("size > 0")
    )
    bin_of = lambda c: F.floor(F.log(c) / step).cast("int")
    low, high = F.col("size") * least, F.least(F.col("size") / least, "room")
    asking = sized.where("root != home").where(low <= high).withColumn("bin", F.explode(F.sequence(bin_of(low) - 1, bin_of(high) + 1)))
    offered = sized.withColumn("bin", bin_of(F.col("size")))
    fitting = (
        key(asking, "x")
        .join(key(offered, "y"), ["lead", "bin"])
        .where(wanted & (F.col("size_y") <= F.col("room_x")) & (F.col("size_x") <= F.col("room_y")))
        .select(*pair)
    )
    return sharing.unionByName(fitting).distinct()


def _digest(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """``(digest, doc_id, class_id, class_digest)`` of each row."""
    rows = text_rows(docs)
    idf = inverse_frequencies(rows)
    table = rows.sparkSession.sparkContext.broadcast(idf)
    keyed = rows.select("doc_id", "text", _digest(F.col("text")).alias("digest"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column(1).to_pylist():
                hashes, counts = shingles(text)
                keys.append(bands(samples(hashes, weights(hashes, counts, table.value))) if len(hashes) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "digest", "keys"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = materialize(keyed.mapInArrow(sign, f"doc_id {kind}, digest binary, keys array<bigint>"), "neardup-bands")
    nodes = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("keys").alias("keys"))
    entries = nodes.select("digest", "rep", F.posexplode("keys").alias("band", "key"))
    # Buckets of several texts, each with its first text.
    first = (
        entries.groupBy("band", "key")
        .agg(F.min(F.struct("rep", "digest")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("band", "key", F.col("first.digest").alias("lead"))
    )
    members = materialize(entries.join(first, ["band", "key"]).select("band", "key", "lead", "digest"), "neardup-buckets")
    stars = members.where("lead != digest").select(F.col("lead").alias("a"), F.col("digest").alias("b")).distinct()
    stars = materialize(stars, "neardup-stars")
    wanted = stars.select(F.col("a").alias("digest")).unionByName(stars.select(F.col("b").alias("digest"))).distinct()
    # One row stands for all copies of a text, so the join deals copies by their ids.
    chosen = nodes.join(wanted, "digest").select(F.col("digest").alias("of"), "rep")
    met = (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    texts = keyed.join(chosen, met, "left_semi").groupBy("digest").agg(F.any_value("text").alias("text"))
    texts = materialize(texts, "neardup-texts")
    checked = materialize(_verified(stars, texts, idf, profile=True), "neardup-checked")
    links = checked.where(F.col("sim") >= least).select("a", "b")
    roots = components(links, "neardup-components")
    pairs = materialize(_still_possible(checked, roots, least), "neardup-pairs")
    more = materialize(_verified(pairs, texts, idf).where(F.col("sim") >= least).select("a", "b"), "neardup-more")
    if more.limit(1).count():
        roots = components(links.unionByName(more), "neardup-components")
    classes = (
        signed.groupBy("digest")
        .agg(F.min("doc_id").alias("rep"))
        .join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        .select("digest", "rep", F.coalesce("root", "digest").alias("root"))
    )
    # The document of the least id, null last, stands for its class.
    least_one = F.struct(F.col("rep").isNull().alias("none"), "rep", "digest")
    named = classes.groupBy("root").agg(F.min(least_one).alias("one"))
    own = classes.join(named, "root").select("digest", F.col("one.rep").alias("class_id"), F.col("one.digest").alias("class_digest"))
    return signed.select("doc_id", "digest").join(own, "digest")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, class_id)`` of each row."""
    return _classes(docs, least).select("doc_id", "class_id")


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows that stay: of each class the document of the least id, once."""
    stay = (
        _classes(docs, least)
        .where((F.col("digest") == F.col("class_digest")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
        .select(F.col("doc_id").alias("id"), F.col("digest").alias("of"))
        .distinct()
    )
    moved = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # by place, so columns may have any names
    doc_id, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    rows = moved.withColumn("digest", _digest(F.coalesce(text, F.lit(""))))
    met = (F.col("digest") == F.col("of")) & F.col(doc_id).eqNullSafe(F.col("id"))
    kept = rows.join(stay, met, "left_semi").dropDuplicates([doc_id, "digest"])
    return kept.select(*moved.columns).toDF(*docs.columns)
