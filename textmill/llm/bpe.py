"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of parts. Each merge rank has a bucket of positions whose
part and right neighbour make the token of that rank. Three levels of 64-bit words mark
the ranks with a non-empty bucket; find-first-set on each level gives the lowest rank.
Entries go stale when a part is merged away or its neighbour changes, and are skipped
when met. The work is near linear in the length of a pre-token, so a text that is one
pre-token of a megabyte is no special case.

The work is row-local: one pass over the texts, no shuffle. A worker keeps the encodings
of pre-tokens it has met; a miss only costs time. Texts are taken in groups of ``GROUP``
characters, and the pre-tokens a group is the first to hold share one list and one queue: the
lowest rank of all comes first, and its bucket merges one position of every pre-token at once,
so each pre-token sees its own merges in its own order. Over ``CACHE`` entries, those that the
last group did not use are let go.

Defined cases: a null text is encoded as the empty text, to no ids and the digest of
nothing; repeated rows give equal rows; columns other than ``doc_id`` and ``text`` are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import vocabulary
from textmill.llm.common import text_rows

#: Pre-tokens whose encoding a worker keeps, and the most characters of one kept.
CACHE = 400_000
CACHED_CHARS = 64
#: Characters of texts whose new pre-tokens are merged together.
GROUP = 8_000_000
#: Buckets of fewer positions are worked off one by one.
FEW = 12


class RankQueue:
    """Ranks below 64 ** 3 that wait, each with a bucket (a heap) of positions. ``low``,
    ``mid`` and ``top`` have a bit per rank, per 64 and per 4,096 ranks with a bucket."""

    def __init__(self) -> None:
        self.low = [0] * 4096
        self.mid = [0] * 64
        self.top = 0
        self.buckets: dict[int, list[int]] = {}


class Encoder(dict):
    """Pre-token to its ids as little-endian 32-bit integers; fills itself."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.queue = RankQueue()
        # All tokens' bytes in one table, in order of ranks.
        self.lengths = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        # The rank of two neighbouring tokens, by ``left * base + right``, in order of keys.
        # The rank ``base - 1`` is none: it stands between two pre-tokens.
        self.base = len(self.lengths) + 1
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.base + right] = rank
        self.pairs = found
        self.pair_keys = np.array([*sorted(found), np.iinfo(np.int64).max], np.int64)
        self.pair_ranks = np.array([*(found[key] for key in sorted(found)), -1], np.int32)
        self.byte_ranks = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.merge(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece. What the queue does is written out here, as most pieces are short
        and calls would be most of the work. It is empty between two pieces."""
        ranks, low, mid, buckets = self.ranks, self.queue.low, self.queue.mid, self.queue.buckets
        if piece in ranks:
            return [ranks[piece]]
        rank_of, top = ranks.get, self.queue.top
        n = len(piece)
        # The part at position i is piece[i:after[i]]; pair[i] is the rank of the token
        # it makes with its right neighbour, or -1.
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # rising positions are a heap
                else:
                    buckets[rank] = [i]
                    low[rank >> 6] |= 1 << (rank & 63)
                    mid[rank >> 12] |= 1 << (rank >> 6 & 63)
                    top |= 1 << (rank >> 12)
        while top:
            a = (top & -top).bit_length() - 1
            word = mid[a]
            b = a << 6 | (word & -word).bit_length() - 1
            word = low[b]
            rank = b << 6 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[b] = word & (word - 1)
                if not low[b]:
                    mid[a] &= mid[a] - 1
                    if not mid[a]:
                        top &= top - 1
            if pair[i] != rank:
                continue  # stale: one of its parts was merged since
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = -1
            left = before[i]
            if end < n:
                before[end] = i
                pair[i] = rank_of(piece[i : after[end]], -1)
            else:
                pair[i] = -1
            if left >= 0:
                pair[left] = rank_of(piece[left:end], -1)
            for at in (i, left):
                if at < 0 or (rank := pair[at]) < 0:
                    continue
                if rank in buckets:
                    heappush(buckets[rank], at)
                else:
                    buckets[rank] = [at]
                    low[rank >> 6] |= 1 << (rank & 63)
                    mid[rank >> 12] |= 1 << (rank >> 6 & 63)
                    top |= 1 << (rank >> 12)
        self.queue.top = top
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers. The same merges as
        ``merge``'s in one queue: of a bucket, the first position of every piece is merged,
        the others wait until nothing of a lower rank has come up."""
        low, mid, buckets, top = self.queue.low, self.queue.mid, self.queue.buckets, 0
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(1, len(pieces) + 1, dtype=np.int32), sizes + 1)
        owner = np.concatenate([np.zeros(1, np.int32), owner])  # place 0 and one after each piece are borders
        total, border = len(owner), self.base - 1
        token = np.full(total, border, np.int32)
        places = np.arange(total - len(pieces) - 1)
        token[places + np.repeat(np.arange(1, len(pieces) + 1), sizes)] = self.byte_ranks[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = (np.arange(total, dtype=np.int32) + step for step in (1, -1))
        pair = np.append(self._ranks_of(token[:-1], token[1:]), -1).astype(np.int32)
        # One by one through views, which give plain numbers.
        token_at, after_at, before_at, pair_at = (memoryview(a) for a in (token, after, before, pair))

        def push(rank: int, positions: array) -> None:
            nonlocal top
            if rank in buckets:
                buckets[rank].extend(positions)
            else:
                buckets[rank] = positions
                low[rank >> 6] |= 1 << (rank & 63)
                mid[rank >> 12] |= 1 << (rank >> 6 & 63)
                top |= 1 << (rank >> 12)

        start = np.flatnonzero(pair >= 0)
        start = start[np.argsort(pair[start], kind="stable")].astype(np.int32)
        cuts = np.flatnonzero(np.diff(pair[start], prepend=-1)).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(start)]):
            push(pair_at[start[lo]], array("i", start[lo:hi].tobytes()))
        base, rank_of = self.base, self.pairs.get
        while top:
            a = (top & -top).bit_length() - 1
            word = mid[a]
            b = a << 6 | (word & -word).bit_length() - 1
            word = low[b]
            rank = b << 6 | (word & -word).bit_length() - 1
            bucket = buckets.pop(rank)
            low[b] = word & (word - 1)
            if not low[b]:
                mid[a] &= mid[a] - 1
                if not mid[a]:
                    top &= top - 1
            if len(bucket) < FEW:
                waiting = sorted(bucket)
                for done, i in enumerate(waiting, 1):
                    if pair_at[i] != rank:
                        continue  # stale: one of its parts was merged since
                    gone = after_at[i]
                    end, left = after_at[gone], before_at[i]
                    after_at[i], before_at[end] = end, i
                    pair_at[gone] = token_at[gone] = -1
                    token_at[i] = rank
                    made = pair_at[i] = rank_of(rank * base + token_at[end], -1)
                    lower = 0 <= made < rank
                    if made >= 0:
                        push(made, array("i", (i,)))
                    made = pair_at[left] = rank_of(token_at[left] * base + rank, -1)
                    if made >= 0:
                        push(made, array("i", (left,)))
                        lower = lower or made < rank
                    if lower and done < len(waiting):
                        push(rank, array("i", waiting[done:]))
                        break
                continue
            i = np.sort(np.frombuffer(bucket, np.int32))
            i = i[pair[i] == rank]
            first = np.diff(owner[i], prepend=-1) != 0
            if not first.all():
                push(rank, array("i", i[~first].tobytes()))
                i = i[first]
            gone = after[i]
            end, left = after[gone], before[i]
            after[i], before[end] = end, i
            pair[gone] = token[gone] = -1
            token[i] = rank
            at = np.concatenate([i, left])
            made = self._ranks_of(token[at], token[np.concatenate([end, i])])
            pair[at] = made
            kept = made >= 0
            for made, at in zip(made[kept].tolist(), at[kept].tolist()):
                if made in buckets:
                    buckets[made].append(at)
                else:
                    push(made, array("i", (at,)))
        ids = (token >= 0) & (token != border)
        ends = np.cumsum(np.bincount(owner[ids], minlength=len(pieces) + 1)).tolist()
        ids = token[ids].astype("<u4").tobytes()
        return [ids[4 * lo : 4 * hi] for lo, hi in zip(ends, ends[1:])]

    def learn(self, pieces: Iterable[str]) -> None:
        """Keep the encodings of pieces; long ones are left to ``__missing__``, and all if the
        vocabulary lacks a byte."""
        if (self.byte_ranks < 0).any():
            return
        new = [piece for piece in pieces if piece not in self and len(piece) <= CACHED_CHARS]
        merged = []
        for piece in new:
            rank = self.ranks.get(piece.encode())
            if rank is None:
                merged.append(piece)
            else:
                self[piece] = rank.to_bytes(4, "little")
        if merged:
            self.update(zip(merged, self.merge_all([piece.encode() for piece in merged])))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, vocabulary.pre_tokens(text)))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of each text, in groups."""
        start = 0
        while start < len(texts):
            stop, chars, met, group = start, 0, {}, []
            while stop < len(texts) and (chars + len(texts[stop]) <= GROUP or stop == start):
                text = texts[stop]
                stop, chars = stop + 1, chars + len(text)
                if len(text) > vocabulary.LONG:
                    group.append(None)
                    continue
                pieces = vocabulary.pre_tokens(text)
                group.append(list(map(met.setdefault, pieces, pieces)))  # equal pieces are held once
            self.learn(met)
            for text, pieces in zip(texts[start:stop], group):
                yield self.encode(text) if pieces is None else b"".join(map(self.__getitem__, pieces))
            if len(self) > CACHE:
                used = {piece: self[piece] for piece in met if piece in self}
                self.clear()
                self.update(used)
            start = stop

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        size = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.arange(size) + np.repeat(self.offsets[tokens] + lengths - ends, lengths)].tobytes()


_encoders: dict[int, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary.ranks(content))
    return _encoders[key]


def encode(docs: DataFrame, path: str = vocabulary.BYTE_BPE) -> DataFrame:
    """``(doc_id, ids)``: ids as little-endian unsigned 32-bit integers in binary."""
    file = vocabulary.shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            ids = list(own.encode_all(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = text_rows(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str = vocabulary.BYTE_BPE) -> DataFrame:
    """``(doc_id, bytes)`` of ``(doc_id, ids)``."""
    file = vocabulary.shared(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            texts = [own.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "bytes"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


def round_trip(docs: DataFrame, path: str = vocabulary.BYTE_BPE, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, and ``ids`` if asked for: each
    text encoded and decoded in one pass, so bytes do not travel."""
    file = vocabulary.shared(docs.sparkSession, path)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(file.value)
        for batch in batches:
            counts, ids_digests, text_digests, kept = [], [], [], []
            for ids in own.encode_all(batch.column(1).to_pylist()):
                counts.append(len(ids) // 4)
                if keep_ids:
                    kept.append(ids)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string())]
            columns += [pa.array(text_digests, pa.string()), *[pa.array(kept, pa.binary())] * keep_ids]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, shape + ", ids binary" * keep_ids)
