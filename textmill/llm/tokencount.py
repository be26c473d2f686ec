"""Token counts under a unigram model, by dynamic programming over a shared trie.

A text's count is the sum over its pre-tokens of the number of tokens in the pre-token's
cheapest segmentation. The distinct pre-tokens of a batch make a trie: sorted, they are
its leaves from left to right, and the bytes a pre-token shares with the one before it
are the trie path that both run through. The forward cost of a trie node (cheapest way
to write the path to it) is computed once, when the walk first enters the node; a
terminal node's count is stored for its pre-token. Only the path to the current node is
held, so memory is bounded by the longest pre-token.

No public vocabulary file holds unigram probabilities, and tokenizers are not trained
here. The cost of a token follows from its rank by Zipf's law: ln(rank + 2), in
millionths. Of equally cheap segmentations the one with the fewest tokens counts. Every
byte is a token, so every text can be written.

The work is row-local: one pass, no shuffle. A worker keeps counts of pre-tokens it has
met, up to ``CACHE`` entries; a miss only costs time.

Defined cases: a null or empty text has no tokens; repeated rows give equal rows; columns
other than ``doc_id`` and ``text`` are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm import vocabulary
from textmill.llm.common import text_rows

CACHE = 400_000
CACHED_CHARS = 64
#: A cost is kept above this many bits, the number of tokens below.
COUNT_BITS = 40


def token_costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    return {token: (round(1e6 * math.log(rank + 2)) << COUNT_BITS) + 1 for token, rank in ranks.items()}


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def trie_counts(pieces: list[bytes], costs: dict[bytes, int], longest: int) -> list[int]:
    """Tokens of each piece; the pieces must be sorted."""
    forward, previous, counts = [0], b"", []
    low = (1 << COUNT_BITS) - 1
    for piece in pieces:
        depth = _shared(previous, piece)
        del forward[depth + 1 :]
        for end in range(depth + 1, len(piece) + 1):
            best = None
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                cost = costs.get(piece[start:end])
                if cost is not None:
                    cost += forward[start]
                    if best is None or cost < best:
                        best = cost
            forward.append(best)
        counts.append(forward[-1] & low)
        previous = piece
    return counts


class Counts:
    """Counts of pre-tokens that a worker has met."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.costs = token_costs(ranks)
        self.longest = max(map(len, ranks))
        self.known: dict[str, int] = {}

    def of(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens and pre-tokens of each text."""
        met = [Counter(vocabulary.pre_tokens(text)) for text in texts]
        if len(self.known) > CACHE:
            self.known = {}
        new = {piece for pieces in met for piece in pieces if piece not in self.known}
        order = sorted(piece.encode() for piece in new)
        found = dict(zip((b.decode() for b in order), trie_counts(order, self.costs, self.longest), strict=True))
        self.known.update({piece: n for piece, n in found.items() if len(piece) <= CACHED_CHARS})
        known = self.known

        def tokens(pieces: Counter) -> int:
            return sum([(known[p] if p in known else found[p]) * n for p, n in pieces.items()])

        return [tokens(pieces) for pieces in met], [sum(pieces.values()) for pieces in met]


_counts: dict[int, Counts] = {}
#: Characters of text whose pre-tokens share one trie.
BATCH_CHARS = 4 << 20


def _counted(content: bytes) -> Counts:
    key = hash(content)
    if key not in _counts:
        _counts[key] = Counts(vocabulary.ranks(content))
    return _counts[key]


def token_counts(docs: DataFrame, path: str = vocabulary.BYTE_BPE) -> DataFrame:
    """``(doc_id, n_tokens, n_pre_tokens)``."""
    file = vocabulary.shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _counted(file.value)
        for batch in batches:
            tokens, pieces, texts, chars = [], [], [], 0
            for text in batch.column(1).to_pylist():
                texts.append(text)
                chars += len(text)
                if chars > BATCH_CHARS:
                    for all_, new in zip((tokens, pieces), own.of(texts), strict=True):
                        all_.extend(new)
                    texts, chars = [], 0
            for all_, new in zip((tokens, pieces), own.of(texts), strict=True):
                all_.extend(new)
            columns = [batch.column(0), pa.array(tokens, pa.int64()), pa.array(pieces, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "n_pre_tokens"])

    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_pre_tokens long")
