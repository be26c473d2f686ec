"""BPE against the public library, counts against a plain forward pass."""

import hashlib
import random
import time

import numpy as np
import pytest
import tiktoken

from textmill.llm import bpe, tokencount, vocabulary

CASES = [
    "",
    "Hello world, hello  world\n\n",
    "   ",
    "naïve — 数学 \U0001f600́ l'été d'hiver it's I'LL",
    "aaaaaaaaaaaaaaaaaaaaaaa",
    "<|endoftext|> def f(x):\r\n\treturn x**2 # 12345678",
    "x" * 5000,
    "ab" * 3000,
    "\u0000￿퟿",
]


@pytest.fixture(scope="module")
def ranks():
    with open(vocabulary.BYTE_BPE, "rb") as file:
        return vocabulary.ranks(file.read())


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _random_texts(n):
    rng = random.Random(7)
    return ["".join(rng.choice("abet hinor'1 \né中") for _ in range(rng.randrange(200))) for _ in range(n)]


def test_same_ids_as_the_public_library(ranks, public):
    own = bpe.Encoder(ranks)
    for text in CASES + _random_texts(300):
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == public.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()
    assert own.queue.top == 0 and not own.queue.buckets


def test_one_pre_token_of_a_megabyte(ranks, public):
    own, text = bpe.Encoder(ranks), "abcd" * 75_000
    start = time.time()
    assert np.frombuffer(own.encode(text), "<u4").tolist() == public.encode_ordinary(text)
    assert time.time() - start < 60


def test_long_texts_are_cut_lazily(ranks, public, monkeypatch):
    monkeypatch.setattr(vocabulary, "LONG", 10)
    text = CASES[3] * 3
    assert np.frombuffer(bpe.Encoder(ranks).encode(text), "<u4").tolist() == public.encode_ordinary(text)


def test_a_full_cache_changes_nothing(ranks, public, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 2)
    own = bpe.Encoder(ranks)
    for text in CASES:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == public.encode_ordinary(text)


@pytest.mark.parametrize("few", [0, 12, 10**9])
def test_texts_encoded_together_equal_the_public_library(ranks, public, monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    monkeypatch.setattr(bpe, "GROUP", 4000)
    monkeypatch.setattr(vocabulary, "LONG", 5500)
    own = bpe.Encoder(ranks)
    texts = [*CASES, *_random_texts(300), "ab aaaa" * 1000, "a" * 64 + " " + "a" * 65]
    got = list(own.encode_all(texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [public.encode_ordinary(t) for t in texts]
    assert own.queue.top == 0 and not own.queue.buckets and not any(own.queue.low) and not any(own.queue.mid)


def test_a_lower_rank_that_comes_up_in_a_piece_goes_first():
    # Merging "ab" makes "abc", of a lower rank, which must come before the second "ab".
    small = {bytes([b]): b for b in range(256)} | {b"abca": 300, b"abc": 301, b"ab": 302, b"cab": 303}
    own, texts = bpe.Encoder(small), ["abcab", "abcabcab", "xabab"]
    want = [own.merge(t.encode()) for t in texts]
    for few in (0, 12):
        bpe.FEW, before = few, bpe.FEW
        try:
            got = own.merge_all([t.encode() for t in texts * 20])
        finally:
            bpe.FEW = before
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want * 20


def test_new_pieces_of_texts_are_merged_once_a_group_however_full_the_cache(ranks, public, monkeypatch):
    asked = []
    monkeypatch.setattr(bpe, "CACHE", 2)
    monkeypatch.setattr(bpe.Encoder, "merge", lambda self, piece: asked.append(piece))
    merge_all = bpe.Encoder.merge_all
    monkeypatch.setattr(bpe.Encoder, "merge_all", lambda self, pieces: asked.extend(pieces) or merge_all(self, pieces))
    texts = ["Reiereau etlequetreaux osracija aninthwh"] * 50
    got = list(bpe.Encoder(ranks).encode_all(texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [public.encode_ordinary(t) for t in texts]
    assert len(asked) == len(set(asked)) == 4


def test_a_vocabulary_that_lacks_a_byte_still_says_so():
    own = bpe.Encoder({b"a": 0, b"b": 1, b"ab": 2})
    assert list(own.encode_all(["abab"])) == [np.array([2, 2], "<u4").tobytes()]
    with pytest.raises(KeyError):
        list(own.encode_all(["abz"]))


def _frame(spark, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(0, texts[0], "x", "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens string").repartition(3)


def test_tables(spark, public):
    texts = [None, *CASES]
    docs = _frame(spark, texts)
    got = bpe.round_trip(docs).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        text = texts[row.doc_id] or ""
        ids = public.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert bpe.round_trip(docs.limit(0)).count() == 0


def _plain_count(piece, costs):
    best = [0] + [None] * len(piece)
    for end in range(1, len(piece) + 1):
        best[end] = min(best[s] + costs[piece[s:end]] for s in range(end) if piece[s:end] in costs)
    return best[-1] & ((1 << tokencount.COUNT_BITS) - 1)


def test_counts_equal_a_plain_forward_pass(spark, ranks):
    costs = tokencount.token_costs(ranks)
    texts = [None, *[t[:300] for t in CASES], *_random_texts(40)]
    got = tokencount.token_counts(_frame(spark, texts)).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        pieces = list(vocabulary.pre_tokens(texts[row.doc_id] or ""))
        assert row.n_pre_tokens == len(pieces)
        assert row.n_tokens == sum(_plain_count(p.encode(), costs) for p in pieces)
    assert tokencount.token_counts(_frame(spark, [""]).limit(0)).count() == 0


def test_each_trie_node_is_computed_once(ranks):
    asked = []

    class Costs(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    costs = Costs(tokencount.token_costs(ranks))
    pieces = sorted([b"there", b"then", b"the", b"therefore"])
    counts = tokencount.trie_counts(pieces, costs, max(map(len, ranks)))
    assert counts == [_plain_count(p, dict(costs)) for p in pieces]
    nodes = {p[:i] for p in pieces for i in range(1, len(p) + 1)}
    assert len(asked) == sum(len(n) for n in nodes)
