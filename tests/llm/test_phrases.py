"""Collocations against counting every phrase, and the sort against plain counting."""

import os
import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from textmill.llm import phrases


def _plain(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in frequent.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def _rows(seed=3):
    rng = random.Random(seed)
    words = ["Ab", "cd", "é", "ef.", "gh,", "x", "y", "zz", "hot", "hot", "hot", "\tq", "\nr", "É"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for _ in range(120)]
    return rows + [(None, "en"), ("", "fr"), (" \t\n", "fr"), ("hot dog " * 40, "en"), ("one", "solo")] + rows[:5]


@pytest.mark.parametrize("block, chunk", [(1 << 21, 1 << 17), (300, 64)])
def test_equals_counting_every_phrase(spark, monkeypatch, block, chunk):
    """Also with blocks and chunks so small that routes are merged and carried over."""
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "CHUNK_ROWS", chunk)
    rows = _rows()
    docs = spark.createDataFrame([(t, g, 1, "w") for t, g in rows], "text string, lang string, n int, w1 string").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(docs, top=30).collect())
    assert got == _plain(rows, 10, 30)


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


@pytest.mark.parametrize("weighted", [False, True])
def test_three_way_parts(weighted):
    rng = np.random.default_rng(5)
    keys = [rng.integers(0, 4, 500), rng.integers(-1, 3, 500)]
    weights = rng.integers(1, 5, 500) if weighted else None
    plain = Counter()
    for i in range(500):
        plain[int(keys[0][i]), int(keys[1][i])] += int(weights[i]) if weighted else 1
    got = Counter()
    parts = phrases.three_way(keys, np.arange(500), np.zeros(1, np.int64), np.array([500]), weights)
    for _, found, sizes, ended in parts:
        if ended:
            for i, n in zip(found, sizes, strict=True):
                got[int(keys[0][i]), int(keys[1][i])] += int(n)
    assert got == plain


_WORKER = """
import re
import numpy as np
import pyarrow as pa
from textmill.llm import phrases

def used():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024

class Bits:
    value = np.full(phrases.FILTER_BITS // 8, 255, np.uint8)

rng = np.random.default_rng(1)
words = np.array([f"word{i:x}" for i in range(60_000)])

def task():
    for _ in range(3):
        texts = [" ".join(words[np.minimum(rng.zipf(1.2, 300), 60_000) - 1]) for _ in range(2_000)]
        yield pa.record_batch([pa.array(texts), pa.array(["en"] * len(texts))], names=["text", "lang"])

most = 0
for step in (phrases._pair_counts, phrases._suffixes(Bits), phrases._suffixes(Bits)):
    for rows in step(task()):
        most = max(most, used())
    rows = None
print(most, used())
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/status"), reason="reads /proc")
def test_a_worker_needs_and_keeps_little_memory():
    """Two workers and the heap share an executor, and idle workers keep what they hold."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    said = subprocess.run([sys.executable, "-c", _WORKER], cwd=root, capture_output=True, text=True, check=True, timeout=300)
    most, kept = map(int, said.stdout.split())
    assert most < 215
    assert kept < 180
