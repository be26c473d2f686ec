"""The manifest against a plain tree, at sizes around the runs and blocks."""

import hashlib
import zlib

import pytest

from textmill.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string, grp int, proof string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def _tree(nodes):
    """Root, and the siblings (before, after) of each node per level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            run = nodes[i - i % 16 : i - i % 16 + 16]
            way.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes = [_h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], ways


def _plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, _leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: _tree([leaf for *_, leaf, _ in sorted(groups[name], key=lambda x: x[:3])]) for name in names}
    root, upper = _tree([trees[name][0] for name in names])
    found = []
    for name, above in zip(names, upper, strict=True):
        subroot, ways = trees[name]
        for (*_, leaf, row), way in zip(sorted(groups[name], key=lambda x: x[:3]), ways, strict=True):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            fold = _leaf(row, tampered)
            for before, after in way + above:
                fold = _h(before, fold, after)
            found.append((row[0], leaf, subroot, root, _h(*[b + a for b, a in way + above]), fold, fold == root))
    return sorted(found, key=str)


def _check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in merkle.manifest_report(docs).collect()]
    assert sorted(got, key=str) == _plain(rows)


@pytest.mark.parametrize("digits", [3, 1])
def test_equals_a_plain_tree(spark, monkeypatch, digits):
    """With one digit a block is one run, so the rollup needs several storeys."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 16**digits)
    rows = [(i, f"Text {i} É", "en", "big", i) for i in range(273)]
    for name, n in (("a", 1), ("b", 2), ("c", 16), ("d", 17), (None, 33), ("", 3)):
        rows += [(1000 + i, None if i % 4 == 1 else "Ab" * i, None, name, None) for i in range(n)]
    rows += [(None, "no id", "de", "a", 5), (7, "again", "en", "big", 1), (7, "again", "en", "big", 1), (3, "", "en", "big", 0)]
    rows += [(5000 + i, "same", "en", f"s{i:02d}", 4) for i in range(20)]
    _check(spark, rows)


def test_one_row_and_none(spark):
    _check(spark, [(4, "Only ONE", "en", "s", 8)])
    assert merkle.manifest_report(spark.createDataFrame([], SCHEMA)).count() == 0
