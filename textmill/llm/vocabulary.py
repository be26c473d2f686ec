"""Files of public tokenizers: the driver reads one and sends it along; each Python
worker parses it once. The file (under 1 MB) is the only thing broadcast."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Texts of more characters are cut into pre-tokens lazily.
LONG = 1 << 20


def shared(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


@lru_cache(maxsize=4)
def ranks(content: bytes) -> dict[bytes, int]:
    """Rank of each token, by its bytes."""
    lines = (line.split() for line in content.splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in (x for x in lines if x)}


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def pre_tokens(text: str, pattern: str = PATTERN):
    """All matches of the pattern, in order; they cover the whole text."""
    found = _compiled(pattern)
    if len(text) <= LONG:
        return found.findall(text)
    return (m.group() for m in found.finditer(text))
