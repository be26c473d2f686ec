"""Tokenization columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions.porter import stem_tokens


#: Runs of ``rules.SPACE``, told faster by Java: no printable ASCII, and then the signs below
#: 256, which it looks up in a table if they are given one by one.
_BELOW_256 = "".join(f"\\x{{{ord(c):x}}}" for c in rules.SPACE_CHARS if ord(c) < 256)
_SPACES = f"[[^!-~]&&[{_BELOW_256}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]]+"


def words(text: Column) -> Column:
    """Lower-cased, white-space separated tokens."""
    parts = F.split(F.lower(text), _SPACES)
    return F.filter(parts, lambda t: t != "")


def truncate(tokens: Column, limit: int = rules.MAX_SEQ_LENGTH) -> Column:
    return F.slice(tokens, 1, limit)


def rouge_words(text: Column, stem: bool = True) -> Column:
    """Runs of ASCII letters and digits; those over 3 characters are stemmed."""
    parts = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")
    return stem_tokens(parts) if stem else parts


def token_count(text: Column) -> Column:
    return F.size(words(text))


def map_batches(df: DataFrame, callback: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a tokenizer callback to Arrow-sized batches; its result replaces the
    input columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(callback, batches)

    return df.mapInPandas(run, schema)
