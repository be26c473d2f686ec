"""Normalization, fingerprints and slicing of text columns."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textmill import rules

_TO_END = 2147483647


@F.arrow_udf(StringType())
def _to_nfc(texts: pa.Array) -> pa.Array:
    done = [t if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()]
    return pa.array(done, pa.string())


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts that could change are sent to Python; for the
    others the Arrow column holds null and the input is kept."""
    return F.coalesce(_to_nfc(F.when(text.rlike(rules.MAYBE_NOT_NFC), text)), text)


def valid_utf8(text: Column) -> Column:
    """Replace bytes that are not UTF-8 by U+FFFD."""
    return F.make_valid_utf8(text)


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, f"[{rules.CONTROL}]+", "")


def strip_space(text: Column) -> Column:
    """Trim all Unicode white space, which ``trim`` does not."""
    return F.trim(text, F.lit(rules.SPACE_CHARS))


def normalize_text(text: Column) -> Column:
    """NFC, valid UTF-8, no control characters, no outer white space."""
    return strip_space(strip_control(nfc(valid_utf8(text))))


def once(value: Column) -> Column:
    """A generator of exactly one row, for use in ``select``. Catalyst copies a plain
    expression into every filter and rule above it; it cannot copy this one, so the
    value is computed once per row."""
    return F.explode(F.array(value))


def content_key(text: Column) -> Column:
    """MD5 of the text as given, before any normalization."""
    return F.md5(text)


def prompt_part(text: Column, chars: int = rules.PROMPT_CHARS) -> Column:
    return F.substring(text, 1, chars)


def continuation_part(text: Column, chars: int = rules.PROMPT_CHARS) -> Column:
    return F.substring(text, chars + 1, _TO_END)


def strip_prompt(generated: Column, prompt: Column) -> Column:
    """Drop the prompt from the front of a generated text, then trim."""
    rest = F.substring(generated, F.length(prompt) + 1, F.lit(_TO_END))
    return strip_space(F.when(F.startswith(generated, prompt), rest).otherwise(generated))
