"""Row quality rules, each a boolean column over normalized text."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import rules


def _rlike_if(text: Column, literal: str, pattern: str) -> Column:
    """``rlike`` for texts with a literal that every match holds; looking for the
    literal alone is far cheaper and rules most texts out."""
    return F.contains(text, F.lit(literal)) & text.rlike(pattern)


def has_html_tag(text: Column) -> Column:
    return _rlike_if(text, "<", rules.HTML_TAG)


def has_html_entity(text: Column) -> Column:
    return _rlike_if(text, "&", rules.HTML_ENTITY)


def has_html(text: Column) -> Column:
    return has_html_tag(text) | has_html_entity(text)


_KIND_LITERAL = {"email": "@", "dob": ":", "mrn": ":", "ssn_label": ":"}


def has_pii_kind(text: Column, kind: str) -> Column:
    pattern = rules.PII[kind]
    literal = _KIND_LITERAL.get(kind)
    return _rlike_if(text, literal, pattern) if literal else text.rlike(pattern)


def has_pii(text: Column) -> Column:
    return (
        has_pii_kind(text, "email") | _rlike_if(text, ":", rules.ANY_LABEL) | text.rlike(rules.ANY_NUMBER)
    )


def pii_kinds(text: Column) -> Column:
    """Names of all PII patterns found, in registry order."""
    hits = [F.when(has_pii_kind(text, kind), F.lit(kind)) for kind in rules.PII]
    return F.filter(F.array(*hits), lambda kind: kind.isNotNull())


def has_broken_unicode(text: Column) -> Column:
    return F.contains(text, F.lit(rules.REPLACEMENT))


def length_ok(text: Column, limits: rules.Limits = rules.Limits()) -> Column:
    return F.length(text).between(limits.min_chars, limits.max_chars)


def boilerplate_score(text: Column, limits: rules.Limits = rules.Limits()) -> Column:
    """How many distinct signal phrases occur, ignoring case."""
    lower = F.lower(text)
    return reduce(add, (F.contains(lower, F.lit(s)).cast("int") for s in limits.signals), F.lit(0))


def is_boilerplate(text: Column, limits: rules.Limits = rules.Limits()) -> Column:
    return boilerplate_score(text, limits) >= limits.min_signals


def first_failure(text: Column, limits: rules.Limits = rules.Limits()) -> Column:
    """Name of the first rule that normalized text fails; null when it passes."""
    return (
        F.when(has_broken_unicode(text), "unicode")
        .when(has_html(text), "html")
        .when(has_pii(text), "pii")
        .when(~length_ok(text, limits), "length")
        .when(is_boilerplate(text, limits), "boilerplate")
    )


def passes_all(text: Column, limits: rules.Limits = rules.Limits()) -> Column:
    """True when no rule fails. The order is by cost, which is free to choose
    when the name of the failing rule is not asked for: the length test alone
    spares long texts every pattern."""
    return (
        length_ok(text, limits)
        & ~has_broken_unicode(text)
        & ~has_html(text)
        & ~is_boilerplate(text, limits)
        & ~has_pii(text)
    )


def eval_eligible(text: Column) -> Column:
    return F.length(text) >= rules.EVAL_MIN_CHARS


def scorable(n_tokens: Column) -> Column:
    """A next-token loss needs at least two tokens."""
    return n_tokens >= 2
