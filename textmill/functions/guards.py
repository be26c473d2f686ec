"""Guardrail columns for prompts and for generated texts.

Results are structs ``(allowed, reason, category[, modified_prompt])`` in which an
unset text is ``""``, never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions.text import strip_space
from textmill.functions.tokens import token_count


def render_prompt(prompt: Column) -> Column:
    return F.concat(F.lit(rules.SYSTEM_PROMPT + "\n\nUser: "), prompt, F.lit("\nAssistant:"))


def too_short(prompt: Column) -> Column:
    return F.length(strip_space(prompt)) < rules.MIN_PROMPT_CHARS


def too_long(prompt: Column) -> Column:
    return F.length(prompt) > rules.MAX_PROMPT_CHARS


def matched_category(prompt: Column, patterns: tuple[tuple[str, str], ...] = rules.GUARD_PATTERNS) -> Column:
    """Category of the first guard pattern found; null when none is."""
    hits = [F.when(prompt.rlike(f"(?iu){p}"), F.lit(category)) for p, category in patterns]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def _verdict(category: Column, reason: Column) -> list[Column]:
    return [
        category.isNull().alias("allowed"),
        F.coalesce(reason, F.lit("")).alias("reason"),
        F.coalesce(category, F.lit("")).alias("category"),
    ]


def _input_struct(category: Column, prompt: Column) -> Column:
    short, long = F.lit("validation:short"), F.lit("validation:long")
    reason = (
        F.when(category == short, rules.REASON_TOO_SHORT)
        .when(category == long, rules.REASON_TOO_LONG)
        .when(category.isNotNull(), F.concat(F.lit(rules.REASON_PATTERN), category))
    )
    public = F.when(category.isin("validation:short", "validation:long"), "validation").otherwise(category)
    rendered = F.when(category.isNull(), render_prompt(prompt)).otherwise("")
    return F.struct(*_verdict(public, reason), rendered.alias("modified_prompt"))


def check_input(
    prompt: Column,
    safe_mode: Column | None = None,
    guards: tuple[tuple[str, str], ...] = rules.GUARD_PATTERNS,
    matched: Column | None = None,
) -> Column:
    """Too short, too long, guard patterns (in safe mode only), else allowed. ``matched``
    is the category of the guard pattern found, if that is known already."""
    patterns = matched_category(prompt, guards) if matched is None else matched
    if safe_mode is not None:
        patterns = F.when(safe_mode, patterns)
    category = (
        F.when(too_short(prompt), "validation:short")
        .when(too_long(prompt), "validation:long")
        .otherwise(patterns)
    )
    return _bind(category, lambda c: _input_struct(c, prompt))


def empty_output(text: Column) -> Column:
    return strip_space(text) == ""


def output_has_pii(text: Column) -> Column:
    return text.rlike(rules.OUTPUT_PII)


def check_output(text: Column, safe_mode: Column | None = None) -> Column:
    """Empty, then personal data (in safe mode only), else allowed."""
    leak = output_has_pii(text) if safe_mode is None else safe_mode & output_has_pii(text)
    category = F.when(empty_output(text), "output_validation").when(leak, "pii_leakage")

    def build(c: Column) -> Column:
        reason = F.when(c == "output_validation", rules.REASON_EMPTY_OUTPUT).when(
            c == "pii_leakage", rules.REASON_OUTPUT_PII
        )
        return F.struct(*_verdict(c, reason))

    return _bind(category, build)


def _bind(value: Column, build) -> Column:
    """``build(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), build), 1)


def refuse_unless(allowed: Column, text: Column) -> Column:
    return F.when(allowed, text).otherwise(rules.REFUSAL)


def response_tokens(input_allowed: Column, final_text: Column) -> Column:
    """Tokens of what was returned; 0 when the input was refused."""
    return F.when(input_allowed, token_count(final_text)).otherwise(0)
