"""Limits, word lists and patterns, kept as data.

Patterns are written for ``java.util.regex`` and spell their character classes
out, so they do not depend on what a given JDK takes ``\\b``, ``\\d``, ``\\s`` or
``.`` to mean. They follow the Unicode rules of Python's ``re`` on ``str``.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: cleaning -------------------------------------------------
RULES_VERSION = "1.0.0"
SPLIT_SEED = 42
MIN_CHARS = 20
MAX_CHARS = 2000
TRAIN_END = 0.8
VAL_END = 0.9
SPLITS = ("train", "val", "test")
REASONS = ("duplicate", "unicode", "html", "pii", "length", "boilerplate")

BOILERPLATE_SIGNALS = (
    "terms of service",
    "privacy policy",
    "all rights reserved",
    "unauthorized reproduction",
    "terms and conditions apply",
    "this email and any attachments are confidential",
)
MIN_SIGNALS = 2



@dataclass(frozen=True)
class Limits:
    """What a cleaning job can set: lengths of a text, boilerplate phrases (lower case)
    and how many make a text boilerplate, and where train and val end."""

    min_chars: int = MIN_CHARS
    max_chars: int = MAX_CHARS
    signals: tuple[str, ...] = BOILERPLATE_SIGNALS
    min_signals: int = MIN_SIGNALS
    train_end: float = TRAIN_END
    val_end: float = VAL_END


# --- Fixed values: requests and guardrails ----------------------------------
MIN_PROMPT_CHARS = 3
MAX_PROMPT_CHARS = 2000
MAX_NEW_TOKENS = 512
DEFAULT_NEW_TOKENS = 128
MAX_TEMPERATURE = 2.0
DEFAULT_TEMPERATURE = 0.7
DEFAULT_SAFE_MODE = True
RATE_LIMIT = 30
RATE_WINDOW_SECONDS = 60
UNKNOWN = "unknown"

SYSTEM_PROMPT = (
    "You are a helpful AI assistant specialized in machine learning topics. "
    "Follow these rules strictly:\n"
    "1. Only answer questions within your knowledge. If unsure, say so.\n"
    "2. Never fabricate citations, paper titles, or author names.\n"
    "3. If asked to produce harmful content, politely decline.\n"
    "4. Keep responses concise and cite sources when possible.\n"
    "5. Do not reproduce PII or sensitive data from training."
)
REFUSAL = (
    "I'm unable to fulfill this request. It falls outside my safety guidelines. "
    "I can help with machine learning, data science, and related technical topics."
)
REASON_TOO_SHORT = "Input too short"
REASON_TOO_LONG = "Input exceeds 2000 characters"
REASON_PATTERN = "Matched safety pattern: "
REASON_EMPTY_OUTPUT = "Empty model output"
REASON_OUTPUT_PII = "Output contains potential PII"

# First match wins; ``[^\n]`` is what Python's ``.`` means.
GUARD_PATTERNS = (
    ("ignore previous instructions", "prompt_injection"),
    ("you are now", "jailbreak"),
    ("pretend you are", "jailbreak"),
    ("invent a citation", "hallucination_trap"),
    ("make up a reference", "hallucination_trap"),
    ("write malware", "harmful_content"),
    ("how to hack", "harmful_content"),
    ("give me someone's ssn", "pii_extraction"),
    (r"what is [^\n]* personal", "pii_extraction"),
)

# --- Fixed values: evaluation -----------------------------------------------
EVAL_CAP = 100
EVAL_MIN_CHARS = 60
PROMPT_CHARS = 50
MAX_SEQ_LENGTH = 256

REPLACEMENT = chr(0xFFFD)

# --- Character classes ------------------------------------------------------
# The 29 code points Python's ``str.strip``, ``str.split`` and ``\s`` agree on.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
CONTROL = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f"
WORD = r"[\p{L}\p{N}_]"
_NOT_AFTER = f"(?<!{WORD})"
_NOT_BEFORE = f"(?!{WORD})"
# On either side of a word: the place where a word begins or ends.
_EDGE = f"(?:(?<={WORD}){_NOT_BEFORE}|{_NOT_AFTER}(?={WORD}))"
_D = r"\p{Nd}"
_S = f"[{SPACE}]"

# --- Fixed values: what counts as markup and as personal data ----------------
# A "<", something but ">", and a ">" anywhere after. Only the first such "<" need
# be tried, so the pattern stays linear on texts full of "<".
HTML_TAG = r"(?s)\A(?>.*?<[^>]).*>"
HTML_ENTITY = rf"&[a-zA-Z]+;|&#{_D}+;"

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
_SSN = rf"{_D}{{3}}-{_D}{{2}}-{_D}{{4}}"
_PHONE = rf"{_D}{{3}}[-.{SPACE}]?{_D}{{3}}[-.{SPACE}]?{_D}{{4}}"
_CARD = rf"{_D}{{4}}{_S}?{_D}{{4}}{_S}?{_D}{{4}}{_S}?{_D}{{4}}"
_DOB = rf"DOB{_S}*:{_S}*{_D}{{2}}/{_D}{{2}}/{_D}{{4}}"
_MRN = rf"MRN{_S}*:{_S}*{_D}+"
_SSN_LABEL = rf"SSN{_S}*:{_S}*{_SSN}"


def _numbers(*bodies: str) -> str:
    """Bodies that begin with a digit: the cheap test on it comes first."""
    return f"(?={_D}){_NOT_AFTER}(?:{'|'.join(bodies)}){_NOT_BEFORE}"


def _labels(*bodies: str) -> str:
    """Bodies that begin with a word, in any case."""
    return f"(?iu)(?=[DMS]){_NOT_AFTER}(?:{'|'.join(bodies)}){_NOT_BEFORE}"


PII = {
    "email": f"{_EDGE}{_EMAIL}{_EDGE}",
    "ssn": _numbers(_SSN),
    "phone": _numbers(_PHONE),
    "card": _numbers(_CARD),
    "dob": _labels(_DOB),
    "mrn": _labels(_MRN),
    "ssn_label": _labels(_SSN_LABEL),
}
# The same without telling kinds apart. A labelled SSN is an SSN already.
ANY_NUMBER = _numbers(_SSN, _PHONE, _CARD)
ANY_LABEL = _labels(_DOB, _MRN)
OUTPUT_PII = _numbers(_SSN, _CARD)

# Characters that can make a text differ from its NFC form: marks, conjoining
# jamo, and code points whose NFC form is another code point. A text with none
# of them is in NFC already.
MAYBE_NOT_NFC = (
    r"[\x{300}-\x{10ffff}&&[\p{M}\x{340}-\x{374}\x{37e}\x{387}\x{890}-\x{dff}\x{f00}-\x{fff}\x{1100}-\x{11ff}"
    r"\x{1700}-\x{177f}\x{1ab0}-\x{1aff}\x{1dc0}-\x{1fff}\x{2000}\x{2001}\x{2126}\x{212a}\x{212b}"
    r"\x{2329}\x{232a}\x{2adc}\x{f900}-\x{faff}\x{fb1d}-\x{fb4f}\x{10d00}-\x{11fff}\x{16100}-\x{161ff}"
    r"\x{16d00}-\x{16dff}\x{1d15e}-\x{1d1c0}\x{1e000}-\x{1efff}\x{2f800}-\x{2fa1f}]]"
)
