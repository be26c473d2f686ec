"""Labelled noise over an existing text table, for measuring the rules.

A class picks rows by comparing a hash of (class, seed, id) with its rate, so the
choice needs no random generator and does not depend on partitioning. All classes
come out of one scan: each row is expanded into the variants chosen for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import rules

ID_STRIDE = 16  # ids of variants: id * ID_STRIDE + class number


@dataclass(frozen=True)
class Noise:
    """A class: the label and source it writes, its share of rows, and the
    (prefix, suffix) pairs put around a chosen text."""

    source: str
    label: str
    rate: float
    wraps: tuple[tuple[str, str], ...] = (("", ""),)
    repeats: tuple[int, ...] = ()
    replaces: bool = False


# Labels and sources are fixed values; so are the rates, as shares of the clean
# rows (60, 20, 15, 25, 10 and 15 out of 500) and the repeat counts of long lines.
CLASSES: dict[str, Noise] = {
    "clean": Noise("curated", "clean", 1.0),
    "duplicate": Noise("curated", "clean", 0.12),
    "html": Noise(
        "web_scrape",
        "html",
        0.04,
        (
            ("<section>", "</section>"),
            ("", " <br/>"),
            ("Read <a href='/more'>this</a>: ", ""),
            ("", " &nbsp;"),
            ("Fish &amp; chips. ", ""),
            ("", " &#8212; end"),
            ("Keep x < 7 in mind: ", ""),
            ("", " &#x2014; end"),
        ),
    ),
    "unicode": Noise(
        "ocr_pipeline",
        "unicode",
        0.03,
        (
            ("\x85", ""),
            ("", " \x91quoted\x92"),
            ("\x80", "\x9f"),
            ("", " \u00c0nd \u00c0y \u00ff"),
            ("", f" lost {chr(0xFFFD)} sign"),
            (f"{chr(0xFFFD)}", ""),
            ("", " cafe\u0301 nai\u0308ve"),
            ("A\u030angstro\u0308m \u1100\u1161 ", ""),
            ("\x07\x1b ", " \u3000\u2003\xa0"),
        ),
    ),
    "pii": Noise(
        "mixed",
        "pii",
        0.05,
        (
            ("Write to ana.lopez+x@mail.example.org. ", ""),
            ("", " Ring 212-555-0147 today."),
            ("", " Ring 212 555.0147"),
            ("", " Ring 2125550147"),
            ("SSN 078-05-1120 on file. ", ""),
            ("", " ssn : 078-05-1120"),
            ("Card 4111 1111 1111 1111, ", ""),
            ("", " 4111111111111111"),
            ("", " Born: dob : 07/04/1976"),
            ("mrn:0098765 ", ""),
            ("", " \u0660\u0661\u0662-\u0663\u0664-\u0665\u0666\u0667\u0668"),
            ("", " Ring 212\xa0555\xa00147"),
            ("Card ending in 1111, ", ""),
            ("", " on 2023-11-05"),
            ("", " \u00e9078-05-1120"),
            ("", " DOB 07/04/1976"),
            ("", " code 12-345-6789"),
            ("", " user@localhost"),
        ),
    ),
    "long": Noise("bulk_import", "long", 0.02, repeats=(80, 60)),
    "boilerplate": Noise(
        "template",
        "boilerplate",
        0.03,
        (
            ("", " All rights reserved. Unauthorized Reproduction is an offence."),
            ("See our Terms of Service and our Privacy Policy. ", ""),
            ("", " This email and any attachments are confidential. ALL RIGHTS RESERVED"),
            ("Terms and conditions apply; see the privacy policy, all rights reserved. ", ""),
            ("", " This email and any attachments are confidential."),
            ("All rights reserved. ", " All rights reserved."),
            ("", " Terms of service, privacy policy: ask law@firm.example.com"),
        ),
    ),
    "short": Noise("mixed", "short", 0.02, (("ok ", ""), ("", " is a number"), ("", "\x07"), ("entry number ", " .")), replaces=True),
}
CLASS_NAMES = tuple(CLASSES)


def row_hash(name: str, seed: int, id_col: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(name), F.lit(str(seed)), id_col.cast("string")))


def rate_bound(rate: float) -> str:
    """Upper bound (exclusive) on the first four hex digits of a row hash."""
    return format(min(int(rate * 65536), 65535), "04x")


def _chosen(name: str, seed: int, id_col: Column, rate: float) -> Column:
    if rate >= 1:
        return F.lit(True)
    return F.left(row_hash(name, seed, id_col), F.lit(4)) < rate_bound(rate)


def _pick(name: str, seed: int, id_col: Column, n: int) -> Column:
    """1-based index of the fragment for a row."""
    number = F.conv(F.substring(row_hash(name, seed, id_col), 5, 4), 16, 10).cast("int")
    return 1 + F.pmod(number, F.lit(n))


def _long_line(id_col: Column, times: Column) -> Column:
    sentence = F.concat(F.lit("Entry "), id_col.cast("string"), F.lit(" says the same thing over and over."))
    return F.array_join(F.array_repeat(sentence, times), " ")


def noisy_text(name: str, seed: int, text: Column, id_col: Column) -> Column:
    noise = CLASSES[name]
    if noise.repeats:
        pick = _pick(name, seed, id_col, len(noise.repeats))
        return _long_line(id_col, F.element_at(F.array(*map(F.lit, noise.repeats)), pick))
    if len(noise.wraps) == 1:
        return text
    pick = _pick(name, seed, id_col, len(noise.wraps))
    before, after = (F.element_at(F.array(*[F.lit(w[side]) for w in noise.wraps]), pick) for side in (0, 1))
    return F.concat(before, id_col.cast("string") if noise.replaces else text, after)


def inject_noise(
    df: DataFrame, seed: int = rules.SPLIT_SEED, classes: tuple[str, ...] = CLASS_NAMES, rates: dict[str, float] | None = None
) -> DataFrame:
    """``(doc_id, text, source, label)``: the clean rows and the noisy variants."""
    rates = rates or {}
    id_col, text = F.col("doc_id"), F.col("text")
    variants = [
        F.when(
            _chosen(name, seed, id_col, rates.get(name, CLASSES[name].rate)),
            F.struct(
                (id_col * ID_STRIDE + CLASS_NAMES.index(name)).alias("doc_id"),
                noisy_text(name, seed, text, id_col).alias("text"),
                F.lit(CLASSES[name].source).alias("source"),
                F.lit(CLASSES[name].label).alias("label"),
            ),
        )
        for name in classes
    ]
    return df.select(F.inline(F.filter(F.array(*variants), lambda v: v.isNotNull())))
