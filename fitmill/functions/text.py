"""Text normalisation. Every function is a single projected expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.rules.patterns import (
    ARTEFACTS, BULLET, BULLET_GLYPHS, BULLET_SPLIT, EMAIL, EMAIL_TAG, PHONE, PHONE_TAG, URL,
)

MIN_BULLET_CHARS = 10


def present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip_urls(text: Column) -> Column:
    return rx.replace(present(text), URL, " ")


def mask_email(text: Column) -> Column:
    # A match can only begin where a run of address characters begins or where the
    # previous match ended. Saying so keeps long runs without "@" linear.
    return rx.replace(present(text), rf"(?:\G|(?<![\w.-])){EMAIL}", EMAIL_TAG)


def mask_phone(text: Column) -> Column:
    return rx.replace(present(text), PHONE, PHONE_TAG)


def normalise_bullets(text: Column) -> Column:
    return F.translate(present(text), BULLET_GLYPHS, BULLET * len(BULLET_GLYPHS))


def collapse_whitespace(text: Column) -> Column:
    return rx.replace(present(text), r"\s+", " ")


def collapse_dots(text: Column) -> Column:
    return rx.replace(present(text), r"\.{2,}", ".")


def clean_text(text: Column) -> Column:
    """URLs out, e-mail and phone masked, bullets, white space and dots unified, trimmed."""
    for step in (strip_urls, mask_email, mask_phone, normalise_bullets, collapse_whitespace, collapse_dots):
        text = step(text)
    return F.trim(text)


def normalise_lines(text: Column) -> Column:
    """Strip each line and drop blank ones: any white space around a line break is that break."""
    return rx.strip(rx.replace(present(text), r"(?<!\s)(?:(?!\n)\s)*+\n\s*+", "\n"))


def bullet_items(text: Column) -> Column:
    """Pieces between bullets, hyphens, asterisks and list numbers, longer than ten characters."""
    pieces = F.split(present(text), rx.expand(BULLET_SPLIT))
    return F.filter(F.transform(pieces, rx.strip), lambda p: F.char_length(p) > MIN_BULLET_CHARS)


def repair_artefacts(text: Column) -> Column:
    """Squeeze white space, then turn left-over escapes and mis-decoded marks into plain text."""
    text = rx.squeeze(present(text))
    for wrong, right in ARTEFACTS:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def word_count(text: Column) -> Column:
    return rx.word_count(present(text))


def char_count(text: Column) -> Column:
    return F.char_length(present(text))


def long_enough(text: Column, min_chars: int = 100) -> Column:
    return F.char_length(text) >= min_chars
