"""Whitespace and blank handling shared by all cleaning jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character Unicode calls white space plus the four ASCII separators.
# Use it under (?U): plain Java \s knows only ASCII, so it misses NBSP.
WS = r"[\s\x1c-\x1f]"


def squeeze(c: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(c, f"(?U){WS}+", " ")


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(c, f"(?U)^{WS}+|{WS}+$", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Lower-case with single spaces; null becomes the empty text."""
    return F.trim(squeeze(F.lower(F.coalesce(c, F.lit("")))))


def clean_description(c: Column) -> Column:
    """One line, single spaces; nothing left becomes null."""
    return empty_to_null(F.trim(squeeze(c)))


def blank_to_null(c: Column) -> Column:
    """``NULLIF(TRIM(c), '')``."""
    return empty_to_null(F.trim(c))


def is_ascii(c: Column) -> Column:
    return c.rlike(r"\A[\x00-\x7F]*\z")


def has_any(c: Column, needles) -> Column:
    """True where the text holds at least one of the needles (words or patterns)."""
    return c.rlike("|".join(needles))


def first_match(cases, otherwise: Column) -> Column:
    """First true condition wins: ``cases`` is a list of (condition, value)."""
    (condition, value), *rest = cases
    ladder = F.when(condition, value)
    for condition, value in rest:
        ladder = ladder.when(condition, value)
    return ladder.otherwise(otherwise)
