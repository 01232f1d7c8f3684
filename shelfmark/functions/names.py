"""Author text: separators, initials, primary author, first/middle/last name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import WS, empty_to_null, squeeze, strip

OUTSIDE_PARENS = r"(?![^(]*\))"


def normalize_author_text(c: Column, paren_aware: bool = False) -> Column:
    """Lower-case, ``j.k.`` to ``jk``, and ``&``, ``and``, ``;`` to a comma.

    By default separators inside parentheses turn into commas as well;
    ``paren_aware`` leaves those alone.
    """
    guard = OUTSIDE_PARENS if paren_aware else ""
    text = F.regexp_replace(F.lower(c), r"(?U)\b([a-z])\.", "$1")
    text = F.regexp_replace(squeeze(text), rf"(?U){WS}*(?:&|\band\b|;){WS}*{guard}", ", ")
    return strip(text)


def author_norm(c: Column) -> Column:
    """Second pass over the author text, keeping roles in parentheses."""
    text = strip(F.lower(c))
    text = F.regexp_replace(text, rf"(?U){WS}*\(goodreads{WS}+author\)", "")
    text = squeeze(F.regexp_replace(text, r"(?U)\b([a-z])\.(?!\))", "$1"))
    text = F.regexp_replace(text, rf"(?U){WS}*[&;]{WS}*", ", ")
    text = F.regexp_replace(text, rf"(?U){WS}+and{WS}+{OUTSIDE_PARENS}", ", ")
    return empty_to_null(strip(text))


def primary_author(c: Column) -> Column:
    """Text before the first comma, role included."""
    return empty_to_null(strip(F.split_part(c, F.lit(","), F.lit(1))))


def primary_author_name(c: Column) -> Column:
    """Primary author without anything in parentheses."""
    return empty_to_null(strip(F.regexp_replace(c, rf"(?U){WS}*\([^)]*\)", "")))


def person_name_parts(full_name: Column, letters_only: bool) -> dict[str, Column]:
    """First, middle and last name from white-space tokens.

    ``letters_only`` is the back-fill form (letters kept, empty is null);
    without it the tokens are taken as they are.
    """
    tokens = F.split(F.trim(squeeze(full_name) if letters_only else full_name), r"\s+")
    n = F.size(tokens)
    first = F.get(tokens, F.lit(0))
    last = F.when(n >= 2, F.element_at(tokens, -1))
    middle = F.when(n >= 3, F.array_join(F.slice(tokens, 2, F.greatest(n - 2, F.lit(0))), " "))
    if letters_only:
        first = empty_to_null(F.regexp_replace(first, "[^A-Za-z]", ""))
        last = empty_to_null(F.regexp_replace(last, "[^A-Za-z]", ""))
        middle = empty_to_null(F.regexp_replace(middle, "[^A-Za-z ]", ""))
    return {"first_name": first, "middle_name": middle, "last_name": last}


def fill_person_name(full_name: Column, first: Column, middle: Column, last: Column) -> dict[str, Column]:
    """Insert form: split only where all three parts are missing."""
    missing = full_name.isNotNull() & first.isNull() & middle.isNull() & last.isNull()
    parts = person_name_parts(full_name, letters_only=False)
    given = {"first_name": first, "middle_name": middle, "last_name": last}
    return {k: F.when(missing, parts[k]).otherwise(given[k]) for k in given}


def all_authors(*names: Column) -> Column:
    """Names side by side, nulls skipped."""
    return F.concat_ws(", ", *names)
