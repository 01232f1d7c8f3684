"""ISBN-10 and ISBN-13 from one raw column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FAKE_ISBN13 = "9999999999999"


def split_isbn(c: Column) -> tuple[Column, Column]:
    """(isbn10, isbn13); at most one is set, both are null for other text."""
    text = F.regexp_replace(c, r"(?U)[\s\x1c-\x1f-]", "")
    isbn10 = F.when(text.rlike(r"\A\d{9}[\dXx]\z"), F.upper(text))
    isbn13 = F.when(text.rlike(r"\A\d{13}\z"), text)
    return isbn10, isbn13
