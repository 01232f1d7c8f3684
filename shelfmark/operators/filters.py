"""Row filters of the cleaning job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.isbn import FAKE_ISBN13
from shelfmark.functions.publishers import is_latin
from shelfmark.functions.text import is_ascii


def english_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("language") == "English")


def ascii_titles(df: DataFrame, col: str = "title") -> DataFrame:
    return df.filter((F.col(col) != "") & is_ascii(F.col(col)))


def latin_publishers(df: DataFrame, col: str = "publisher") -> DataFrame:
    return df.filter(is_latin(F.col(col)))


def drop_fake_isbn13(df: DataFrame, col: str = "isbn13") -> DataFrame:
    return df.filter(~F.col(col).eqNullSafe(FAKE_ISBN13))


def require_isbn(df: DataFrame) -> DataFrame:
    return df.filter(F.col("isbn10").isNotNull() | F.col("isbn13").isNotNull())


def holds(c: Column, pattern: str) -> Column:
    """Regex search where null counts as no hit."""
    return F.coalesce(c.rlike(pattern), F.lit(False))
