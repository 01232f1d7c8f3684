"""Numbers out of text: pages, star counts, money; rating arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STARS = ("5_star", "4_star", "3_star", "2_star", "1_star")
STAR_VALUES = (5, 4, 3, 2, 1)
PLACES = "decimal(38,18)"


def first_number(c: Column) -> Column:
    """First run of digits as a number, null when there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("int")


def star_counts(c: Column) -> Column:
    """List text to an array of at most five counts."""
    listed = F.from_json(c, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    wanted = F.slice(listed, 1, len(STARS))
    return F.transform(wanted, lambda x: x.try_cast("bigint"))


def star_columns(counts: Column) -> dict[str, Column]:
    """Five count columns, five stars first.

    An empty array is five zeros, a short one is filled up with zeros, and one
    value that is no number makes all five null.
    """
    readable = F.forall(counts, lambda x: x.isNotNull())
    return {star: F.when(readable, F.coalesce(F.get(counts, F.lit(i)), F.lit(0).cast("bigint")))
            for i, star in enumerate(STARS)}


def normalize_ratings_by_stars(df: DataFrame, source: str = "ratingsByStars") -> DataFrame:
    return (df.withColumn("_counts", star_counts(F.col(source)))
            .withColumns(star_columns(F.col("_counts"))).drop("_counts"))


def strip_currency(c: Column) -> Column:
    """``$1,234.50`` to 1234.50; text that is no amount is an error."""
    return F.translate(F.trim(c), "$,", "").cast("decimal(10,2)")


def flag(c: Column, true_text: str) -> Column:
    """Text flag to boolean; everything but ``true_text`` is false."""
    return F.coalesce(c == true_text, F.lit(False))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Null for a zero denominator; exact to 18 places."""
    return numerator.cast(PLACES) / F.nullif(denominator, F.lit(0)).cast("decimal(19,0)")


def weighted_rating(counts: list[Column]) -> Column:
    """Average star value; null if a class is missing or there are no votes."""
    total, weighted = counts[0], counts[0] * STAR_VALUES[0]
    for count, value in zip(counts[1:], STAR_VALUES[1:]):
        total, weighted = total + count, weighted + count * value
    return guarded_ratio(weighted, total).cast("decimal(3,2)")
