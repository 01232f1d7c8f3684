"""Row and key checks: each gives (valid, rejected), rejected with a reason."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import first_match

ISBN13_LENGTH = "ISBN13 must be exactly 13 characters"
ISBN10_LENGTH = "ISBN10 must be exactly 10 characters"
NO_ISBN = "At least one ISBN (ISBN10 or ISBN13) must be provided"
FUTURE_DATE = "Publish date cannot be in the future"
FUTURE_ORIGINAL_DATE = "Original publish date cannot be in the future"
NEGATIVE_COUNT = "Rating count cannot be negative"


class RejectedRows(ValueError):
    """A strict check found rows that break its rule."""


def split_by_reason(df: DataFrame, reason: Column, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason; ``strict`` raises on the first bad row."""
    judged = df.withColumn("reason", reason)
    rejected = judged.filter(F.col("reason").isNotNull())
    if strict:
        bad = rejected.select("reason").first()
        if bad is not None:
            raise RejectedRows(bad["reason"])
    return judged.filter(F.col("reason").isNull()).drop("reason"), rejected


def isbn_reason() -> Column:
    isbn10, isbn13 = F.col("isbn10"), F.col("isbn13")
    return first_match([
        (F.length(isbn13) != 13, F.lit(ISBN13_LENGTH)),
        (F.length(isbn10) != 10, F.lit(ISBN10_LENGTH)),
        (isbn10.isNull() & isbn13.isNull(), F.lit(NO_ISBN)),
    ], otherwise=F.lit(None).cast("string"))


def publish_date_reason(run_date: dt.date) -> Column:
    today = F.lit(run_date)
    return first_match([
        (F.col("publish_date") > today, F.lit(FUTURE_DATE)),
        (F.col("original_publish_date") > today, F.lit(FUTURE_ORIGINAL_DATE)),
    ], otherwise=F.lit(None).cast("string"))


def rating_reason() -> Column:
    return F.when(F.col("count") < 0, F.lit(NEGATIVE_COUNT))


def check_isbn(df: DataFrame, strict: bool = False):
    return split_by_reason(df, isbn_reason(), strict)


def check_publish_dates(df: DataFrame, run_date: dt.date, strict: bool = False):
    return split_by_reason(df, publish_date_reason(run_date), strict)


def check_rating_count(df: DataFrame, strict: bool = False):
    return split_by_reason(df, rating_reason(), strict)


def not_null_reason(cols: list[str]) -> Column:
    return first_match([(F.col(c).isNull(), F.lit(f"{c} must not be null")) for c in cols], otherwise=F.lit(None).cast("string"))


def check_not_null(df: DataFrame, cols: list[str], strict: bool = False):
    return split_by_reason(df, not_null_reason(cols), strict)


def check_unique(df: DataFrame, keys: list[str], strict: bool = False):
    """Rows whose key occurs once, and all rows of a repeated key; null never equals null.

    The keys are counted before any row moves, and only the repeated ones,
    marked with their count, are looked up again.
    """
    repeated = (df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n"))
                .filter("_n > 1").drop("_n").withColumn("_repeated", F.lit(True)))
    marked = df.join(repeated, keys, "left")
    reason = F.when(F.col("_repeated"), F.lit(f"duplicate key ({', '.join(keys)})"))
    valid, rejected = split_by_reason(marked, reason, strict)
    return valid.drop("_repeated"), rejected.drop("_repeated")


def check_foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str, strict: bool = False):
    """Rows whose key is null or in the parent, and orphans.

    Distinct keys are tested, not rows, so a hot key is tested once.
    """
    orphans = (child.select(key).filter(F.col(key).isNotNull()).distinct()
               .join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
               .withColumn("_orphan", F.lit(True)))
    marked = child.join(orphans, key, "left")
    reason = F.when(F.col("_orphan"), F.lit(f"{key} has no parent row"))
    valid, rejected = split_by_reason(marked, reason, strict)
    return valid.drop("_orphan"), rejected.drop("_orphan")


def delete_cascade(child: DataFrame, key: str, deleted: DataFrame) -> DataFrame:
    """Child rows that survive the removal of the parents in ``deleted``."""
    return child.join(deleted.select(key).distinct(), key, "left_anti").select(*child.columns)


def delete_set_null(child: DataFrame, key: str, deleted: DataFrame) -> DataFrame:
    """Child rows with the key blanked where its parent is removed."""
    gone = deleted.select(key).distinct().withColumn("_gone", F.lit(True))
    kept = [F.when(F.col("_gone"), None).otherwise(F.col(c)).alias(c) if c == key else F.col(c)
            for c in child.columns]
    return child.join(gone, key, "left").select(*kept)
