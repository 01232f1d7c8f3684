"""Publish dates from free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import first_match, strip

FULL_DATE, YEAR_ONLY, NO_DATE = 1, 2, 3
MIN_YEAR = 1000

NOT_A_DATE = ("", "none", "nan", "unknown")

MONTHS = ("(?i:(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
          "(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?)")

SLASHED = r"(?<!\d)(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})(?!\d)"
ISO = r"(?<!\d)(\d{4})-(\d{1,2})-(\d{1,2})(?!\d)"
MONTH_DAY_YEAR = rf"\b{MONTHS}\.?\s+(\d{{1,2}})(?:\s*,\s*|\s+)(\d{{4}})(?!\d)"
DAY_MONTH_YEAR = rf"(?<!\d)(\d{{1,2}})\s+{MONTHS}\.?,?\s+(\d{{4}})(?!\d)"
MONTH_YEAR = rf"\b{MONTHS}\.?,?\s+(\d{{4}})(?!\d)"
BARE_YEAR = r"\A(\d{4})\z"
ANY_YEAR = r"\b((?:19|20)\d{2})\b"


def month_number(c: Column) -> Column:
    """``Jan``..``Dec`` to ``'1'``..``'12'``; any other text is null."""
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    position = F.array_position(F.array(*map(F.lit, months)), F.trim(c))
    return F.when(position > 0, position.cast("string"))


def date_text(c: Column) -> Column:
    """Trimmed text with ``27th`` written as ``27``."""
    return F.regexp_replace(strip(c), r"(\d+)(?:st|nd|rd|th)", "$1")


def year_month_day(text: Column, as_of_year: int) -> Column:
    """``yyyy-M-d`` of the first known form in the text; a missing part is 1.

    Two-digit years fall within fifty years of ``as_of_year``.
    """
    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    def month(pattern: str, i: int) -> Column:
        return month_number(F.initcap(group(pattern, i)))

    first, second, slashed_year = (group(SLASHED, i).try_cast("int") for i in (1, 2, 3))
    day_first = first > 12
    in_century = slashed_year + as_of_year // 100 * 100
    two_digits = (F.when(in_century >= as_of_year + 50, in_century - 100)
                  .when(in_century < as_of_year - 50, in_century + 100)
                  .otherwise(in_century))
    full_year = F.when(F.length(group(SLASHED, 3)) == 2, two_digits).otherwise(slashed_year)

    return first_match([
        (text.rlike(SLASHED), F.concat_ws(
            "-", F.lpad(full_year.cast("string"), 4, "0"),
            F.when(day_first, second).otherwise(first), F.when(day_first, first).otherwise(second))),
        (text.rlike(ISO), F.concat_ws("-", group(ISO, 1), group(ISO, 2), group(ISO, 3))),
        (text.rlike(MONTH_DAY_YEAR), F.concat_ws(
            "-", group(MONTH_DAY_YEAR, 3), month(MONTH_DAY_YEAR, 1), group(MONTH_DAY_YEAR, 2))),
        (text.rlike(DAY_MONTH_YEAR), F.concat_ws(
            "-", group(DAY_MONTH_YEAR, 3), month(DAY_MONTH_YEAR, 2), group(DAY_MONTH_YEAR, 1))),
        (text.rlike(MONTH_YEAR), F.concat_ws("-", group(MONTH_YEAR, 2), month(MONTH_YEAR, 1), F.lit("1"))),
        (text.rlike(BARE_YEAR), F.concat(group(BARE_YEAR, 1), F.lit("-1-1"))),
    ], otherwise=F.lit(None).cast("string"))


def date_or_year(text: Column, ymd: Column) -> Column:
    """The date, or 1 January of the first 19xx or 20xx year in the text."""
    year = F.nullif(F.regexp_extract(text, ANY_YEAR, 1), F.lit(""))
    return F.coalesce(F.try_to_date(ymd, "yyyy-M-d"), F.try_to_date(F.concat(year, F.lit("-1-1")), "yyyy-M-d"))


def accepted_date(raw: Column, date: Column, as_of_year: int) -> Column:
    """Null for a placeholder, a year before 1000, or one over two years ahead."""
    in_range = F.year(date).between(MIN_YEAR, as_of_year + 2)
    return F.when(~F.lower(strip(raw)).isin(*NOT_A_DATE) & in_range, date)


def date_quality(raw: Column, parsed: Column) -> Column:
    """1 full date, 2 year only, 3 none."""
    year_only = (F.month(parsed) == 1) & (F.dayofmonth(parsed) == 1) & strip(raw).rlike(r"\A\d{4}\z")
    return F.when(parsed.isNull(), NO_DATE).when(year_only, YEAR_ONLY).otherwise(FULL_DATE)


def normalize_publish_date(df: DataFrame, source: str, target: str, year: str, month: str, day: str,
                           quality: str, as_of_year: int) -> DataFrame:
    """Date, its year, month and day, and how good it is."""
    return (df.withColumn("_text", date_text(F.col(source)))
            .withColumn("_ymd", year_month_day(F.col("_text"), as_of_year))
            .withColumn("_date", date_or_year(F.col("_text"), F.col("_ymd")))
            .withColumn(target, accepted_date(F.col(source), F.col("_date"), as_of_year))
            .withColumns({year: F.year(target), month: F.month(target), day: F.dayofmonth(target),
                          quality: date_quality(F.col(source), F.col(target))})
            .drop("_text", "_ymd", "_date"))
