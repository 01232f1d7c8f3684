"""Raw catalogue to staging table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions import dates, editions, formats, genres, isbn, names, numbers, publishers, roles, series, text
from shelfmark.operators import dedup, filters, keys
from shelfmark.operators.settle import settle

# Rows with an ISBN-10 come before all others in the book order.
ISBN13_ROWS_LAST = 1 << 56


def choose_rows(raw: DataFrame) -> DataFrame:
    """All row filters and duplicate removal, with ``_pos`` as the new row order.

    A raw ISBN is of one kind, so the duplicate removal by ISBN-13 and the one
    by ISBN-10 are one by whichever is set. The publisher filter must follow
    it: a later copy must not move up when the first one is dropped.
    """
    isbn10, isbn13 = isbn.split_isbn(F.col("isbn"))
    rows = filters.ascii_titles(filters.english_only(raw)).withColumns({"isbn10": isbn10, "isbn13": isbn13})
    rows = filters.require_isbn(filters.drop_fake_isbn13(rows))
    rows = rows.withColumn("_isbn", F.coalesce("isbn10", "isbn13"))
    rows = filters.latin_publishers(dedup.first_per_key(rows, ["_isbn"], ["_src_pos"]).drop("_isbn"))
    order = F.col("_src_pos") + F.when(F.col("isbn10").isNull(), F.lit(ISBN13_ROWS_LAST)).otherwise(F.lit(0))
    return dedup.first_per_key(rows.withColumn("_pos", order), ["bookId"], ["_pos"])


def clean_authors(df: DataFrame, paren_aware: bool = False) -> DataFrame:
    return (
        df.withColumn("author", names.normalize_author_text(F.col("author"), paren_aware))
        .withColumn("author_norm", names.author_norm(F.col("author")))
        .withColumn("primary_author", names.primary_author(F.col("author_norm")))
        .withColumn("primary_author_name", names.primary_author_name(F.col("primary_author")))
        .withColumn("author_roles_norm", roles.normalize_author_roles(F.col("author_norm"), paren_aware))
        .transform(roles.contributor_columns, paren_aware=paren_aware)
        .withColumns({f"author_{i}": roles.clear_junk(F.col(f"author_{i}")) for i in range(2, 6)})
    )


def clean_titles(df: DataFrame) -> DataFrame:
    series_name, series_num = series.parse_series(F.col("series"))
    return (
        df.withColumns({"title_norm": text.normalize_text(F.col("title")),
                        "series_name_norm": series_name, "series_num": series_num})
        .withColumns({"is_series": series.is_part_of_series(F.col("series_name_norm")),
                      "is_boxset": series.boxset_flag(F.col("series")),
                      "description_norm": text.clean_description(F.col("description"))})
    )


PUBLISH_DATE = ["publishDate_norm", "publish_year", "publish_month", "publish_day", "publish_date_quality"]
FIRST_PUBLISH_DATE = ["firstPublishDate_norm", "first_publish_year", "first_publish_month", "first_publish_day",
                      "first_publish_quality"]


def clean_publication(df: DataFrame, as_of_year: int) -> DataFrame:
    return (df.transform(publishers.normalize_publisher).transform(formats.normalize_book_format)
            .transform(editions.normalize_edition)
            .transform(dates.normalize_publish_date, "publishDate", *PUBLISH_DATE, as_of_year=as_of_year)
            .transform(dates.normalize_publish_date, "firstPublishDate", *FIRST_PUBLISH_DATE, as_of_year=as_of_year))


def clean_measures(df: DataFrame) -> DataFrame:
    return (
        df.withColumns({"genres": genres.parse_genres(F.col("genres")),
                        "numRatings_norm": F.col("numRatings"),
                        "pages_norm": numbers.first_number(F.col("pages"))})
        .transform(genres.normalize_genres)
        .transform(numbers.normalize_ratings_by_stars)
    )


def clean_columns(rows: DataFrame, as_of_year: int, paren_aware: bool = False) -> DataFrame:
    """Every cleaned column; no shuffle of the rows."""
    return (rows.transform(clean_authors, paren_aware).transform(clean_titles)
            .transform(clean_publication, as_of_year).transform(clean_measures))


def run_cleaning(raw: DataFrame, as_of_year: int, paren_aware: bool = False) -> DataFrame:
    """Staging table of a raw catalogue with ``_src_pos``.

    Two shuffles choose the rows. The cleaned rows are written once; the
    identifiers then read only their key columns from that table.
    """
    cleaned = settle(clean_columns(choose_rows(raw), as_of_year, paren_aware), "cleaned")
    return cleaned.transform(keys.book_identifier).transform(keys.series_identifier)
