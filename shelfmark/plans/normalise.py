"""Staging table to 14 keyed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.functions import genres, names
from shelfmark.functions.numbers import STARS
from shelfmark.functions.text import blank_to_null
from shelfmark.operators import dedup, joins, keys, sets
from shelfmark.operators.settle import settle, settle_all
from shelfmark.plans.constraints import check_tables
from shelfmark.schemas import REVIEW_TYPES

AUTHOR_COLUMNS = ["primary_author_name", "author_2", "author_3", "author_4", "author_5"]
ROLE_COLUMNS = [f"author_{i}_role" for i in range(1, 6)]
TABLE_NAMES = ["author", "language", "genre", "role", "publisher", "edition", "format", "series", "book", "review_type",
               "book_isbn", "author_isbn", "isbn_rating", "book_isbn_genre"]
BLANK_AS_NULL = ["isbn10", "isbn13", "title_norm", *ROLE_COLUMNS, "language", "series_name_norm",
                 "description_norm", "edition_norm"]


def blanks_to_null(staging: DataFrame) -> DataFrame:
    return staging.withColumns({c: blank_to_null(F.col(c)) for c in BLANK_AS_NULL if c in staging.columns})


def new_ids(values: DataFrame, value: str, id_col: str, existing: DataFrame | None) -> DataFrame:
    """Existing rows plus new values, numbered by first appearance.

    ``values`` holds (value, _seen). Ids in use stay as they are.
    """
    fresh = sets.distinct_by_appearance(values, value)
    if existing is None:
        return keys.assign_ids(fresh, id_col, ["_seen"]).select(id_col, value)
    fresh = joins.missing_rows(fresh, existing, [value])
    numbered = keys.assign_ids(fresh, id_col, ["_seen"], start_after=keys.max_id(existing, id_col))
    return existing.select(id_col, value).unionByName(numbered.select(id_col, value))


def build_lookup(staging: DataFrame, col: str, value: str, id_col: str, existing: DataFrame | None = None,
                 keep_null: bool = False, pos: str = "_src_pos") -> DataFrame:
    """Keyed distinct values of one column, blanks left out.

    ``keep_null`` adds a null value as a row of its own if the column has one.
    """
    text = F.col(col)
    present = staging.filter(F.trim(text) != "")
    if keep_null:
        present = staging.filter(text.isNull() | (F.trim(text) != ""))
    seen = present.select(text.alias(value), F.col(pos).cast("bigint").alias("_seen"))
    return new_ids(seen, value, id_col, existing)


def build_author(staging: DataFrame, existing: DataFrame | None = None, pos: str = "_src_pos") -> DataFrame:
    """Distinct names over the five author columns, split into their parts."""
    seen = sets.slot_values(staging, AUTHOR_COLUMNS, "full_name", pos).filter(F.col("full_name") != "")
    authors = new_ids(seen, "full_name", "author_id", existing)
    return authors.withColumns(names.person_name_parts(F.col("full_name"), letters_only=True))


def build_role(staging: DataFrame, existing: DataFrame | None = None, pos: str = "_src_pos") -> DataFrame:
    return new_ids(sets.slot_values(staging, ROLE_COLUMNS, "role", pos), "role", "role_id", existing)


def first_genres() -> Column:
    return F.slice(genres.genre_slots(F.col("genres_norm")), 1, genres.MAX_GENRES)


def build_genre(staging: DataFrame, existing: DataFrame | None = None, pos: str = "_src_pos") -> DataFrame:
    return new_ids(sets.slot_array_values(staging, first_genres(), "genre", pos), "genre", "genre_id", existing)


def build_book(staging: DataFrame, pos: str = "_src_pos") -> DataFrame:
    """One title per book, the earliest row's; the book id is the staging uid."""
    return dedup.first_value_per_key(
        staging.select(F.col("book_uid").alias("book_id"), F.col("title_norm").alias("title"), pos),
        "book_id", "title", pos)


def build_review_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVIEW_TYPES, "review_type_id bigint, review_type string")


def build_book_isbn(staging: DataFrame, lookups: dict[str, DataFrame], pos: str = "_src_pos", start_after: int = 0) -> DataFrame:
    """One row per staging row with an ISBN, lookup ids, dates, series and pages."""
    rows = staging.filter(F.col("isbn10").isNotNull() | F.col("isbn13").isNotNull()).select(
        pos, "isbn10", "isbn13", F.col("book_uid").alias("book_id"),
        F.col("bookFormat_norm").alias("format"), F.col("edition_norm").alias("edition"),
        F.col("publisher_norm").alias("publisher"), "language", (F.col("is_boxset") == 1).alias("is_boxset"),
        F.col("publishDate_norm").alias("publish_date"),
        F.col("firstPublishDate_norm").alias("original_publish_date"),
        F.col("series_name_norm").alias("series_name"),
        F.when(F.col("series_name_norm").isNotNull(), F.col("series_num").cast("decimal(10,2)")).alias("series_num"),
        F.col("pages_norm").alias("pages"))
    for value, lookup in lookups.items():
        rows = rows.join(lookup, value, "left")
    # Numbering reads its rows twice, so the joins are written first.
    return keys.assign_ids(settle(rows, "isbn-rows"), "book_isbn_id", [pos], start_after).select(
        "book_isbn_id", "isbn10", "isbn13", "book_id", "format_id", "edition_id", "publisher_id", "language_id",
        F.coalesce("is_boxset", F.lit(False)).alias("is_boxset"), "publish_date", "original_publish_date",
        "series_id", "series_num", "pages")


def link_isbn(staging: DataFrame, book_isbn: DataFrame, pos: str = "_src_pos", *also: str) -> DataFrame:
    """(row position, book_isbn_id) where either ISBN is the same, and further columns of the ISBN's row."""
    sides = staging.select(pos, F.col("isbn10").alias("_s10"), F.col("isbn13").alias("_s13"))
    isbns = book_isbn.select("book_isbn_id", "isbn10", "isbn13", *also)
    return joins.either_key_join(sides, isbns, [("_s10", "isbn10"), ("_s13", "isbn13")]).select(pos, "book_isbn_id", *also)


def linked(staging: DataFrame, link: DataFrame, pos: str = "_src_pos") -> DataFrame:
    return staging.join(link, pos)


def marked_there(rows: DataFrame, stored: DataFrame | None, columns: list[str]) -> DataFrame:
    """The rows, and the keys of stored ones beside them: a grouping by the columns then tells which are there, a null like others."""
    rows = rows.withColumn("_there", F.lit(False))
    return rows if stored is None else rows.unionByName(stored.select(*columns, F.lit(True).alias("_there")), allowMissingColumns=True)


def grouped_new(rows: DataFrame, stored: DataFrame | None, columns: list[str], *aggregates: Column) -> DataFrame:
    """Rows grouped by the columns, without the groups that are stored: one shuffle for both."""
    grouped = marked_there(rows, stored, columns).groupBy(*columns).agg(*aggregates, F.max("_there").alias("_there"))
    return grouped.filter(~F.col("_there")).drop("_there")


def contributors(staging: DataFrame, link: DataFrame, author: DataFrame, role: DataFrame, pos: str = "_src_pos",
                 stored: DataFrame | None = None) -> DataFrame:
    """(book_isbn_id, author_id, role_id, _slot) of each contributor that isn't stored.

    Equal rows within a slot are one; over slots a repeated author is dropped
    only where the role is known, since a null role never equals another. The
    slots of an author and role are bits of one number.
    """
    people = F.array(*[F.struct(F.lit(slot).alias("_slot"), F.col(name).alias("full_name"), F.col(role_col).alias("role"))
                       for slot, (name, role_col) in enumerate(zip(AUTHOR_COLUMNS, ROLE_COLUMNS), 1)])
    long = (linked(staging, link, pos).select("book_isbn_id", F.inline(people))
            .filter(F.col("full_name").isNotNull()))
    long = (long.join(author.select("full_name", "author_id"), "full_name")
            .join(role.select("role", "role_id"), "role", "left"))
    bits = long.select("book_isbn_id", "author_id", "role_id", F.expr("shiftleft(1, _slot)").alias("_bit"))
    grouped = grouped_new(bits, stored, ["book_isbn_id", "author_id", "role_id"], F.bit_or("_bit").alias("_bits"))
    slots = F.array_compact(F.array(*[F.when(F.col("_bits").bitwiseAND(1 << slot) != 0, F.lit(slot))
                                      for slot in range(1, len(AUTHOR_COLUMNS) + 1)]))
    kept = F.when(F.col("role_id").isNull(), slots).otherwise(F.slice(slots, 1, 1))
    return grouped.select("book_isbn_id", "author_id", "role_id", F.explode(kept).alias("_slot"))


def numbered(rows: DataFrame, id_col: str, rank: str, name: str, then: list[str], start_after: int) -> DataFrame:
    """Ids in order of a small rank, then ISBN, then further columns."""
    order = F.shiftleft(F.col(rank).cast("bigint"), 56) + F.col("book_isbn_id")
    return keys.assign_ids(settle(rows.withColumn("_order", order), name), id_col, ["_order", *then], start_after, merged=True)


def number_contributors(rows: DataFrame, start_after: int = 0) -> DataFrame:
    return numbered(rows, "author_isbn_id", "_slot", "contributors", ["author_id", "role_id"], start_after).select(
        "author_isbn_id", "book_isbn_id", "author_id", "role_id")


def build_author_isbn(staging: DataFrame, link: DataFrame, author: DataFrame, role: DataFrame,
                      pos: str = "_src_pos") -> DataFrame:
    """Contributors per ISBN; ids ascend by author slot."""
    return number_contributors(contributors(staging, link, author, role, pos))


def ratings(staging: DataFrame, link: DataFrame, pos: str = "_src_pos", stored: DataFrame | None = None) -> DataFrame:
    """(book_isbn_id, review_type_id, count) that aren't stored: star counts as rows, null counts left out.

    Counts of an ISBN are grouped side by side and become rows only then; the
    types it has in store are bits of one number.
    """
    types = dict(enumerate(STARS, 1))
    rows = linked(staging, link, pos).select("book_isbn_id", *STARS, F.lit(0).alias("_stored"))
    if stored is not None:
        bit = F.coalesce(*[F.when(F.col("review_type_id") == i, F.lit(1 << i)) for i in types], F.lit(0))
        rows = rows.unionByName(stored.select("book_isbn_id", bit.alias("_stored")), allowMissingColumns=True)
    wide = rows.groupBy("book_isbn_id").agg(*[F.max(star).cast("int").alias(star) for star in STARS], F.bit_or("_stored").alias("_stored"))
    new = wide.select("book_isbn_id", *[F.when(F.col("_stored").bitwiseAND(1 << i) == 0, F.col(star)).alias(star) for i, star in types.items()])
    return joins.unpivot(new, ["book_isbn_id"], {star: F.lit(i).cast("bigint") for i, star in types.items()}, "review_type_id", "count")


def number_ratings(rows: DataFrame, start_after: int = 0) -> DataFrame:
    return numbered(rows, "isbn_rating_id", "review_type_id", "ratings", [], start_after).select(
        "isbn_rating_id", "book_isbn_id", "review_type_id", "count")


def build_isbn_rating(staging: DataFrame, link: DataFrame, pos: str = "_src_pos") -> DataFrame:
    """Star counts per ISBN; ids ascend by review type."""
    return number_ratings(ratings(staging, link, pos))


def genre_pairs(staging: DataFrame, link: DataFrame, genre: DataFrame, pos: str = "_src_pos",
                stored: DataFrame | None = None) -> DataFrame:
    """(book_isbn_id, genre_id, _slot): distinct pairs that aren't stored, with the genre's first place in the list."""
    long = (linked(staging, link, pos).select("book_isbn_id", F.posexplode(first_genres()).alias("_slot", "genre"))
            .filter(F.col("genre").isNotNull()))
    return grouped_new(long.join(genre.select("genre", "genre_id"), "genre").select("book_isbn_id", "genre_id", "_slot"), stored,
                       ["book_isbn_id", "genre_id"], F.min("_slot").alias("_slot"))


def number_genre_pairs(rows: DataFrame, start_after: int = 0) -> DataFrame:
    return numbered(rows, "book_isbn_genre_id", "_slot", "genres", ["genre_id"], start_after).select(
        "book_isbn_genre_id", "book_isbn_id", "genre_id")


def build_book_isbn_genre(staging: DataFrame, link: DataFrame, genre: DataFrame, pos: str = "_src_pos") -> DataFrame:
    """Distinct (ISBN, genre) pairs; ids ascend by the genre's place in the list."""
    return number_genre_pairs(genre_pairs(staging, link, genre, pos))


def add_updated_at(tables: dict[str, DataFrame], run_ts: dt.datetime) -> dict[str, DataFrame]:
    return {name: df.withColumn("updated_at", F.lit(run_ts)) for name, df in tables.items()}


def normalise(staging: DataFrame, run_ts: dt.datetime, pos: str = "_src_pos", strict: bool = False) -> dict[str, DataFrame]:
    """All 14 tables with ``updated_at``, for a first load.

    Tables other tables read are written once, side by side; the bridges stay lazy. With
    ``strict`` all of them are checked, and a row that breaks a rule raises.
    """
    staging = blanks_to_null(staging)
    made = {
        "author": lambda: build_author(staging, pos=pos),
        "language": lambda: build_lookup(staging, "language", "language", "language_id", keep_null=True, pos=pos),
        "genre": lambda: build_genre(staging, pos=pos),
        "role": lambda: build_role(staging, pos=pos),
        "publisher": lambda: build_lookup(staging, "publisher_norm", "publisher", "publisher_id", pos=pos),
        "edition": lambda: build_lookup(staging, "edition_norm", "edition", "edition_id", pos=pos),
        "format": lambda: build_lookup(staging, "bookFormat_norm", "format", "format_id", pos=pos),
        "series": lambda: build_lookup(staging, "series_name_norm", "series_name", "series_id", pos=pos),
    }
    tables = settle_all(made) | {"book": build_book(staging, pos), "review_type": build_review_type(staging.sparkSession)}
    values = {"format": "format", "edition": "edition", "publisher": "publisher", "language": "language",
              "series_name": "series"}
    lookups = {value: tables[table] for value, table in values.items()}
    book_isbn = settle(build_book_isbn(staging, lookups, pos), "book_isbn")
    link = settle(link_isbn(staging, book_isbn, pos), "link")
    tables["book_isbn"] = book_isbn
    tables["author_isbn"] = build_author_isbn(staging, link, tables["author"], tables["role"], pos)
    tables["isbn_rating"] = build_isbn_rating(staging, link, pos)
    tables["book_isbn_genre"] = build_book_isbn_genre(staging, link, tables["genre"], pos)
    if strict:
        # Checks read a table once for each key rule.
        tables |= {name: settle(tables[name], name) for name in ("book", "author_isbn", "isbn_rating", "book_isbn_genre")}
        check_tables(tables, run_ts.date(), strict=True)
    return add_updated_at(tables, run_ts)
