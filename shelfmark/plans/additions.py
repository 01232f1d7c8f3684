"""A further catalogue into filled tables: what is there stays, new rows continue the ids, one switch makes them current."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, functions as F

from shelfmark.functions import names
from shelfmark.operators import changes, joins, keys, sets
from shelfmark.operators.settle import settle, settle_all, side_by_side
from shelfmark.plans import normalise
from shelfmark.plans.constraints import CONSTRAINTS, check_additions
from shelfmark.plans.snapshot import log_rows
from shelfmark.sources.tables import StagedTables, TableStore

#: Tables of one name a row: table, its value, where staging has it.
LOOKUPS = {"language": ("language", "language"), "publisher": ("publisher", "publisher_norm"), "edition": ("edition", "edition_norm"),
           "format": ("format", "bookFormat_norm"), "series": ("series_name", "series_name_norm")}


def fresh_values(values: DataFrame, value: str, id_col: str, existing: DataFrame) -> DataFrame:
    """(id, value) of the values that aren't there yet, by first appearance after the highest id. A null is a value like others."""
    there = existing.select(F.col(value).alias("_there"))
    fresh = sets.distinct_by_appearance(values, value).join(there, F.col(value).eqNullSafe(F.col("_there")), "left_anti")
    fresh = settle(fresh, "fresh")
    return keys.assign_ids(fresh, id_col, ["_seen"], keys.max_id(existing, id_col)).select(id_col, value)


def lookup_values(staging: DataFrame, table: str, pos: str) -> DataFrame:
    """(value, _seen) that a lookup table takes from staging; only a language may be null."""
    value, column = LOOKUPS[table]
    present = F.trim(F.col(column)) != ""
    if table == "language":
        present = present | F.col(column).isNull()
    return staging.filter(present).select(F.col(column).alias(value), F.col(pos).cast("bigint").alias("_seen"))


def first_contributors(stored: dict[str, DataFrame]) -> DataFrame:
    """(book_isbn_id, full_name) of each ISBN's first contributor: ids ascend by author slot."""
    first = stored["author_isbn"].groupBy("book_isbn_id").agg(F.min_by("author_id", "author_isbn_id").alias("author_id"))
    return first.join(stored["author"].select("author_id", "full_name"), "author_id").select("book_isbn_id", "full_name")


def match_books(staging: DataFrame, stored: dict[str, DataFrame], known: DataFrame, pos: str) -> DataFrame:
    """(book_uid, book_id) for every book of the staging rows.

    A book is the stored one that has one of its ISBNs, by the links ``known``;
    else one with the same title and first contributor; else it is new, and new
    ids continue by first appearance. Of several stored books the smallest id
    is taken, before they are looked up: however many books share a title and
    a contributor, a name meets one row.
    """
    rows = staging.select(pos, F.col("book_uid").alias("_uid"), F.col("title_norm").alias("_title"),
                          normalise.blank_to_null(F.col("primary_author_name")).alias("_author"))
    by_isbn = known.join(rows.select(pos, "_uid"), pos).select("_uid", "book_id", F.lit(0).alias("_rank"))
    named = (stored["book_isbn"].select("book_isbn_id", "book_id").join(stored["book"].select("book_id", "title"), "book_id")
             .join(first_contributors(stored), "book_isbn_id", "left").groupBy("title", "full_name").agg(F.min("book_id").alias("book_id")))
    same = F.col("_title").eqNullSafe(F.col("title")) & F.col("_author").eqNullSafe(F.col("full_name"))
    by_name = (rows.select("_uid", "_title", "_author").distinct().join(named, same)
               .select("_uid", "book_id", F.lit(1).alias("_rank")))
    found = by_isbn.unionByName(by_name).groupBy("_uid").agg(F.min(F.struct("_rank", "book_id")).alias("_match"))
    books = rows.groupBy("_uid").agg(F.min(pos).alias("_first")).join(found, "_uid", "left")
    books = settle(books.select("_uid", "_first", F.col("_match.book_id").alias("book_id")), "books")
    new = keys.assign_ids(books.filter("book_id IS NULL").drop("book_id"), "book_id", ["_first"], keys.max_id(stored["book"], "book_id"))
    known = books.filter("book_id IS NOT NULL").select("_uid", "book_id")
    return known.unionByName(new.select("_uid", "book_id")).withColumnRenamed("_uid", "book_uid")


def additions(staging: DataFrame, stored: dict[str, DataFrame], pos: str = "_src_pos") -> dict[str, DataFrame]:
    """The rows a further load adds to each table, with ids after the highest in use. Rows that are there stay as they are.

    Lookups match by their value, ISBN rows by either ISBN, contributors,
    ratings and genres by the columns that make them unique. An ISBN that is
    there takes further contributors, ratings and genres, but keeps its own row
    and the counts it has.
    """
    # Cleaned rows are read many times here.
    staging = settle(normalise.blanks_to_null(staging), "staging")

    def lookup(name: str) -> DataFrame:
        return fresh_values(lookup_values(staging, name, pos), LOOKUPS[name][0], f"{name}_id", stored[name])

    def author() -> DataFrame:
        seen = sets.slot_values(staging, normalise.AUTHOR_COLUMNS, "full_name", pos).filter(F.col("full_name") != "")
        return fresh_values(seen, "full_name", "author_id", stored["author"]).withColumns(names.person_name_parts(F.col("full_name"), letters_only=True))

    def role() -> DataFrame:
        return fresh_values(sets.slot_values(staging, normalise.ROLE_COLUMNS, "role", pos), "role", "role_id", stored["role"])

    def genre() -> DataFrame:
        return fresh_values(sets.slot_array_values(staging, normalise.first_genres(), "genre", pos), "genre", "genre_id", stored["genre"])

    def known_links() -> DataFrame:
        return normalise.link_isbn(staging, stored["book_isbn"], pos, "book_id")

    made = {"author": author, "genre": genre, "role": role, **{name: partial(lookup, name) for name in LOOKUPS}, "known": known_links}
    new = settle_all(made)
    known = new.pop("known")

    def whole(name: str, *columns: str) -> DataFrame:
        return stored[name].select(*columns).unionByName(new[name].select(*columns))

    uids = settle(match_books(staging, stored, known, pos), "book-ids").withColumnsRenamed({"book_uid": "_uid", "book_id": "book_uid"})

    def with_ids(rows: DataFrame) -> DataFrame:
        return rows.withColumnRenamed("book_uid", "_uid").join(uids, "_uid", "left").drop("_uid")

    titled = with_ids(staging.select(pos, "book_uid", "title_norm"))
    books = normalise.build_book(titled.filter("book_uid IS NOT NULL"), pos)
    new["book"] = joins.missing_rows(books, stored["book"], ["book_id"])

    lookups = {value: whole(name, f"{name}_id", value) for name, (value, _) in LOOKUPS.items()}
    unknown = with_ids(staging.join(known.select(pos).distinct(), pos, "left_anti"))
    new["book_isbn"] = settle(normalise.build_book_isbn(unknown, lookups, pos, keys.max_id(stored["book_isbn"], "book_isbn_id")), "book_isbn")

    link = settle(known.select(pos, "book_isbn_id").unionByName(normalise.link_isbn(staging, new["book_isbn"], pos)), "link")
    authors, roles = whole("author", "author_id", "full_name"), whole("role", "role_id", "role")
    new["author_isbn"] = normalise.number_contributors(
        normalise.contributors(staging, link, authors, roles, pos, stored["author_isbn"]), keys.max_id(stored["author_isbn"], "author_isbn_id"))
    new["isbn_rating"] = normalise.number_ratings(
        normalise.ratings(staging, link, pos, stored["isbn_rating"]), keys.max_id(stored["isbn_rating"], "isbn_rating_id"))
    pairs = normalise.genre_pairs(staging, link, whole("genre", "genre_id", "genre"), pos, stored["book_isbn_genre"])
    new["book_isbn_genre"] = normalise.number_genre_pairs(pairs, keys.max_id(stored["book_isbn_genre"], "book_isbn_genre_id"))
    return new


def as_inserted(rows: DataFrame, key: str) -> DataFrame:
    """New rows as changes, the form the audit tables take."""
    compared = F.struct(*[c for c in rows.columns if c != "updated_at"])
    return rows.select(key, F.lit(changes.INSERT).alias("operation"), F.when(F.lit(False), compared).alias("old"), compared.alias("new"))


def add_catalogue(store: TableStore, staging: DataFrame, run_ts: dt.datetime, pos: str = "_src_pos") -> None:
    """Load a further cleaned catalogue into the stored tables.

    Only new rows are checked, against each other and the stored keys; one that
    breaks a rule raises and changes nothing. New rows, stamped with the run,
    and their audit rows become current in one switch. No stored file is
    rewritten, also in tables kept in ranges of keys. A catalogue loaded twice adds nothing the second time.
    """
    staged = StagedTables(store)
    stored = {name: store.read(name) for name in normalise.TABLE_NAMES}
    made = additions(staging, stored, pos)

    def add(name: str) -> DataFrame | None:
        return staged.add(name, made[name].withColumn("updated_at", F.lit(run_ts)).select(*stored[name].columns), CONSTRAINTS[name].key)

    new = {name: rows for name, rows in side_by_side({name: partial(add, name) for name in made}).items() if rows is not None}
    if new:
        check_additions(new, stored, run_ts.date(), strict=True)
    logs = {name: log_rows(name, as_inserted(rows, f"{name}_id"), stored["review_type"], run_ts) for name, rows in new.items()}
    side_by_side({name: partial(staged.append, *logged) for name, logged in logs.items() if logged is not None})
    staged.commit()
