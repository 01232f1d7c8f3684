"""Sums of the sales fact by month, kept beside it.

Each load adds the sums of its own rows, in the switch that adds the rows. All
measures add up, so reports merge what the loads have left and read no fact
rows, neither of the first load nor of closed months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators.joins import membership_rows
from shelfmark.schemas import AUTHOR_SLOTS

BY_FIRST_AUTHOR, BY_BOOK, BY_AUTHOR_BOOK = "sums_by_first_author", "sums_by_book", "sums_by_author_book"
#: What the rows of each table of sums stand for. An author counts once per fact row, whatever slots hold it.
KEYS = {
    BY_FIRST_AUTHOR: ["author_dim_id"],
    BY_BOOK: ["month_year_dim_id", "book_dim_id"],
    BY_AUTHOR_BOOK: ["author_dim_id", "book_dim_id"],
}
# Name of each measure, and what it adds up of which column.
MEASURES = {
    "_units": (F.sum, "total_sales"), "_sales_n": (F.count, "total_sales"), "_revenue": (F.sum, "total_revenue"),
    "_rating_sum": (F.sum, "avg_rating"), "_rating_n": (F.count, "avg_rating"),
}


def sums_of(fact: DataFrame, table: str, keys: list[str] | None = None) -> DataFrame:
    """One row per key of a table of sums, from fact rows.

    Fact rows of a book with the same authors add up before each of the authors
    gets them, so a fact row is shuffled once, not once for each author.
    """
    wanted = keys or KEYS[table]
    if table == BY_FIRST_AUTHOR:
        fact = fact.withColumn("author_dim_id", F.col(AUTHOR_SLOTS[0]))
    grouped = ["book_dim_id", *AUTHOR_SLOTS] if table == BY_AUTHOR_BOOK else wanted
    added = fact.groupBy(*grouped).agg(*[add(column).alias(name) for name, (add, column) in MEASURES.items()])
    if table != BY_AUTHOR_BOOK:
        return added
    kinds = dict(added.dtypes)
    return membership_rows(added, AUTHOR_SLOTS, "author_dim_id").groupBy(*wanted).agg(
        *[F.sum(name).cast(kinds[name]).alias(name) for name in MEASURES])


def sums(t: dict[str, DataFrame], table: str, keys: list[str] | None = None) -> DataFrame:
    """One row per key (some of the table's keys, or all): merged from the stored sums, or from the fact where none are kept."""
    if table not in t:
        return sums_of(t["sales_fact"], table, keys)
    return t[table].groupBy(*(keys or KEYS[table])).agg(*[F.sum(name).alias(name) for name in MEASURES])
