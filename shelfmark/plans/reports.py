"""Reports over the normalised tables, the star schema and the logs.

Sales reports add up per id before they join names, so the join sees one row
per id and a best-selling author or book is no hot key. Over a store that keeps
sums of its loads they merge those and read no fact rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.names import all_authors
from shelfmark.operators import aggregates, dedup, joins
from shelfmark.operators.filters import holds
from shelfmark.operators.settle import settle
from shelfmark.operators.skew import key_sketch, spread_lookup
from shelfmark.plans.sums import BY_AUTHOR_BOOK, BY_BOOK, BY_FIRST_AUTHOR, sums
from shelfmark.schemas import AUTHOR_SLOTS

Tables = dict[str, DataFrame]


def mean_rating() -> Column:
    """Average over partial sums; exact while it adds decimals."""
    return aggregates.mean_of(F.sum("_rating_sum"), F.sum("_rating_n")).alias("avg_rating")


# Normalised tables

def format_category_counts(sales: DataFrame, t: Tables) -> DataFrame:
    per_isbn = sales.groupBy("isbn13", "nyt_best_selling_category").agg(F.count("*").alias("n"))
    known = (per_isbn.join(t["book_isbn"].select("isbn13", "format_id"), "isbn13", "left")
             .groupBy("format_id", "nyt_best_selling_category").agg(F.sum("n").alias("n")))
    return (known.join(t["format"].select("format_id", "format"), "format_id", "left")
            .groupBy("format", "nyt_best_selling_category").agg(F.sum("n").alias("count"))
            .orderBy(F.asc_nulls_last("format")))


def fact_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("total_records"), F.sum("total_sales").alias("total_units_sold"),
                    F.sum("total_revenue").alias("total_revenue"),
                    F.avg("average_price").cast("decimal(10,2)").alias("avg_price"))


def best_in_person(fact: DataFrame) -> DataFrame:
    return fact.orderBy(F.desc_nulls_first("in_person_sales"), "sales_fact_id").limit(1)


def worst_in_person(fact: DataFrame) -> DataFrame:
    return fact.orderBy(F.asc_nulls_last("in_person_sales"), "sales_fact_id").limit(1)


def book_isbn_profile(book_isbn: DataFrame) -> DataFrame:
    return aggregates.null_profile(
        book_isbn, ["isbn10", "isbn13", "format_id", "edition_id", "publisher_id", "language_id"])


def genre_profile(with_genres: DataFrame) -> DataFrame:
    return aggregates.conditional_counts(
        with_genres, {f"has_genre_{i}": F.col(f"genre_{i}").isNotNull() for i in range(1, 11)})


def contributors(t: Tables) -> DataFrame:
    """Contributors by name; neither the author of all unknown names nor a common role is one task's work."""
    bridge = t["author_isbn"]
    sketch = key_sketch(bridge, ["author_id", "role_id"])
    named = spread_lookup(bridge, t["author"].select("author_id", F.col("full_name").alias("author")), "author_id",
                          "author_isbn_id", sketch, "inner")
    placed = named.join(t["book_isbn"].select("book_isbn_id", "isbn13"), "book_isbn_id")
    return (spread_lookup(placed, t["role"].select("role_id", "role"), "role_id", "author_isbn_id", sketch)
            .select("author_isbn_id", "author", "isbn13", "role"))


def ratings_by_isbn(t: Tables) -> DataFrame:
    types = F.broadcast(t["review_type"].select("review_type_id", "review_type"))
    return (t["isbn_rating"].join(t["book_isbn"].select("book_isbn_id", "isbn13"), "book_isbn_id")
            .join(types, "review_type_id").select("isbn13", "review_type", "count"))


def genres_by_isbn(t: Tables) -> DataFrame:
    return (t["book_isbn_genre"].join(t["book_isbn"].select("book_isbn_id", "isbn13", "isbn10"), "book_isbn_id")
            .join(t["genre"].select("genre_id", "genre"), "genre_id").select("isbn13", "isbn10", "genre")
            .orderBy(F.asc_nulls_last("isbn13"), F.asc_nulls_last("isbn10")))


def series_listing(t: Tables) -> DataFrame:
    return (t["book_isbn"].filter(F.col("series_id").isNotNull())
            .join(t["series"].select("series_id", "series_name"), "series_id", "left")
            .select("isbn13", "series_name", "series_num")
            .orderBy(F.asc_nulls_last("series_name"), F.asc_nulls_last("series_num")))


def titles_with_series(t: Tables) -> DataFrame:
    return (t["book_isbn"].join(t["series"].select("series_id", "series_name"), "series_id", "left")
            .join(t["book"].select("book_id", "title"), "book_id", "left")
            .select("isbn13", "title", "series_name", "series_num").orderBy(F.asc_nulls_last("title")))


def without_series(book_isbn: DataFrame) -> DataFrame:
    return book_isbn.filter(F.col("series_id").isNull())


def box_sets(t: Tables) -> DataFrame:
    """Box sets with each contributor; they are written once, since their hot authors differ from those of all books."""
    sets = settle(t["book_isbn"].filter("is_boxset").select("book_isbn_id", "book_id", "isbn13")
                  .join(t["book"].select("book_id", "title"), "book_id", "left")
                  .join(t["author_isbn"].select("book_isbn_id", "author_id"), "book_isbn_id", "left"), "box-sets")
    authors = t["author"].select("author_id", F.col("full_name").alias("primary_author"))
    return (spread_lookup(sets, authors, "author_id", "book_isbn_id", key_sketch(sets, ["author_id"]))
            .select("isbn13", "title", "primary_author"))


def books_across(t: Tables) -> DataFrame:
    """One row per ISBN with up to five authors side by side."""
    order = Window.partitionBy("book_isbn_id").orderBy("author_isbn_id")
    known = (t["author_isbn"].select("book_isbn_id", "author_isbn_id", "author_id")
             .join(t["author"].select("author_id", "full_name"), "author_id"))
    ranked = known.withColumn("_rank", F.row_number().over(order)).filter("_rank <= 5")
    names = joins.pivot_ranks(ranked, ["book_isbn_id"], "_rank", "full_name", [f"author_{i}" for i in range(1, 6)])
    return (t["book_isbn"].join(t["book"].select("book_id", "title"), "book_id")
            .join(t["series"].select("series_id", "series_name"), "series_id", "left")
            .join(t["format"].select("format_id", "format"), "format_id", "left")
            .join(t["publisher"].select("publisher_id", "publisher"), "publisher_id", "left")
            .join(names, "book_isbn_id", "left")
            .select("title", "series_name", "series_num", *[f"author_{i}" for i in range(1, 6)], "isbn13", "format",
                    "publisher"))


def books_by_author(t: Tables, full_name: str) -> DataFrame:
    return (t["author"].filter(F.col("full_name") == full_name).select("author_id", "full_name")
            .join(t["author_isbn"].select("author_id", "book_isbn_id"), "author_id")
            .join(t["book_isbn"].select("book_isbn_id", "book_id"), "book_isbn_id")
            .join(t["book"].select("book_id", "title"), "book_id").select("full_name", "title"))


# Star schema

def sales_by_first_author(t: Tables) -> DataFrame:
    return (sums(t, BY_FIRST_AUTHOR).join(t["author_dim"].select("author_dim_id", "author_name"), "author_dim_id")
            .groupBy("author_name").agg(F.sum("_units").alias("total_units_sold"), mean_rating())
            .orderBy(F.desc_nulls_first("total_units_sold")))


def publisher_history(book_dim: DataFrame, name_part: str) -> DataFrame:
    return (book_dim.filter(F.col("publisher").like(f"%{name_part}%"))
            .select("publisher", "effective_date", "expire_date").distinct().orderBy("effective_date"))


def top_books(t: Tables, n: int = 20) -> DataFrame:
    """Best sellers over current versions; sales of expired versions drop out."""
    current = t["book_dim"].filter("current_flag").select("book_dim_id", "book_title", "publisher")
    return (sums(t, BY_BOOK, ["book_dim_id"]).join(current, "book_dim_id").groupBy("book_title", "publisher")
            .agg(F.sum("_units").alias("total_units_sold"), F.sum("_revenue").alias("total_revenue"), mean_rating())
            .orderBy(F.desc_nulls_first("total_units_sold"), F.asc_nulls_last("book_title"),
                     F.asc_nulls_last("publisher")).limit(n))


def monthly_trend(t: Tables) -> DataFrame:
    """Units, revenue and books sold per month; books are made distinct per month first."""
    per_month = sums(t, BY_BOOK).groupBy("month_year_dim_id").agg(
        F.sum("_units").alias("total_units"), F.sum("_revenue").alias("revenue"),
        F.count("book_dim_id").alias("unique_books_sold"))
    return (per_month.join(t["month_year_dim"], "month_year_dim_id")
            .select("year", "month", "total_units", "revenue", "unique_books_sold").orderBy("year", "month"))


def top_authors(t: Tables, n: int = 20, more_than: int = 1000) -> DataFrame:
    """Best-selling authors in any slot; an author counts once per fact row.

    The fact shrinks to one row per (author, book) before names are joined.
    """
    named = sums(t, BY_AUTHOR_BOOK).join(t["author_dim"].select("author_dim_id", "author_name"), "author_dim_id")
    books = named.groupBy("author_name", "book_dim_id").agg(
        *[F.sum(c).alias(c) for c in ("_units", "_sales_n", "_rating_sum", "_rating_n")])
    return (books.groupBy("author_name")
            .agg(F.count("book_dim_id").alias("unique_isbns"), F.sum("_units").alias("total_units_sold"),
                 aggregates.mean_of(F.sum("_units"), F.sum("_sales_n")).alias("avg_sales_per_book"), mean_rating())
            .filter(F.col("total_units_sold") > more_than)
            .orderBy(F.desc("total_units_sold"), "author_name").limit(n))


def _author_books(t: Tables, author_name: str, *columns: str) -> DataFrame:
    """Fact rows of current books with the author in any slot."""
    author = t["author_dim"].filter(F.col("author_name") == author_name).select("author_dim_id", "author_name")
    current = t["book_dim"].filter("current_flag").select("book_dim_id", "book_title")
    return (joins.membership_join(t["sales_fact"].select("book_dim_id", *columns, *AUTHOR_SLOTS), author,
                                  AUTHOR_SLOTS, "author_dim_id").join(current, "book_dim_id"))


def author_ratings(t: Tables, author_name: str) -> DataFrame:
    return (_author_books(t, author_name, "avg_rating").groupBy("book_title", "author_name")
            .agg(F.round(F.avg("avg_rating"), 2).alias("avg_rating"))
            .select("book_title", "avg_rating", "author_name").orderBy(F.desc_nulls_first("avg_rating"), "book_title"))


def author_listings(t: Tables, author_name: str) -> DataFrame:
    return (_author_books(t, author_name, "nyt_bestseller_dim_id")
            .join(t["nyt_bestseller_dim"], "nyt_bestseller_dim_id", "left")
            .select("book_title", F.col("listed_as_desc").alias("nyt_award")).orderBy(F.asc_nulls_last("book_title")))


def wide_fact(t: Tables) -> DataFrame:
    """Fact rows with every name written out, authors in slot order; the names of a book's authors are looked up once."""
    names = {slot: f"author_{i}" for i, slot in enumerate(AUTHOR_SLOTS, 1)}
    fact = joins.slots_lookup(t["sales_fact"], "book_dim_id", names, t["author_dim"], "author_dim_id", "author_name")
    return (fact.join(t["book_dim"].select("book_dim_id", "book_title", "publisher", "format", "language"),
                      "book_dim_id", "left")
            .join(t["month_year_dim"], "month_year_dim_id", "left")
            .join(t["nyt_bestseller_dim"], "nyt_bestseller_dim_id", "left")
            .select(all_authors(*names.values()).alias("all_authors"), "book_title", "publisher", "format",
                    "language", "month", "year", "listed_as_desc", *t["sales_fact"].columns))


# Logs and load checks

def etl_log_since(etl_log: DataFrame, day: dt.date) -> DataFrame:
    return etl_log.filter(F.col("run_date") >= F.lit(day)).orderBy(F.desc("run_date"))


def loaded_count(sales: DataFrame, month: int, year: int) -> DataFrame:
    return sales.filter((F.col("month") == month) & (F.col("year") == year) & F.col("loaded_to_warehouse")).agg(
        F.count("*").alias("n"))


def fact_of_month(t: Tables, month: int, year: int) -> DataFrame:
    this_month = t["month_year_dim"].filter((F.col("month") == month) & (F.col("year") == year))
    return t["sales_fact"].join(F.broadcast(this_month), "month_year_dim_id")


def rating_history(log: DataFrame, book_isbn_id: int) -> DataFrame:
    return (log.filter(F.col("book_isbn_id") == book_isbn_id)
            .select("review_type_name", "operation_type", "old_count", "new_count", "log_date").orderBy("log_date"))


def latest_log_rows(log: DataFrame, n: int, *tie_break: str) -> DataFrame:
    return log.orderBy(F.desc("log_date"), *tie_break).limit(n)


def raw_sales_listing(sales: DataFrame, t: Tables) -> DataFrame:
    """Raw sales with title, every contributor and the format; hot authors and formats are spread before sales are joined."""
    books = (t["book_isbn"].select("isbn13", "book_id", "book_isbn_id", "format_id")
             .join(t["book"].select("book_id", "title"), "book_id", "left"))
    formatted = spread_lookup(books, t["format"].select("format_id", "format"), "format_id", "book_isbn_id",
                              key_sketch(t["book_isbn"], ["format_id"]))
    credited = formatted.join(t["author_isbn"].select("book_isbn_id", "author_id"), "book_isbn_id", "left")
    isbns = spread_lookup(credited, t["author"].select("author_id", "full_name"), "author_id", "book_isbn_id",
                          key_sketch(t["author_isbn"], ["author_id"]))
    return sales.join(isbns.select("isbn13", "title", "full_name", "format"), "isbn13", "left")


# Cleaning

def cleaning_report(raw: DataFrame, staging: DataFrame) -> dict[str, DataFrame]:
    """What the cleaning did, one table per section."""
    shapes = raw.agg(F.lit("before").alias("stage"), F.count("*").alias("rows")).unionByName(
        staging.agg(F.lit("after").alias("stage"), F.count("*").alias("rows")))
    contributor_names = ["primary_author", "author_2", "author_3", "author_4", "author_5"]
    return {
        "shapes": shapes,
        "languages_before": dedup.value_counts(raw, "language"),
        "languages_after": dedup.value_counts(staging, "language"),
        "titles": staging.select("title", "title_norm"),
        "authors": staging.select("author", "author_norm", *contributor_names),
        "publish_dates": staging.select("publishDate", "publishDate_norm"),
        "repeated_books": dedup.duplicate_keys(staging, ["book_uid"]),
        "several_editions": staging.filter("has_multiple_editions = 1").select(
            "title", "author_norm", "edition", "has_multiple_editions"),
        "box_sets": staging.filter("is_boxset = 1").select(
            "title", "title_norm", "series", "series_name_norm", "author_norm", "edition", "is_boxset"),
        "series": staging.filter("is_series").select(
            "title", "title_norm", "series", "series_name_norm", "series_num", "author_norm", "edition", "is_series"),
    }


def books_of(df: DataFrame, author_col: str, pattern: str) -> DataFrame:
    """Rows whose author text holds the pattern, which is a regex."""
    return df.filter(holds(F.col(author_col), pattern))


def publish_date_pairs(staging: DataFrame, n: int = 50) -> DataFrame:
    return (staging.groupBy("publishDate_norm", "firstPublishDate_norm").agg(F.count("*").alias("count"))
            .orderBy(F.asc_nulls_last("publishDate_norm"), F.asc_nulls_last("firstPublishDate_norm")).limit(n))


def odd_date_texts(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    return (df.filter(~F.col(col).cast("string").rlike(r"\A\d{4}-\d{2}-\d{2}\z")).select(col).distinct()
            .orderBy(col).limit(n))
