"""Star schema: first load, incremental dimension updates, monthly fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.functions.dates import month_number
from shelfmark.functions.formats import bestseller_category
from shelfmark.functions.numbers import strip_currency
from shelfmark.operators import joins, keys
from shelfmark.operators.checks import RejectedRows, check_not_null
from shelfmark.operators.dedup import first_per_key
from shelfmark.operators.settle import settle
from shelfmark.schemas import AUTHOR_SLOTS, BOOK_DIM, COUNT_MEASURES, ETL_LOG, MEASURES, MONEY_MEASURES, SALES_STAGING, SALES_TYPES

SALES_KEY = ["isbn13", "month", "year"]


# Sales staging

def sales_details(sales: DataFrame, oltp: dict[str, DataFrame]) -> DataFrame:
    """(isbn13, title, full_name, format): the first contributor of each ISBN sold.

    Only ISBNs with sales are looked up, each once.
    """
    sold = sales.select("isbn13").distinct()
    isbns = sold.join(oltp["book_isbn"].select("isbn13", "book_isbn_id", "book_id", "format_id"), "isbn13")
    first_author = (oltp["author_isbn"].groupBy("book_isbn_id")
                    .agg(F.min_by("author_id", "author_isbn_id").alias("author_id")))
    titled = (isbns.join(oltp["book"].select("book_id", "title"), "book_id", "left")
              .join(first_author, "book_isbn_id", "left"))
    return (titled.join(oltp["author"].select("author_id", "full_name"), "author_id", "left")
            .join(oltp["format"].select("format_id", "format"), "format_id", "left")
            .select("isbn13", "title", "full_name", "format"))


def clean_sales(raw: DataFrame, oltp: dict[str, DataFrame]) -> DataFrame:
    """Month names to numbers, money to decimals, title, author and category added.

    Takes raw text only: a month that is a number already becomes null. Sales
    of an unknown ISBN get no title and no category.
    """
    typed = raw.withColumns(
        {"month": month_number(F.col("month")).cast("int"),
         "year": F.nullif(F.trim("year"), F.lit("")).cast("int")}
        | {c: F.trim(c).cast("int") for c in COUNT_MEASURES}
        | {c: strip_currency(F.col(c)) for c in MONEY_MEASURES})
    known = sales_details(raw, oltp).withColumn("nyt_best_selling_category", bestseller_category(F.col("format")))
    return typed.join(known.drop("format"), "isbn13", "left")


def duplicate_sales(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Incoming keys that repeat among themselves or are there already."""
    keyed = incoming.dropna(subset=SALES_KEY).select(SALES_KEY)
    repeated = keyed.groupBy(SALES_KEY).agg(F.count("*").alias("_n")).filter("_n > 1").select(SALES_KEY)
    if existing is None:
        return repeated
    return repeated.union(keyed.join(existing.select(SALES_KEY), SALES_KEY, "left_semi")).distinct()


def not_loaded(sales: DataFrame) -> DataFrame:
    """Rows the warehouse does not have yet.

    The test reaches the Parquet scan, which skips row groups that are loaded
    throughout by their statistics.
    """
    return sales.filter(~F.col("loaded_to_warehouse"))


def append_sales(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Existing rows plus incoming ones marked as not loaded; a repeated key is an error."""
    check_not_null(incoming, ["month", "year"], strict=True)
    clash = duplicate_sales(existing, incoming).first()
    if clash is not None:
        raise RejectedRows(f"duplicate key ({', '.join(SALES_KEY)}): {tuple(clash)}")
    fresh = incoming.drop("loaded_to_warehouse").withColumn("loaded_to_warehouse", F.lit(False)).select(
        [F.col(c).cast(kind).alias(c) for c, kind in SALES_TYPES.items()])
    return fresh if existing is None else existing.select(SALES_STAGING).unionByName(fresh)


def backfill_sales(star: dict[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """Sales staging rows out of the fact, marked as loaded; keys already staged are kept."""
    rows = (star["sales_fact"]
            .join(star["book_dim"].select("book_dim_id", F.col("isbn_13").alias("isbn13")), "book_dim_id")
            .join(star["month_year_dim"], "month_year_dim_id")
            .join(star["nyt_bestseller_dim"], "nyt_bestseller_dim_id", "left")
            .withColumn("nyt_best_selling_category", F.col("listed_as_desc"))
            .withColumn("loaded_to_warehouse", F.lit(True)))
    keyless = rows.filter(F.col("isbn13").isNull()).select(SALES_STAGING)
    one_each = first_per_key(rows.filter(F.col("isbn13").isNotNull()), SALES_KEY, ["sales_fact_id"]).select(SALES_STAGING)
    if existing is not None:
        one_each = joins.missing_rows(one_each, existing, SALES_KEY).select(SALES_STAGING)
    return one_each.unionByName(keyless)


# Dimensions

def month_order() -> Column:
    return F.col("year") * 12 + F.col("month")


def init_month_year_dim(sales: DataFrame) -> DataFrame:
    months = sales.dropna(subset=["month", "year"]).select("month", "year").distinct()
    return keys.assign_ids(months.withColumn("_order", month_order()), "month_year_dim_id", ["_order"]).select(
        "month_year_dim_id", "month", "year")


def new_months(dim: DataFrame, sales: DataFrame) -> DataFrame:
    """Rows for the months of all sales not loaded yet, whatever month is being loaded."""
    months = not_loaded(sales).select("month", "year").distinct()
    fresh = joins.missing_rows(months, dim, ["month", "year"]).withColumn("_order", month_order())
    numbered = keys.assign_ids(fresh, "month_year_dim_id", ["_order"], keys.max_id(dim, "month_year_dim_id"))
    return numbered.select(dim.columns)


def update_month_year_dim(dim: DataFrame, sales: DataFrame) -> DataFrame:
    return dim.unionByName(new_months(dim, sales))


def init_author_dim(author: DataFrame) -> DataFrame:
    named = author.select("author_id", F.col("full_name").alias("author_name"))
    return keys.assign_ids(named, "author_dim_id", ["author_id"]).select("author_dim_id", "author_id", "author_name")


def changed_since(df: DataFrame, last_run: dt.datetime | None) -> DataFrame:
    """Rows stamped after the last run; without one, all rows."""
    return df if last_run is None else df.filter(F.col("updated_at") > F.lit(last_run))


def update_author_dim(dim: DataFrame, author: DataFrame, last_run: dt.datetime | None) -> DataFrame:
    """Overwrite the names of changed authors and add new ones."""
    changed = changed_since(author, last_run)
    return renamed_authors(dim, changed).unionByName(new_authors(dim, changed, keys.max_id(dim, "author_dim_id")))


def renamed_authors(dim: DataFrame, changed: DataFrame) -> DataFrame:
    names = changed.select("author_id", F.col("full_name").alias("_name"))
    return dim.join(names, "author_id", "left").select(
        "author_dim_id", "author_id",
        F.when(F.col("_name").isNotNull(), F.col("_name")).otherwise(F.col("author_name")).alias("author_name"))


def new_authors(dim: DataFrame, changed: DataFrame, start_after: int) -> DataFrame:
    """Changed authors that the dimension lacks, numbered after the highest id."""
    named = changed.select("author_id", F.col("full_name").alias("author_name"))
    numbered = keys.assign_ids(joins.missing_rows(named, dim, ["author_id"]), "author_dim_id", ["author_id"], start_after)
    return numbered.select("author_dim_id", "author_id", "author_name")


def init_nyt_dim(sales: DataFrame) -> DataFrame:
    """Distinct non-blank categories, ids in alphabetical order."""
    listed = sales.select(F.col("nyt_best_selling_category").alias("listed_as_desc"))
    listed = listed.filter(F.trim("listed_as_desc") != "").distinct()
    return keys.assign_ids_sorted(listed, "nyt_bestseller_dim_id", ["listed_as_desc"]).select(
        "nyt_bestseller_dim_id", "listed_as_desc")


def new_categories(dim: DataFrame, sales: DataFrame) -> DataFrame:
    """Rows for categories of sales not loaded yet; a row without a category is an error."""
    listed = not_loaded(sales).select(F.col("nyt_best_selling_category").alias("listed_as_desc")).distinct()
    valid, _ = check_not_null(listed, ["listed_as_desc"], strict=True)
    fresh = joins.missing_rows(valid, dim, ["listed_as_desc"])
    numbered = keys.assign_ids_sorted(fresh, "nyt_bestseller_dim_id", ["listed_as_desc"],
                                      keys.max_id(dim, "nyt_bestseller_dim_id"))
    return numbered.select(dim.columns)


def update_nyt_dim(dim: DataFrame, sales: DataFrame) -> DataFrame:
    return dim.unionByName(new_categories(dim, sales))


def book_versions(book_isbn: DataFrame, oltp: dict[str, DataFrame], run_date: dt.date) -> DataFrame:
    """Open versions of the given ISBN rows, effective from the run date."""
    rows = book_isbn.join(oltp["book"].select("book_id", F.col("title").alias("book_title")), "book_id")
    for value in ("publisher", "format", "language"):
        rows = rows.join(oltp[value].select(f"{value}_id", value), f"{value}_id", "left")
    return (rows.withColumn("isbn_13", F.col("isbn13"))
            .withColumns({"effective_date": F.lit(run_date), "expire_date": F.lit(None).cast("date"),
                          "current_flag": F.lit(True)})
            .select(BOOK_DIM))


def init_book_dim(oltp: dict[str, DataFrame], run_date: dt.date) -> DataFrame:
    versions = settle(book_versions(oltp["book_isbn"], oltp, run_date), "book-versions")
    return keys.assign_ids(versions, "book_dim_id", ["book_isbn_id"]).select("book_dim_id", *BOOK_DIM)


def new_books(dim: DataFrame, oltp: dict[str, DataFrame], run_date: dt.date, last_run: dt.datetime | None,
              start_after: int | None = None) -> DataFrame:
    """Versions of ISBNs changed since the last run that have none yet; ids follow ``start_after``, else the dimension's highest."""
    changed = changed_since(oltp["book_isbn"], last_run)
    return numbered_versions(dim, book_versions(joins.missing_rows(changed, dim, ["book_isbn_id"]), oltp, run_date), start_after)


def numbered_versions(dim: DataFrame, versions: DataFrame, start_after: int | None = None) -> DataFrame:
    written = settle(versions, "book-versions")
    top = keys.max_id(dim, "book_dim_id") if start_after is None else start_after
    return keys.assign_ids(written, "book_dim_id", ["book_isbn_id"], top).select(dim.columns)


def update_book_dim(dim: DataFrame, oltp: dict[str, DataFrame], run_date: dt.date,
                    last_run: dt.datetime | None, refresh: bool = False) -> DataFrame:
    """Add ISBNs changed since the last run that have no version yet.

    By default a known ISBN is never refreshed. ``refresh`` expires its current
    version and opens a new one where any described value differs.
    """
    if not refresh:
        return dim.unionByName(new_books(dim, oltp, run_date, last_run))
    described = ["book_title", "isbn_13", "publisher", "format", "language"]
    now = book_versions(changed_since(oltp["book_isbn"], last_run), oltp, run_date)
    current = dim.filter("current_flag").select("book_isbn_id", F.struct(*described).alias("_old"))
    differs = F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.struct(*described))
    added = settle(now.join(current, "book_isbn_id", "left").filter(differs).select(BOOK_DIM), "book-versions")
    kept = expire(dim, added.select("book_isbn_id", F.lit(True).alias("_expired")), "book_isbn_id", run_date)
    return kept.unionByName(numbered_versions(dim, added))


def expire(dim: DataFrame, marks: DataFrame, key: str, run_date: dt.date) -> DataFrame:
    """Close the current versions whose key carries an ``_expired`` mark."""
    closing = F.col("current_flag") & F.coalesce("_expired", F.lit(False))
    return dim.join(marks, key, "left").withColumns({
        "expire_date": F.when(closing, F.lit(run_date)).otherwise(F.col("expire_date")),
        "current_flag": F.when(closing, F.lit(False)).otherwise(F.col("current_flag")),
    }).select(dim.columns)


def scd2_publisher_rename(dim: DataFrame, renames: DataFrame, run_date: dt.date, start_after: int | None = None) -> DataFrame:
    """New versions for the current books of renamed publishers.

    ``renames`` holds (publisher, new_publisher), one row per old name; a row
    that does not change the name is ignored. Exactly the versions this call
    expires get a successor. ``start_after`` is the highest id in use, where
    ``dim`` is but a part of the dimension.
    """
    top = keys.max_id(dim, "book_dim_id") if start_after is None else start_after
    real = renames.filter(F.col("publisher") != F.col("new_publisher"))
    successors = (dim.filter("current_flag").join(real, "publisher").drop("publisher")
                  .withColumnRenamed("new_publisher", "publisher")
                  .withColumns({"effective_date": F.lit(run_date), "expire_date": F.lit(None).cast("date")}))
    numbered = keys.assign_ids(successors.drop("book_dim_id"), "book_dim_id", ["book_isbn_id"], top)
    marks = real.select("publisher", F.lit(True).alias("_expired"))
    return expire(dim, marks, "publisher", run_date).unionByName(numbered.select(dim.columns))


def rename_publisher(oltp_publisher: DataFrame, dim: DataFrame, old: str, new: str, run_ts: dt.datetime,
                     start_after: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One renamed publisher: new publisher table, new book dimension, log row."""
    renames = dim.sparkSession.createDataFrame([(old, new)], "publisher string, new_publisher string")
    hit = F.col("publisher") == old
    publisher = oltp_publisher.withColumn("publisher", F.when(hit, F.lit(new)).otherwise(F.col("publisher")))
    if "updated_at" in publisher.columns:
        stamped = F.when(oltp_publisher["publisher"] == old, F.lit(run_ts)).otherwise(F.col("updated_at"))
        publisher = publisher.withColumn("updated_at", stamped)
    versioned = dim.filter(F.col("current_flag") & hit).count() if old != new else 0
    log = etl_log_row(dim.sparkSession, run_ts, "oltp", "publisher_update", versioned, versioned)
    return publisher, scd2_publisher_rename(dim, renames, run_ts.date(), start_after), log


# Fact

def author_slots(book_isbn: DataFrame, author_isbn: DataFrame, author_dim: DataFrame) -> DataFrame:
    """First five contributors per ISBN as author dimension ids, in bridge order."""
    order = Window.partitionBy("book_isbn_id").orderBy("author_isbn_id")
    ranked = (author_isbn.select("book_isbn_id", "author_isbn_id", "author_id")
              .withColumn("_rank", F.row_number().over(order)).filter("_rank <= 5"))
    known = ranked.join(author_dim.select("author_id", "author_dim_id"), "author_id", "left")
    pivoted = joins.pivot_ranks(known, ["book_isbn_id"], "_rank", "author_dim_id", AUTHOR_SLOTS)
    return pivoted.join(book_isbn.select("book_isbn_id", "isbn13"), "book_isbn_id")


def with_category(rows: DataFrame, nyt_dim: DataFrame, how: str) -> DataFrame:
    categories = nyt_dim.select("nyt_bestseller_dim_id", F.col("listed_as_desc").alias("nyt_best_selling_category"))
    return rows.join(categories, "nyt_best_selling_category", how)


def init_sales_fact(sales: DataFrame, star: dict[str, DataFrame], oltp: dict[str, DataFrame],
                    isbn_rating: DataFrame | None = None) -> DataFrame:
    """First fact load: every sale with a current book, a contributor, a month and a category.

    Ids ascend by month, then by book. With ``isbn_rating`` books get their
    average rating before the sales are joined, so no fact row moves for it.
    """
    slots = author_slots(oltp["book_isbn"], oltp["author_isbn"], star["author_dim"])
    books = (star["book_dim"].filter("current_flag").select("book_dim_id", "book_isbn_id", "isbn_13")
             .join(slots.drop("isbn13"), "book_isbn_id"))
    if isbn_rating is not None:
        books = fill_avg_rating(books, star["book_dim"], isbn_rating)
    rated = [] if isbn_rating is None else ["avg_rating"]
    rows = (sales.join(books, F.col("isbn13") == F.col("isbn_13"))
            .join(star["month_year_dim"], ["month", "year"]))
    rows = with_category(rows, star["nyt_bestseller_dim"], "inner")
    order = F.shiftleft(F.col("month_year_dim_id").cast("bigint"), 40) + F.col("book_dim_id")
    columns = ["month_year_dim_id", *AUTHOR_SLOTS, "book_dim_id", "nyt_bestseller_dim_id", *MEASURES, *rated]
    rows = settle(rows.select(order.alias("_order"), *columns), "fact")
    return keys.assign_ids(rows, "sales_fact_id", ["_order"]).select("sales_fact_id", *columns)


def fill_avg_rating(fact: DataFrame, book_dim: DataFrame, isbn_rating: DataFrame) -> DataFrame:
    ratings = (book_dim.select("book_dim_id", "book_isbn_id")
               .join(joins.average_ratings(isbn_rating), "book_isbn_id").drop("book_isbn_id"))
    return fact.join(ratings, "book_dim_id", "left").select(*fact.columns, "avg_rating")


def unloaded(sales: DataFrame, month: int, year: int) -> DataFrame:
    return not_loaded(sales).filter((F.col("month") == month) & (F.col("year") == year))


def only_sold(oltp: dict[str, DataFrame], sales: DataFrame) -> dict[str, DataFrame]:
    """The ISBN tables cut down to ISBNs with sales."""
    isbns = oltp["book_isbn"].select("book_isbn_id", "isbn13").join(sales.select("isbn13"), "isbn13", "left_semi")
    bridges = {name: oltp[name].join(isbns.select("book_isbn_id"), "book_isbn_id", "left_semi")
               for name in ("author_isbn", "isbn_rating") if name in oltp}
    return {"book_isbn": isbns, **bridges}


def matched_books(star: dict[str, DataFrame], oltp: dict[str, DataFrame]) -> DataFrame:
    """Current books with their author slots, by ISBN-13."""
    slots = author_slots(oltp["book_isbn"], oltp["author_isbn"], star["author_dim"]).drop("book_isbn_id")
    current = star["book_dim"].filter("current_flag").select("book_dim_id", F.col("isbn_13").alias("isbn13"))
    return current.join(slots, "isbn13")


def monthly_fact(sales: DataFrame, star: dict[str, DataFrame], oltp: dict[str, DataFrame], month: int, year: int,
                 start_after: int = 0) -> DataFrame:
    """Fact rows of a month's unloaded sales; a category is not required.

    Contributors and ratings are worked out for the ISBNs sold, not for the
    whole catalogue. The month has one row in its dimension.
    """
    monthly = unloaded(sales, month, year)
    sold = only_sold(oltp, monthly)
    ratings = (sold["book_isbn"].join(joins.average_ratings(sold["isbn_rating"]), "book_isbn_id")
               .select("isbn13", "avg_rating"))
    this_month = star["month_year_dim"].filter((F.col("month") == month) & (F.col("year") == year))
    rows = (monthly.join(matched_books(star, sold), "isbn13")
            .join(F.broadcast(this_month), ["month", "year"])
            .join(ratings, "isbn13", "left"))
    columns = ["month_year_dim_id", *AUTHOR_SLOTS, "book_dim_id", "nyt_bestseller_dim_id", *MEASURES, "avg_rating"]
    rows = settle(with_category(rows, star["nyt_bestseller_dim"], "left").select("isbn13", *columns), "fact")
    return keys.assign_ids(rows, "sales_fact_id", ["book_dim_id", "isbn13"], start_after).select("sales_fact_id", *columns)


def unmatched_sales(sales: DataFrame, star: dict[str, DataFrame], oltp: dict[str, DataFrame], month: int,
                    year: int, run_ts: dt.datetime) -> DataFrame:
    """A month's unloaded sales without a current book or without a contributor."""
    rows, bridges = unloaded(sales, month, year), {name: oltp[name] for name in ("book_isbn", "author_isbn")}
    current = star["book_dim"].filter("current_flag").select(
        F.col("isbn_13").alias("isbn13"), F.lit(True).alias("_book")).distinct()
    lost = rows.join(matched_books(star, only_sold(bridges, rows)).select("isbn13"), "isbn13", "left_anti")
    notes = F.when(F.col("_book").isNull(), F.lit("no current book")).otherwise(F.lit("no contributor"))
    return (lost.join(current, "isbn13", "left")
            .select(*SALES_KEY, *MEASURES, "nyt_best_selling_category", notes.alias("notes"),
                    F.lit(run_ts).alias("updated_date")))


def mark_loaded(sales: DataFrame, month: int, year: int) -> DataFrame:
    """All rows of the month count as loaded, matched or not."""
    this_month = (F.col("month") == month) & (F.col("year") == year)
    return sales.withColumn("loaded_to_warehouse", F.col("loaded_to_warehouse") | this_month)


# ETL log

def etl_log_row(spark, run_ts: dt.datetime, source: str, details: str, read: int = 0, inserted: int = 0,
                updated: int = 0, failed: int = 0) -> DataFrame:
    return spark.createDataFrame([(run_ts, source, details, read, inserted, updated, failed)], ETL_LOG)


def seed_etl_log(star: dict[str, DataFrame], run_ts: dt.datetime) -> DataFrame:
    """One row per first load: all rows read, all rows inserted."""
    spark = star["sales_fact"].sparkSession
    loads = [("synthetic", "load_sales_fact", "sales_fact"), ("oltp", "load_book_dim", "book_dim"),
             ("oltp", "load_author_dim", "author_dim"), ("synthetic", "load_month_year_dim", "month_year_dim")]
    rows = [(run_ts, source, details, n, n, 0, 0)
            for source, details, table in loads for n in [star[table].count()]]
    return spark.createDataFrame(rows, ETL_LOG)
