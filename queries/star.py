"""Star schema jobs and reports over books, contributors and sales."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import functions as F

from queries import duck
from queries.normalised import RATING_CHANGES
from queries.registry import query, with_tables
from queries.standins import BOOKS, RAW_SALES, Made, books, raw_sales
from shelfmark.operators import changes
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import monthly, normalise, reports, snapshot, warehouse
from shelfmark.schemas import AUTHOR_SLOTS, MEASURES
from shelfmark.sources.tables import WRITERS, TableStore

RUN_TS = dt.datetime(2026, 1, 15, 12, 0)
RUN_DATE = RUN_TS.date()
LAST_RUN = dt.datetime(2026, 1, 1)
MONTH, YEAR = 5, 1998
AUTHOR = "author 3"

MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def amount(c: str) -> str:
    return f"CAST(replace(replace(trim({c}), '$', ''), ',', '') AS DECIMAL(10,2)) AS {c}"


COUNTS = ", ".join(f"CAST({c} AS INT) AS {c}" for c in MEASURES if c not in ("average_price", "total_revenue"))

SLOTS_SQL = ", ".join(f"max(CASE WHEN rn = {i} THEN author_dim_id END) AS author_dim_id_{i}" for i in range(1, 6))

STAR = {
    **BOOKS,
    "raw": RAW_SALES,
    "details": f"""SELECT isbn13, title, full_name, {duck.category('format')} AS nyt_best_selling_category FROM book_isbn
        LEFT JOIN book USING (book_id) LEFT JOIN (SELECT book_isbn_id, arg_min(author_id, author_isbn_id) AS author_id
        FROM author_isbn GROUP BY 1) USING (book_isbn_id) LEFT JOIN author USING (author_id) LEFT JOIN format USING (format_id)
        WHERE isbn13 IS NOT NULL""",
    "sales": f"""SELECT isbn13, CAST(list_position({MONTHS}, trim(month)) AS INT) AS month, CAST(year AS INT) AS year, {COUNTS},
        {amount('average_price')}, {amount('total_revenue')}, title, full_name, nyt_best_selling_category
        FROM raw LEFT JOIN details USING (isbn13)""",
    "month_year_dim": """SELECT row_number() OVER (ORDER BY year, month) AS month_year_dim_id, month, year
        FROM (SELECT DISTINCT month, year FROM sales)""",
    "author_dim": """SELECT row_number() OVER (ORDER BY author_id) AS author_dim_id, author_id, full_name AS author_name FROM author""",
    "book_dim": """SELECT row_number() OVER (ORDER BY book_isbn_id) AS book_dim_id, book_isbn_id, title AS book_title, isbn13 AS isbn_13,
        publisher, format, language, DATE '2026-01-15' AS effective_date, CAST(NULL AS DATE) AS expire_date, true AS current_flag
        FROM book_isbn JOIN book USING (book_id) LEFT JOIN publisher USING (publisher_id) LEFT JOIN format USING (format_id)
        LEFT JOIN language USING (language_id)""",
    "nyt_bestseller_dim": """SELECT row_number() OVER (ORDER BY c) AS nyt_bestseller_dim_id, c AS listed_as_desc FROM (
        SELECT DISTINCT nyt_best_selling_category AS c FROM sales WHERE nyt_best_selling_category IS NOT NULL)""",
    "slots": f"""SELECT book_isbn_id, {SLOTS_SQL} FROM (SELECT book_isbn_id, author_dim_id,
        row_number() OVER (PARTITION BY book_isbn_id ORDER BY author_isbn_id) AS rn FROM author_isbn JOIN author_dim USING (author_id))
        GROUP BY 1""",
    "rating": """SELECT book_isbn_id, CAST(CAST(c1 * 5 + c2 * 4 + c3 * 3 + c4 * 2 + c5 AS DECIMAL(18,6)) / nullif(c1 + c2 + c3 + c4 + c5, 0)
        AS DECIMAL(3,2)) AS avg_rating FROM (SELECT book_isbn_id, max(CASE WHEN review_type_id = 1 THEN count END) AS c1,
        max(CASE WHEN review_type_id = 2 THEN count END) AS c2, max(CASE WHEN review_type_id = 3 THEN count END) AS c3,
        max(CASE WHEN review_type_id = 4 THEN count END) AS c4, max(CASE WHEN review_type_id = 5 THEN count END) AS c5
        FROM isbn_rating GROUP BY 1)""",
    "sales_fact": """SELECT row_number() OVER (ORDER BY month_year_dim_id, book_dim_id) AS sales_fact_id, month_year_dim_id,
        author_dim_id_1, author_dim_id_2, author_dim_id_3, author_dim_id_4, author_dim_id_5, book_dim_id, nyt_bestseller_dim_id, """
        + ", ".join(MEASURES) + """, avg_rating
        FROM sales JOIN book_dim ON isbn_13 = isbn13 JOIN slots USING (book_isbn_id) JOIN month_year_dim USING (month, year)
        JOIN nyt_bestseller_dim ON listed_as_desc = nyt_best_selling_category LEFT JOIN rating USING (book_isbn_id)""",
}


def over(select: str) -> str:
    return with_tables(STAR, select)


def cleaned_sales(t):
    return t.stored("sales", lambda t: settle(warehouse.clean_sales(raw_sales(t), books(t)), "sales"))


def dims(t, oltp) -> Made:
    return Made({
        "month_year_dim": lambda: settle(warehouse.init_month_year_dim(cleaned_sales(t)), "months"),
        "author_dim": lambda: settle(warehouse.init_author_dim(oltp["author"]), "authors"),
        "book_dim": lambda: settle(warehouse.init_book_dim(oltp, RUN_DATE), "books"),
        "nyt_bestseller_dim": lambda: settle(warehouse.init_nyt_dim(cleaned_sales(t)), "categories"),
    })


def star(t) -> Made:
    return t.stored("star", build_star)


def build_star(t) -> Made:
    """Dimensions and fact, each written once, when a query first asks for it."""
    oltp = books(t)
    made = dims(t, oltp)

    def fact():
        return settle(warehouse.init_sales_fact(cleaned_sales(t), made, oltp, oltp["isbn_rating"]), "fact")
    return Made({name: partial(made.__getitem__, name) for name in made} | {"sales_fact": fact})


# Sales staging

@query("s3_load_sales", with_tables({"raw": RAW_SALES}, "SELECT isbn13, trim(month) AS month, year, net_sales FROM raw"))
def _(t):
    from shelfmark.schemas import SALES_COLUMNS
    from shelfmark.sources.files import load_sales
    path = f"{shared_folder(t.spark)}/sales-{uuid.uuid4().hex}"
    raw_sales(t).select([F.col(c).alias(h) for h, c in SALES_COLUMNS.items()]).write.option("header", True).csv(path)
    return load_sales(t.spark, path).select("isbn13", F.trim("month").alias("month"), "year", "net_sales")


@query("h1_clean_sales", over("SELECT * FROM sales"))
def _(t):
    return warehouse.clean_sales(raw_sales(t), books(t))


STAGED = ", ".join(["isbn13", "month", "year", *MEASURES, "nyt_best_selling_category"])


@query("s4_append_sales", over(f"""
SELECT {STAGED}, year < {YEAR} AS loaded_to_warehouse FROM sales"""))
def _(t):
    sales = cleaned_sales(t)
    there = sales.filter(F.col("year") < YEAR).withColumn("loaded_to_warehouse", F.lit(True))
    return warehouse.append_sales(there, sales.filter(F.col("year") >= YEAR))


@query("s5_backfill_sales", over(f"""
SELECT isbn_13 AS isbn13, month, year, {", ".join(MEASURES)}, listed_as_desc AS nyt_best_selling_category,
true AS loaded_to_warehouse FROM sales_fact JOIN book_dim USING (book_dim_id) JOIN month_year_dim USING (month_year_dim_id)
LEFT JOIN nyt_bestseller_dim USING (nyt_bestseller_dim_id) WHERE year >= {YEAR}"""))
def _(t):
    made = star(t)
    there = cleaned_sales(t).filter(F.col("year") < YEAR)
    return warehouse.backfill_sales(made, there)


# Dimensions

@query("h2_month_year_dim", over("SELECT * FROM month_year_dim"))
def _(t):
    return warehouse.init_month_year_dim(cleaned_sales(t))


@query("h3_author_dim", over("SELECT * FROM author_dim"))
def _(t):
    return warehouse.init_author_dim(books(t)["author"])


@query("h4_book_dim", over("SELECT * FROM book_dim"))
def _(t):
    return warehouse.init_book_dim(books(t), RUN_DATE)


@query("h5_nyt_dim", over("SELECT * FROM nyt_bestseller_dim"))
def _(t):
    return warehouse.init_nyt_dim(cleaned_sales(t))


def flagged(sales, *, categories: bool = False):
    """Sales staging in which the years before the load year count as loaded."""
    sales = sales.withColumn("loaded_to_warehouse", F.col("year") < YEAR)
    if categories:
        listed = F.coalesce("nyt_best_selling_category", F.lit("Best Paperback"))
        sales = sales.withColumn("nyt_best_selling_category", listed)
    return sales


def staged(t, *, categories: bool = False):
    return flagged(cleaned_sales(t), categories=categories)


@query("h8_update_month_year_dim", over(f"""
SELECT row_number() OVER (ORDER BY year >= {YEAR}, year, month) AS month_year_dim_id, month, year FROM month_year_dim"""))
def _(t):
    sales = staged(t)
    before = warehouse.init_month_year_dim(sales.filter("loaded_to_warehouse"))
    return warehouse.update_month_year_dim(before, sales)


@query("h9_update_author_dim", over("""
, d AS (SELECT row_number() OVER (ORDER BY author_id) AS author_dim_id, author_id, 'old ' || full_name AS author_name
 FROM author WHERE full_name < 'author 5'),
c AS (SELECT * FROM author WHERE updated_at > TIMESTAMP '2026-01-01')
SELECT author_dim_id, d.author_id, coalesce(c.full_name, author_name) AS author_name FROM d LEFT JOIN c ON c.author_id = d.author_id
UNION ALL SELECT (SELECT max(author_dim_id) FROM d) + row_number() OVER (ORDER BY author_id), author_id, full_name FROM c
WHERE author_id NOT IN (SELECT author_id FROM d)""").replace("\n\n, d AS", ",\nd AS", 1))
def _(t):
    author = books(t)["author"]
    old = author.filter("full_name < 'author 5'").withColumn("full_name", F.concat(F.lit("old "), "full_name"))
    return warehouse.update_author_dim(settle(warehouse.init_author_dim(old)), author, LAST_RUN)


@query("h10_update_nyt_dim", over(f"""
SELECT row_number() OVER (ORDER BY c <> 'Best Audio', c) AS nyt_bestseller_dim_id, c AS listed_as_desc FROM (
 SELECT 'Best Audio' AS c UNION SELECT DISTINCT coalesce(nyt_best_selling_category, 'Best Paperback') FROM sales WHERE year >= {YEAR})"""))
def _(t):
    sales = staged(t, categories=True)
    before = sales.select(F.lit(1).cast("bigint").alias("nyt_bestseller_dim_id"), F.lit("Best Audio").alias("listed_as_desc")).limit(1)
    return warehouse.update_nyt_dim(before, sales)


BOOK_VERSION = "book_isbn_id, book_title, isbn_13, publisher, format, language, effective_date, expire_date, current_flag"


@query("h11_update_book_dim", over(f"""
, d AS (SELECT book_dim.* REPLACE (row_number() OVER (ORDER BY book_isbn_id) AS book_dim_id, DATE '2025-01-01' AS effective_date)
 FROM book_dim WHERE book_isbn_id IN (SELECT book_isbn_id FROM book_isbn WHERE series_id IS NOT NULL))
SELECT * FROM d UNION ALL SELECT (SELECT max(book_dim_id) FROM d) + row_number() OVER (ORDER BY book_isbn_id), {BOOK_VERSION}
FROM book_dim WHERE book_isbn_id IN (SELECT book_isbn_id FROM book_isbn WHERE series_id IS NULL AND updated_at > TIMESTAMP '2026-01-01')
""").replace("\n\n, d AS", ",\nd AS", 1))
def _(t):
    oltp = books(t)
    some = {**oltp, "book_isbn": oltp["book_isbn"].filter("series_id IS NOT NULL")}
    before = settle(warehouse.init_book_dim(some, dt.date(2025, 1, 1)))
    return warehouse.update_book_dim(before, oltp, RUN_DATE, LAST_RUN)


RENAMES = [("house brand#3", "house three"), ("house brand#5", "house five"), ("house brand#7", "house brand#7")]


@query("h12_scd2_publisher_rename", over(f"""
, r AS (SELECT * FROM (VALUES ('house brand#3', 'house three'), ('house brand#5', 'house five')) AS v(old, new)),
d AS (SELECT * REPLACE (DATE '2025-01-01' AS effective_date) FROM book_dim)
SELECT d.* REPLACE (CASE WHEN old IS NULL THEN NULL ELSE DATE '2026-01-15' END AS expire_date, old IS NULL AS current_flag)
FROM d LEFT JOIN r ON old = publisher
UNION ALL SELECT (SELECT max(book_dim_id) FROM d) + row_number() OVER (ORDER BY book_isbn_id), book_isbn_id, book_title, isbn_13, new,
 format, language, DATE '2026-01-15', NULL, true FROM d JOIN r ON old = publisher""").replace("\n\n, r AS", ",\nr AS", 1))
def _(t):
    dim = settle(warehouse.init_book_dim(books(t), dt.date(2025, 1, 1)))
    renames = t.spark.createDataFrame(RENAMES, "publisher string, new_publisher string")
    return warehouse.scd2_publisher_rename(dim, renames, RUN_DATE)


@query("h12_stored_rename", over("""
, d AS (SELECT * REPLACE (DATE '2025-01-01' AS effective_date) FROM book_dim)
SELECT d.* REPLACE (CASE WHEN publisher = 'house brand#3' THEN DATE '2026-01-15' END AS expire_date,
 publisher IS DISTINCT FROM 'house brand#3' AS current_flag) FROM d
UNION ALL SELECT (SELECT max(book_dim_id) FROM d) + row_number() OVER (ORDER BY book_isbn_id), book_isbn_id, book_title, isbn_13,
 'house three', format, language, DATE '2026-01-15', NULL, true FROM d WHERE publisher = 'house brand#3'""").replace("\n\n, d AS", ",\nd AS", 1))
def _(t):
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/mart-{uuid.uuid4().hex}", part_rows=2000)
    store.publish({"publisher": books(t)["publisher"], "book_dim": warehouse.init_book_dim(books(t), dt.date(2025, 1, 1))},
                  {"publisher": "publisher_id", "book_dim": "book_dim_id"})
    snapshot.store_publisher_rename(store, "house brand#3", "house three", RUN_TS)
    return TableStore(t.spark, store.root).read("book_dim")


# Fact

@query("h6_init_sales_fact", over("SELECT * EXCLUDE (avg_rating) FROM sales_fact"))
def _(t):
    oltp, sales = books(t), cleaned_sales(t)
    return warehouse.init_sales_fact(sales, dims(t, oltp), oltp)


@query("h7_fill_avg_rating", over("SELECT * FROM sales_fact"))
def _(t):
    made = star(t)
    return warehouse.fill_avg_rating(made["sales_fact"].drop("avg_rating"), made["book_dim"], books(t)["isbn_rating"])


MONTH_FACT = f"""SELECT 500 + row_number() OVER (ORDER BY book_dim_id) AS sales_fact_id, month_year_dim_id, {", ".join(AUTHOR_SLOTS)},
 book_dim_id, nyt_bestseller_dim_id, {", ".join(MEASURES)}, avg_rating FROM sales JOIN book_dim ON isbn_13 = isbn13
 JOIN slots USING (book_isbn_id) JOIN month_year_dim USING (month, year) LEFT JOIN nyt_bestseller_dim ON listed_as_desc = nyt_best_selling_category
 LEFT JOIN rating USING (book_isbn_id) WHERE month = {MONTH} AND year = {YEAR}"""


@query("h13_monthly_fact", over(MONTH_FACT))
def _(t):
    return warehouse.monthly_fact(staged(t), star(t), books(t), MONTH, YEAR, start_after=500)


@query("h13_mark_loaded", over(f"""
SELECT isbn13, month, year, year < {YEAR} OR (month = {MONTH} AND year = {YEAR}) AS loaded_to_warehouse FROM sales"""))
def _(t):
    return warehouse.mark_loaded(staged(t), MONTH, YEAR).select("isbn13", "month", "year", "loaded_to_warehouse")


@query("h14_unmatched_sales", over(f"""
SELECT isbn13, month, year, {", ".join(MEASURES)}, nyt_best_selling_category,
 CASE WHEN book_dim_id IS NULL THEN 'no current book' ELSE 'no contributor' END AS notes, TIMESTAMP '2026-01-15 12:00:00' AS updated_date
FROM sales LEFT JOIN book_dim ON isbn_13 = isbn13 LEFT JOIN slots USING (book_isbn_id)
WHERE month = {MONTH} AND year = {YEAR} AND slots.book_isbn_id IS NULL"""))
def _(t):
    return warehouse.unmatched_sales(staged(t), star(t), books(t), MONTH, YEAR, RUN_TS)


@query("h15_seed_etl_log", over("""
SELECT TIMESTAMP '2026-01-15 12:00:00' AS run_date, source, details, n AS rows_from_raw_data, n AS rows_inserted_to_dw,
 0 AS rows_updated, 0 AS rows_failed FROM (
SELECT 'synthetic' AS source, 'load_sales_fact' AS details, (SELECT count(*) FROM sales_fact) AS n
UNION ALL SELECT 'oltp', 'load_book_dim', (SELECT count(*) FROM book_dim)
UNION ALL SELECT 'oltp', 'load_author_dim', (SELECT count(*) FROM author_dim)
UNION ALL SELECT 'synthetic', 'load_month_year_dim', (SELECT count(*) FROM month_year_dim))"""))
def _(t):
    return warehouse.seed_etl_log(star(t), RUN_TS)


def loaded_store(t) -> TableStore:
    """First load of the years before; then all other sales are added, the load month is run twice, then the next one.

    The first load cleans its years itself, so that only the others are cleaned
    for the runs. The tables it starts from are made side by side.
    """
    store = TableStore(t.spark, f"{shared_folder(t.spark)}/mart-{uuid.uuid4().hex}")
    used = ("author", "publisher", "format", "language", "book", "book_isbn", "author_isbn", "isbn_rating")
    with ThreadPoolExecutor(WRITERS) as pool:
        made, raw = books(t), pool.submit(raw_sales, t)
        oltp = dict(zip(used, pool.map(made.__getitem__, used)))
        raw = raw.result()
    monthly.first_load(store, oltp, raw.filter(F.col("year").cast("int") < YEAR), LAST_RUN)
    later = settle(warehouse.clean_sales(raw.filter(F.col("year").cast("int") >= YEAR), oltp), "sales")
    monthly.add_sales(store, flagged(later, categories=True))
    for days, month in enumerate((MONTH, MONTH, MONTH + 1)):
        monthly.process_monthly_sales(store, month, YEAR, RUN_TS + dt.timedelta(days=days))
    return store


@query("h16_fact_after_monthly_run", over(f"""
SELECT month, book_isbn_id, {", ".join(MEASURES)}, avg_rating, coalesce(nyt_best_selling_category, 'Best Paperback') AS listed_as_desc
FROM sales JOIN book_dim ON isbn_13 = isbn13 JOIN slots USING (book_isbn_id) LEFT JOIN rating USING (book_isbn_id)
WHERE month IN ({MONTH}, {MONTH + 1}) AND year = {YEAR}"""))
def _(t):
    made = t.stored("mart", loaded_store).read_all()
    fact = reports.fact_of_month(made, MONTH, YEAR).unionByName(reports.fact_of_month(made, MONTH + 1, YEAR))
    return (fact.join(made["book_dim"].select("book_dim_id", "book_isbn_id"), "book_dim_id")
            .join(made["nyt_bestseller_dim"], "nyt_bestseller_dim_id")
            .select("month", "book_isbn_id", *MEASURES, "avg_rating", "listed_as_desc"))


@query("h16_sales_after_monthly_runs", over(f"""
SELECT month, year, year < {YEAR} OR (year = {YEAR} AND month IN ({MONTH}, {MONTH + 1})) AS loaded_to_warehouse, count(*) AS n, sum(total_sales) AS total_sales
FROM sales LEFT JOIN book_dim ON isbn_13 = isbn13 LEFT JOIN slots USING (book_isbn_id)
WHERE year >= {YEAR} OR author_dim_id_1 IS NOT NULL GROUP BY ALL"""))
def _(t):
    return t.stored("mart", loaded_store).read(monthly.SALES).groupBy("month", "year", "loaded_to_warehouse").agg(
        F.count("*").alias("n"), F.sum("total_sales").alias("total_sales"))


# What each run finds unloaded, and the sales it loads.
RUN_LOG = f"""
, runs AS (SELECT * FROM (VALUES (1, {MONTH}, TIMESTAMP '2026-01-15 12:00:00'), (2, {MONTH}, TIMESTAMP '2026-01-16 12:00:00'),
 (3, {MONTH + 1}, TIMESTAMP '2026-01-17 12:00:00')) AS r(run, m, run_date)),
u AS (SELECT run, run_date, sales.*, coalesce(nyt_best_selling_category, 'Best Paperback') AS listed FROM runs JOIN sales ON year >= {YEAR}
 AND NOT (run > 1 AND month = {MONTH} AND year = {YEAR})),
m AS (SELECT * FROM runs LEFT JOIN (SELECT run AS of_run, month AS of_month, author_dim_id_1 FROM u LEFT JOIN book_dim ON isbn_13 = isbn13
 LEFT JOIN slots USING (book_isbn_id) WHERE year = {YEAR}) ON of_run = run AND of_month = m),
old_names AS (SELECT DISTINCT nyt_best_selling_category AS listed FROM sales WHERE year < {YEAR} AND nyt_best_selling_category IS NOT NULL),
made AS (
SELECT run_date, 'synthetic' AS source, 'load_sales_to_warehouse' AS details, count(of_run) AS n, count(author_dim_id_1) AS added FROM m GROUP BY run_date
UNION ALL SELECT run_date, 'synthetic', 'update_month_year_dim', count(DISTINCT (month, year)), CASE WHEN run = 1 THEN count(DISTINCT (month, year)) ELSE 0 END
 FROM u GROUP BY run, run_date
UNION ALL SELECT run_date, 'synthetic', 'update_nyt_bestseller_dim', count(DISTINCT listed), count(DISTINCT listed) FILTER (run = 1 AND listed NOT IN
 (SELECT listed FROM old_names)) FROM u GROUP BY run_date
UNION ALL SELECT run_date, 'oltp', 'update_author_dim', k, k FROM (SELECT run_date, CASE WHEN run = 1 THEN (SELECT count(*) FROM author
 WHERE updated_at > TIMESTAMP '2026-01-01') ELSE 0 END AS k FROM runs)
UNION ALL SELECT run_date, 'oltp', 'update_book_dim', CASE WHEN run = 1 THEN (SELECT count(*) FROM book_isbn
 WHERE updated_at > TIMESTAMP '2026-01-01') ELSE 0 END, 0 FROM runs
UNION ALL SELECT run_date, 'synthetic', 'insert_monthly_sales', 0, 0 FROM runs)
SELECT run_date, source, details, n AS rows_from_raw_data, added AS rows_inserted_to_dw, 0 AS rows_updated, 0 AS rows_failed FROM made"""


@query("h16_log_of_monthly_runs", over(RUN_LOG + f"""
UNION ALL SELECT TIMESTAMP '2026-01-01 00:00:00', source, details, k, k, 0, 0 FROM (
 SELECT 'oltp' AS source, 'load_author_dim' AS details, (SELECT count(*) FROM author) AS k UNION ALL SELECT 'oltp', 'load_book_dim', (SELECT count(*) FROM book_isbn)
 UNION ALL SELECT 'synthetic', 'load_month_year_dim', (SELECT count(DISTINCT (month, year)) FROM sales WHERE year < {YEAR})
 UNION ALL SELECT 'synthetic', 'load_sales_fact', (SELECT count(*) FROM sales JOIN book_dim ON isbn_13 = isbn13 JOIN slots USING (book_isbn_id)
  WHERE year < {YEAR} AND author_dim_id_1 IS NOT NULL))""").replace("\n\n, runs AS", ",\nruns AS", 1))
def _(t):
    return t.stored("mart", loaded_store).read("etl_log")


# Reports

@query("r1_format_category_counts", over("""
SELECT format, nyt_best_selling_category, count(*) AS count FROM sales LEFT JOIN book_isbn USING (isbn13) LEFT JOIN format USING (format_id)
GROUP BY ALL"""))
def _(t):
    return reports.format_category_counts(cleaned_sales(t), books(t))


@query("r2_fact_totals", over("""
SELECT count(*) AS total_records, sum(total_sales) AS total_units_sold, sum(total_revenue) AS total_revenue,
 CAST(sum(average_price) / count(average_price) AS DECIMAL(10,2)) AS avg_price FROM sales_fact"""))
def _(t):
    return reports.fact_totals(star(t)["sales_fact"])


@query("r2_best_in_person", over("SELECT * FROM sales_fact ORDER BY in_person_sales DESC, sales_fact_id LIMIT 1"))
def _(t):
    return reports.best_in_person(star(t)["sales_fact"])


@query("r2_worst_in_person", over("SELECT * FROM sales_fact ORDER BY in_person_sales, sales_fact_id LIMIT 1"))
def _(t):
    return reports.worst_in_person(star(t)["sales_fact"])


@query("r3_book_isbn_profile", over("SELECT count(*) AS total_records, " + ", ".join(
    f"count({c}) AS has_{c}" for c in ("isbn10", "isbn13", "format_id", "edition_id", "publisher_id", "language_id")) + " FROM book_isbn"))
def _(t):
    return reports.book_isbn_profile(books(t)["book_isbn"])


@query("r4_contributors", over("""
SELECT author_isbn_id, full_name AS author, isbn13, role FROM author_isbn JOIN author USING (author_id)
JOIN book_isbn USING (book_isbn_id) LEFT JOIN role USING (role_id)"""))
def _(t):
    return reports.contributors(books(t))


REVIEW_TYPES = "(VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star')) AS v(review_type_id, review_type)"


@query("r5_ratings_by_isbn", over(f"""
SELECT isbn13, review_type, count FROM isbn_rating JOIN book_isbn USING (book_isbn_id) JOIN {REVIEW_TYPES} USING (review_type_id)"""))
def _(t):
    return reports.ratings_by_isbn({**books(t), "review_type": normalise.build_review_type(t.spark)})


@query("r6_genres_by_isbn", over("""
SELECT isbn13, isbn10, genre FROM book_isbn_genre JOIN book_isbn USING (book_isbn_id) JOIN genre USING (genre_id)"""))
def _(t):
    return reports.genres_by_isbn(books(t))


@query("r7_series_listing", over("SELECT isbn13, series_name, series_num FROM book_isbn JOIN series USING (series_id)"))
def _(t):
    return reports.series_listing(books(t))


@query("r7_titles_with_series", over("""
SELECT isbn13, title, series_name, series_num FROM book_isbn LEFT JOIN series USING (series_id) LEFT JOIN book USING (book_id)"""))
def _(t):
    return reports.titles_with_series(books(t))


@query("r7_without_series", over("SELECT book_isbn_id, isbn13 FROM book_isbn WHERE series_id IS NULL"))
def _(t):
    return reports.without_series(books(t)["book_isbn"]).select("book_isbn_id", "isbn13")


@query("r8_box_sets", over("""
SELECT isbn13, title, full_name AS primary_author FROM book_isbn LEFT JOIN book USING (book_id) LEFT JOIN author_isbn USING (book_isbn_id)
LEFT JOIN author USING (author_id) WHERE is_boxset"""))
def _(t):
    return reports.box_sets(books(t))


@query("r9_books_across", over("""
, a AS (SELECT book_isbn_id, """ + ", ".join(f"max(CASE WHEN rn = {i} THEN full_name END) AS author_{i}" for i in range(1, 6)) + """
 FROM (SELECT *, row_number() OVER (PARTITION BY book_isbn_id ORDER BY author_isbn_id) AS rn FROM author_isbn JOIN author USING (author_id)) GROUP BY 1)
SELECT title, series_name, series_num, author_1, author_2, author_3, author_4, author_5, isbn13, format, publisher
FROM book_isbn JOIN book USING (book_id) LEFT JOIN series USING (series_id) LEFT JOIN format USING (format_id)
LEFT JOIN publisher USING (publisher_id) LEFT JOIN a USING (book_isbn_id)""").replace("\n\n, a AS", ",\na AS", 1))
def _(t):
    return reports.books_across(books(t))


@query("r10_books_by_author", over(f"""
SELECT full_name, title FROM author JOIN author_isbn USING (author_id) JOIN book_isbn USING (book_isbn_id) JOIN book USING (book_id)
WHERE full_name = '{AUTHOR}'"""))
def _(t):
    return reports.books_by_author(books(t), AUTHOR)


AVG_RATING = "CAST(sum(avg_rating) AS DOUBLE) / count(avg_rating) AS avg_rating"


@query("r11_sales_by_first_author", over(f"""
SELECT author_name, sum(total_sales) AS total_units_sold, {AVG_RATING} FROM sales_fact JOIN author_dim ON author_dim_id_1 = author_dim_id
GROUP BY 1"""))
def _(t):
    return reports.sales_by_first_author(star(t))


@query("r12_publisher_history", over("""
SELECT DISTINCT publisher, DATE '2025-01-01' AS effective_date,
 CASE WHEN publisher = 'house brand#3' THEN DATE '2026-01-15' END AS expire_date FROM book_dim WHERE contains(publisher, 'house brand#3')
UNION ALL SELECT DISTINCT 'house brand#3 publishing', DATE '2026-01-15', NULL FROM book_dim WHERE publisher = 'house brand#3'"""))
def _(t):
    dim = settle(warehouse.init_book_dim(books(t), dt.date(2025, 1, 1)))
    renames = t.spark.createDataFrame([("house brand#3", "house brand#3 publishing")], "publisher string, new_publisher string")
    return reports.publisher_history(warehouse.scd2_publisher_rename(dim, renames, RUN_DATE), "house brand#3")


@query("r13_top_books", over(f"""
SELECT book_title, publisher, sum(total_sales) AS total_units_sold, sum(total_revenue) AS total_revenue, {AVG_RATING}
FROM sales_fact JOIN book_dim USING (book_dim_id) WHERE current_flag GROUP BY 1, 2
ORDER BY total_units_sold DESC, book_title NULLS LAST, publisher NULLS LAST LIMIT 20"""))
def _(t):
    return reports.top_books(star(t))


@query("r14_monthly_trend", over("""
SELECT year, month, sum(total_sales) AS total_units, sum(total_revenue) AS revenue, count(DISTINCT book_dim_id) AS unique_books_sold
FROM sales_fact JOIN month_year_dim USING (month_year_dim_id) GROUP BY 1, 2"""))
def _(t):
    return reports.monthly_trend(star(t))


IN_ANY_SLOT = "author_dim_id IN (author_dim_id_1, author_dim_id_2, author_dim_id_3, author_dim_id_4, author_dim_id_5)"


@query("r15_top_authors", over(f"""
SELECT author_name, count(DISTINCT book_dim_id) AS unique_isbns, sum(total_sales) AS total_units_sold,
 CAST(sum(total_sales) AS DOUBLE) / count(total_sales) AS avg_sales_per_book, {AVG_RATING}
FROM sales_fact JOIN author_dim ON {IN_ANY_SLOT} GROUP BY 1 HAVING sum(total_sales) > 1000
ORDER BY total_units_sold DESC, author_name LIMIT 20"""))
def _(t):
    return reports.top_authors(star(t))


# Fact rows of the stored loads: the first one and two monthly runs.
STORED_FACT = f"""(SELECT sales.*, book_dim_id, book_title, publisher, slots.*, avg_rating FROM sales JOIN book_dim ON isbn_13 = isbn13
 JOIN slots USING (book_isbn_id) LEFT JOIN rating USING (book_isbn_id)
 WHERE (year < {YEAR} AND author_dim_id_1 IS NOT NULL) OR (year = {YEAR} AND month IN ({MONTH}, {MONTH + 1}))) AS f"""


def stored_sums(t) -> dict:
    """The mart without its fact, so that reports have the sums of its loads alone."""
    return {name: table for name, table in t.stored("mart", loaded_store).read_all().items() if name != monthly.FACT}


@query("r11_stored_first_authors", over(f"""
SELECT author_name, sum(total_sales) AS total_units_sold, {AVG_RATING} FROM {STORED_FACT} JOIN author_dim ON author_dim_id_1 = author_dim_id
GROUP BY 1"""))
def _(t):
    return reports.sales_by_first_author(stored_sums(t))


@query("r13_stored_top_books", over(f"""
SELECT book_title, publisher, sum(total_sales) AS total_units_sold, sum(total_revenue) AS total_revenue, {AVG_RATING} FROM {STORED_FACT}
GROUP BY 1, 2 ORDER BY total_units_sold DESC, book_title NULLS LAST, publisher NULLS LAST LIMIT 20"""))
def _(t):
    return reports.top_books(stored_sums(t))


@query("r14_stored_trend", over(f"""
SELECT year, month, sum(total_sales) AS total_units, sum(total_revenue) AS revenue, count(DISTINCT book_dim_id) AS unique_books_sold
FROM {STORED_FACT} GROUP BY 1, 2"""))
def _(t):
    return reports.monthly_trend(stored_sums(t))


@query("r15_stored_top_authors", over(f"""
SELECT author_name, count(DISTINCT book_dim_id) AS unique_isbns, sum(total_sales) AS total_units_sold,
 CAST(sum(total_sales) AS DOUBLE) / count(total_sales) AS avg_sales_per_book, {AVG_RATING}
FROM {STORED_FACT} JOIN author_dim ON {IN_ANY_SLOT} GROUP BY 1 HAVING sum(total_sales) > 1000
ORDER BY total_units_sold DESC, author_name LIMIT 20"""))
def _(t):
    return reports.top_authors(stored_sums(t))


@query("r16_author_ratings", over(f"""
SELECT book_title, CAST(round(CAST(sum(avg_rating) AS DECIMAL(18,6)) / count(avg_rating), 2) AS DECIMAL(4,2)) AS avg_rating, author_name FROM sales_fact JOIN book_dim USING (book_dim_id)
JOIN author_dim ON {IN_ANY_SLOT} WHERE author_name = '{AUTHOR}' AND current_flag GROUP BY 1, 3"""))
def _(t):
    return reports.author_ratings(star(t), AUTHOR)


@query("r17_author_listings", over(f"""
SELECT book_title, listed_as_desc AS nyt_award FROM sales_fact JOIN book_dim USING (book_dim_id)
LEFT JOIN nyt_bestseller_dim USING (nyt_bestseller_dim_id) JOIN author_dim ON {IN_ANY_SLOT}
WHERE author_name = '{AUTHOR}' AND current_flag"""))
def _(t):
    return reports.author_listings(star(t), AUTHOR)


@query("r18_wide_fact", over("SELECT concat_ws(', ', " + ", ".join(f"a{i}.author_name" for i in range(1, 6)) + """) AS all_authors,
 book_title, publisher, format, language, month, year, listed_as_desc, sales_fact.* FROM sales_fact
 LEFT JOIN book_dim USING (book_dim_id) LEFT JOIN month_year_dim USING (month_year_dim_id)
 LEFT JOIN nyt_bestseller_dim USING (nyt_bestseller_dim_id) """ + " ".join(
    f"LEFT JOIN author_dim a{i} ON a{i}.author_dim_id = author_dim_id_{i}" for i in range(1, 6))))
def _(t):
    return reports.wide_fact(star(t))


@query("r19_fact_of_month", over(f"""
SELECT sales_fact_id, book_dim_id, total_sales, month, year FROM sales_fact JOIN month_year_dim USING (month_year_dim_id)
WHERE month = {MONTH} AND year = {YEAR}"""))
def _(t):
    return reports.fact_of_month(star(t), MONTH, YEAR).select("sales_fact_id", "book_dim_id", "total_sales", "month", "year")


@query("r19_etl_log_of_day", over(RUN_LOG).replace("\n\n, runs AS", ",\nruns AS", 1))
def _(t):
    return reports.etl_log_since(t.stored("mart", loaded_store).read("etl_log"), RUN_DATE)


@query("r19_loaded_count", over(f"SELECT count(*) AS n FROM sales WHERE month = {MONTH} AND year = {YEAR - 1}"))
def _(t):
    return reports.loaded_count(staged(t), MONTH, YEAR - 1)


@query("r20_rating_history", with_tables(RATING_CHANGES, f"""
SELECT review_type AS review_type_name, CASE WHEN o.isbn_rating_id IS NULL THEN 'INSERT' WHEN n.isbn_rating_id IS NULL THEN 'DELETE'
 ELSE 'UPDATE' END AS operation_type, coalesce(o.count, n.count) AS old_count,
 CASE WHEN n.isbn_rating_id IS NULL THEN 0 ELSE n.count END AS new_count, TIMESTAMP '2026-01-15 12:00:00' AS log_date
FROM new n FULL JOIN old o ON o.isbn_rating_id = n.isbn_rating_id
JOIN {REVIEW_TYPES} ON v.review_type_id = coalesce(n.review_type_id, o.review_type_id)
WHERE o.count IS DISTINCT FROM n.count AND coalesce(n.book_isbn_id, o.book_isbn_id) = 7"""))
def _(t):
    diff = changes.diff(t.sql(RATING_CHANGES["old"]), t.sql(RATING_CHANGES["new"]), "isbn_rating_id")
    return reports.rating_history(changes.rating_log(diff, normalise.build_review_type(t.spark), RUN_TS), 7)


@query("r21_raw_sales_listing", over("""
SELECT isbn13, trim(raw.month) AS month, raw.year, title, full_name, format FROM raw LEFT JOIN book_isbn USING (isbn13)
LEFT JOIN book USING (book_id) LEFT JOIN author_isbn USING (book_isbn_id) LEFT JOIN author USING (author_id)
LEFT JOIN format USING (format_id)"""))
def _(t):
    return reports.raw_sales_listing(raw_sales(t), books(t)).select(
        "isbn13", F.trim("month").alias("month"), "year", "title", "full_name", "format")
