"""Column names and schemas of the raw files and the tables."""

from __future__ import annotations

from pyspark.sql import types as T

CATALOGUE_COLUMNS = [
    "bookId", "title", "series", "author", "description", "language", "isbn", "genres", "bookFormat",
    "edition", "pages", "publisher", "publishDate", "firstPublishDate", "numRatings", "ratingsByStars",
]
DROPPED_CATALOGUE_COLUMNS = ["characters", "awards", "coverImg", "bbeScore", "bbeVotes", "price", "setting"]

# Raw sales header to column name.
SALES_COLUMNS = {
    "ISBN": "isbn13", "Month": "month", "Year": "year", "In-Person Sales": "in_person_sales",
    "Online Sales": "online_sales", "Wholesale Sales": "wholesale_sales", "Total Sales": "total_sales",
    "Average Price": "average_price", "Total Revenue": "total_revenue", "Returns": "count_returns",
    "Net Sales": "net_sales",
}
COUNT_MEASURES = ["in_person_sales", "online_sales", "wholesale_sales", "total_sales", "count_returns", "net_sales"]
MONEY_MEASURES = ["average_price", "total_revenue"]
MEASURES = ["in_person_sales", "online_sales", "wholesale_sales", "total_sales", "average_price",
            "total_revenue", "count_returns", "net_sales"]

REVIEW_TYPES = [(1, "5_star"), (2, "4_star"), (3, "3_star"), (4, "2_star"), (5, "1_star")]

AUTHOR_SLOTS = [f"author_dim_id_{i}" for i in range(1, 6)]

SALES_TYPES = (
    {"isbn13": "string", "month": "int", "year": "int"}
    | {c: "decimal(10,2)" if c in MONEY_MEASURES else "int" for c in MEASURES}
    | {"nyt_best_selling_category": "string", "loaded_to_warehouse": "boolean"})
SALES_STAGING = list(SALES_TYPES)

BOOK_DIM = ["book_isbn_id", "book_title", "isbn_13", "publisher", "format", "language",
            "effective_date", "expire_date", "current_flag"]

ETL_LOG = T.StructType([
    T.StructField("run_date", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("rows_from_raw_data", T.LongType()),
    T.StructField("rows_inserted_to_dw", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_failed", T.LongType()),
])
