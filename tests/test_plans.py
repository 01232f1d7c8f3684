"""The plans Spark picks: what must not appear in them, and what must."""

import uuid

import pytest
from pyspark.sql import Window, functions as F

from shelfmark.operators import dedup, joins
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import reports, sums, warehouse
from shelfmark.schemas import AUTHOR_SLOTS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark):
    rows = spark.range(200).select(
        F.col("id").alias("sales_fact_id"), (F.col("id") % 7).alias("book_dim_id"),
        (F.col("id") % 3).alias("month_year_dim_id"), F.lit(1).cast("bigint").alias("nyt_bestseller_dim_id"),
        F.col("id").cast("int").alias("total_sales"), F.lit(2).cast("decimal(10,2)").alias("total_revenue"),
        F.lit(4).cast("decimal(3,2)").alias("avg_rating"),
        *[(F.col("id") % i).alias(slot) for i, slot in enumerate(AUTHOR_SLOTS, 2)])
    return settle(rows, "fact")


@pytest.fixture(scope="module")
def star(spark, fact):
    return {
        "sales_fact": fact,
        "author_dim": settle(spark.range(9).select(F.col("id").alias("author_dim_id"),
                                                   F.concat(F.lit("a"), "id").alias("author_name"))),
        "month_year_dim": settle(spark.range(3).select(F.col("id").alias("month_year_dim_id"),
                                                       F.col("id").alias("month"), F.lit(2026).alias("year"))),
    }



@pytest.fixture
def large(spark):
    """Plans as for tables beyond the broadcast limit."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_either_key_join_is_an_equi_join(spark, large):
    a = spark.range(10).select(F.col("id").alias("l"), F.col("id").alias("a1"), F.col("id").alias("a2"))
    b = spark.range(10).select(F.col("id").alias("r"), F.col("id").alias("b1"), F.col("id").alias("b2"))
    text = plan(joins.either_key_join(a, b, [("a1", "b1"), ("a2", "b2")]))
    assert "NestedLoop" not in text and "Cartesian" not in text and text.count("SortMergeJoin") == 2


def test_membership_join_is_an_equi_join(star, large):
    text = plan(reports.author_ratings({**star, "book_dim": star["month_year_dim"].select(
        F.col("month_year_dim_id").alias("book_dim_id"), F.lit("t").alias("book_title"),
        F.lit(True).alias("current_flag"))}, "a1"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_first_row_per_key_is_cut_before_the_shuffle(fact):
    text = plan(dedup.first_per_key(fact.select("book_dim_id", "sales_fact_id"), ["book_dim_id"], ["sales_fact_id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_trend_adds_up_before_the_shuffle_and_reads_four_columns(star):
    text = plan(reports.monthly_trend(star))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "total_sales" in line)
    schema = scan[scan.index("ReadSchema: struct<"):]
    assert "author_dim_id_1" not in schema and schema.count(":") == 5
    assert "partial_sum" in text


def test_unloaded_filter_reaches_the_scan(spark):
    sales = settle(spark.range(10).select(F.col("id").alias("month"), F.lit(2026).alias("year"),
                                          (F.col("id") > 5).alias("loaded_to_warehouse")))
    text = plan(warehouse.unloaded(sales, 3, 2026))
    assert "Not(EqualTo(loaded_to_warehou" in text[text.index("PushedFilters"):]


def test_top_k_keeps_no_full_sort(star):
    text = plan(reports.top_authors(star))
    assert "TakeOrderedAndProject" in text and "NestedLoop" not in text


def test_rank_filter_limits_contributors_per_task(spark, large):
    bridge = settle(spark.range(50).select((F.col("id") % 5).alias("book_isbn_id"), F.col("id").alias("author_isbn_id"),
                                           F.col("id").alias("author_id")))
    order = Window.partitionBy("book_isbn_id").orderBy("author_isbn_id")
    assert "WindowGroupLimit" in plan(bridge.withColumn("r", F.row_number().over(order)).filter("r <= 5"))


def sums_reports(t):
    return {"by author": reports.sales_by_first_author(t), "books": reports.top_books(t),
            "trend": reports.monthly_trend(t), "authors": reports.top_authors(t, more_than=0)}


def test_stored_sums_give_the_reports_without_the_fact(spark, fact, star):
    """Loads of one month after the other, one month in two loads; every report equals that over the whole fact."""
    loads = [fact.filter("sales_fact_id < 50"), *[fact.filter(f"sales_fact_id >= 50 AND month_year_dim_id = {m}") for m in range(3)]]
    books = settle(spark.range(6).select(F.col("id").alias("book_dim_id"), F.concat(F.lit("t"), "id").alias("book_title"),
                                         F.lit("p").alias("publisher"), (F.col("id") != 2).alias("current_flag")))
    whole = {**star, "book_dim": books}
    kept = {}
    for table in sums.KEYS:
        path = f"{shared_folder(spark)}/sums-{uuid.uuid4().hex}"
        for load in loads:
            sums.sums_of(load, table).write.mode("append").parquet(path)
        kept[table] = spark.read.parquet(path)
    want = sums_reports(whole)
    for name, got in sums_reports({**whole, **kept}).items():
        assert got.collect() == want[name].collect() != [], name
        assert not set(got.inputFiles()) & set(fact.inputFiles())


def test_authors_get_their_share_of_sums_not_of_fact_rows(fact):
    """Rows of a book with the same authors add up before they are copied for each author."""
    lines = plan(sums.sums_of(fact, sums.BY_AUTHOR_BOOK)).splitlines()
    explode = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert any("HashAggregate" in line for line in lines[explode:])


def test_names_of_slots_are_looked_up_once_for_rows_that_share_them(fact, star):
    names = {slot: f"author_{i}" for i, slot in enumerate(AUTHOR_SLOTS, 1)}
    rows = fact.withColumns({AUTHOR_SLOTS[0]: F.expr("nullif(sales_fact_id % 2, 0)"), "book_dim_id": F.expr("nullif(book_dim_id, 3)")})
    by_row, by_book = [joins.slots_lookup(rows, key, names, star["author_dim"], "author_dim_id", "author_name")
                       for key in ("sales_fact_id", "book_dim_id")]
    assert by_book.columns == by_row.columns
    assert sorted(by_book.collect(), key=lambda r: r["sales_fact_id"]) == sorted(by_row.collect(), key=lambda r: r["sales_fact_id"])
    lines = plan(by_book).splitlines()
    assert any("HashAggregate" in line for line in lines[next(i for i, line in enumerate(lines) if "Generate" in line):])
