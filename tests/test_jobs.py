"""Whole jobs on small hand-made tables, against values worked out by hand or by brute force."""

import datetime as dt
from decimal import Decimal
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import changes, checks, dedup, joins, keys, skew
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import cleaning, monthly, normalise, reports, sums, warehouse
from shelfmark.schemas import CATALOGUE_COLUMNS, DROPPED_CATALOGUE_COLUMNS, MEASURES
from shelfmark.sources import files
from shelfmark.sources.tables import TableStore, column_names

RUN_TS = dt.datetime(2026, 1, 15, 12, 0)
FIRST_TS = dt.datetime(2025, 12, 1)


def book(pos, **values):
    row = dict.fromkeys(CATALOGUE_COLUMNS)
    row |= {"bookId": f"b{pos}", "title": f"Title {pos}", "language": "English", "author": "Ann Lee", "_src_pos": pos}
    return row | values


def catalogue(spark, *rows):
    schema = ", ".join(f"{c} string" for c in CATALOGUE_COLUMNS) + ", _src_pos bigint"
    return spark.createDataFrame([tuple(r[c] for c in [*CATALOGUE_COLUMNS, "_src_pos"]) for r in rows], schema)


def collect(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_cleaning_order_and_identifiers(spark):
    raw = catalogue(
        spark,
        book(0, isbn="978-0-439-02348-1", title="Same"),
        book(1, isbn="0-439-02348-3", title="Other", author="Bo"),
        book(2, isbn="9780439023481", title="Same"),
        book(3, isbn="9780439023482", title="SAME ", series="Saga #1-3"),
        book(4, isbn="9999999999999"), book(5, isbn=None), book(6, isbn="9780439023483", language="French"),
        book(7, isbn="9780439023484", title="Café"), book(8, isbn="9780439023485", publisher="Zoë (UK)"),
        book(9, isbn="9780439023486", bookId="b3"), book(10, isbn="9780439023487", author=None))
    out = cleaning.run_cleaning(raw, 2026)
    got = collect(out, "_src_pos", "book_uid", "edition_count", "has_multiple_editions", "is_boxset")
    assert got == [(0, 2, 2, 1, 0), (1, 1, 1, 0, 0), (3, 2, 2, 1, 1), (10, 3, 1, 0, 0)]
    assert collect(out.filter("_src_pos = 10"), "book_key", "series_uid") == [("title 10-None", None)]
    assert collect(out.filter("_src_pos = 3"), "series_key", "series_uid", "books_in_series") == [("saga-ann lee", 1, 1)]


def test_publisher_filter_follows_duplicate_removal(spark):
    raw = catalogue(spark, book(0, isbn="9780439023481", publisher="Zoë"), book(1, isbn="9780439023481"))
    assert cleaning.choose_rows(raw).count() == 0


def test_catalogue_in_files_of_different_sizes(spark):
    """Spark reads large files first; positions follow the names."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    whole = catalogue(spark, *[book(i, description="long " * (500 if i > 2 else 1)) for i in range(9)])
    whole = whole.withColumns({c: F.lit("x") for c in DROPPED_CATALOGUE_COLUMNS})
    for name, part in (("a", whole.filter("_src_pos < 2")), ("b", whole.filter("_src_pos BETWEEN 2 AND 3")), ("c", whole.filter("_src_pos > 3"))):
        part.drop("_src_pos").coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    rows = files.load_catalogue(spark, f"{folder}/*").orderBy("_src_pos").collect()
    want = [r["bookId"] for r in whole.orderBy("_src_pos").collect()]
    assert [r["bookId"] for r in rows] == want


def test_lookups_chain_without_repeated_scans(spark):
    """Five lookups read staging once; joins grow the plan by one each."""
    staging = spark.range(10).select(F.col("id").alias("_src_pos"), *[F.lit("x").alias(c) for c in (
        "isbn10", "isbn13", "bookFormat_norm", "edition_norm", "publisher_norm", "language", "series_name_norm", "pages_norm")], F.lit("1").alias("series_num"),
        F.col("id").alias("book_uid"), F.lit(1).alias("is_boxset"), F.current_date().alias("publishDate_norm"), F.current_date().alias("firstPublishDate_norm"))
    staging = settle(staging, "staging")
    lookups = {v: settle(spark.createDataFrame([(1, "x")], f"{i}_id long, {v} string"), v)
               for v, i in (("format", "format"), ("edition", "edition"), ("publisher", "publisher"), ("language", "language"), ("series_name", "series"))}
    plan = normalise.build_book_isbn(staging, lookups)._jdf.queryExecution().toString()
    assert plan.split("== Optimized")[0].count("Relation") <= 6  # the written joins, read twice, in up to three plans


def test_catalogue_file(spark):
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    raw = catalogue(spark, book(0, title='a "quoted", title', description="two\nlines", pages="N/A"))
    whole = raw.drop("_src_pos").withColumns({c: F.lit("x") for c in DROPPED_CATALOGUE_COLUMNS})
    whole.write.option("header", True).option("escape", '"').csv(folder)
    row = files.load_catalogue(spark, folder).first()
    assert (row["title"], row["description"], row["pages"], row["_src_pos"]) == ('a "quoted", title', "two\nlines", None, 0)
    whole.drop("awards").write.option("header", True).csv(folder + "-short")
    with pytest.raises(ValueError, match="awards"):
        files.load_catalogue(spark, folder + "-short")
    names = [r["column_name"] for r in column_names(raw).collect()]
    assert names == [*CATALOGUE_COLUMNS, "_src_pos"]


def test_normalise_links_everything(spark):
    raw = catalogue(
        spark,
        book(0, isbn="9780439023481", author="Ann Lee (Editor), Bo Poe, Ann Lee", genres="['Fantasy', \"Children's\"]",
             ratingsByStars="['5','4','3','2','1']", publisher="Viking", series="Saga #2", pages="10"),
        book(1, isbn="0439023483", author="Bo Poe", genres="['Fantasy']", bookFormat="Hardcover"))
    t = normalise.normalise(cleaning.run_cleaning(raw, 2026), RUN_TS)
    assert len(t) == 14 and all("updated_at" in df.columns for df in t.values())
    assert collect(t["author"], "author_id", "full_name") == [(1, "ann lee"), (2, "bo poe")]
    assert collect(t["genre"], "genre_id", "genre") == [(1, "fantasy"), (2, "childrens")]
    assert collect(t["author_isbn"], "author_isbn_id", "book_isbn_id", "author_id", "role_id") == [
        (1, 1, 1, 1), (2, 2, 2, None), (3, 1, 2, None), (4, 1, 1, None)]
    assert collect(t["isbn_rating"], "book_isbn_id", "review_type_id", "count") == [
        (1, 1, 5), (1, 2, 4), (1, 3, 3), (1, 4, 2), (1, 5, 1)]
    assert collect(t["book_isbn_genre"], "book_isbn_id", "genre_id") == [(1, 1), (1, 2), (2, 1)]
    row = t["book_isbn"].filter("book_isbn_id = 1").first()
    assert (row["isbn13"], row["series_num"], row["pages"], row["is_boxset"]) == ("9780439023481", Decimal("2.00"), 10, False)
    across = collect(reports.books_across(t), "title", "author_1", "author_2", "author_3")
    assert across == [("title 0", "ann lee", "bo poe", "ann lee"), ("title 1", "bo poe", None, None)]


def test_checks(spark):
    rows = spark.createDataFrame([(None, "1234"), ("1234567891011", None), (None, None), (None, "9781234567890")],
                                 "isbn10 string, isbn13 string")
    valid, rejected = checks.check_isbn(rows)
    assert valid.count() == 1
    assert sorted(r["reason"] for r in rejected.collect()) == sorted(
        [checks.ISBN13_LENGTH, checks.ISBN10_LENGTH, checks.NO_ISBN])
    with pytest.raises(checks.RejectedRows):
        checks.check_isbn(rows, strict=True)
    later, today = dt.date(2030, 1, 1), dt.date(2026, 1, 15)
    dated = spark.createDataFrame([(later, None), (None, later), (today, None)],
                                  "publish_date date, original_publish_date date")
    assert checks.check_publish_dates(dated, today)[0].count() == 1


def test_audit(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "book_id bigint, title string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "book_id bigint, title string")
    got = collect(changes.book_log(changes.diff(old, new, "book_id"), RUN_TS), "book_id", "log_message")
    assert got == [(2, "Book Updated from b to B"), (3, "Book Deleted = 3"), (4, "New Book Added = 4")]
    schema = "isbn_rating_id bigint, book_isbn_id bigint, review_type_id bigint, count int"
    old = spark.createDataFrame([(1, 9, 1, 5), (2, 9, 2, 5), (3, 9, 3, 5)], schema)
    new = spark.createDataFrame([(1, 9, 1, 5), (2, 9, 2, 6), (4, 9, 5, 7)], schema)
    log = changes.rating_log(changes.diff(old, new, "isbn_rating_id"), normalise.build_review_type(spark), RUN_TS)
    assert collect(log, "isbn_rating_id", "review_type_name", "operation_type", "old_count", "new_count") == [
        (2, "4_star", "UPDATE", 5, 6), (3, "3_star", "DELETE", 5, 0), (4, "1_star", "INSERT", 7, 7)]


# Monthly load

def oltp(spark):
    stamp = "TIMESTAMP '2025-01-01 00:00:00'"
    return {name: spark.sql(sql) for name, sql in {
        "author": f"SELECT * FROM VALUES (10L, 'ann', {stamp}), (20L, 'bo', {stamp}) AS t(author_id, full_name, updated_at)",
        "publisher": "SELECT * FROM VALUES (1L, 'two dollar radio'), (2L, 'viking') AS t(publisher_id, publisher)",
        "format": "SELECT * FROM VALUES (1L, 'hardcover') AS t(format_id, format)",
        "language": "SELECT * FROM VALUES (1L, 'English') AS t(language_id, language)",
        "book": "SELECT * FROM VALUES (1L, 'one'), (2L, 'two'), (3L, 'three') AS t(book_id, title)",
        "book_isbn": f"""SELECT id AS book_isbn_id, CAST(NULL AS STRING) AS isbn10, concat('978000000000', id) AS isbn13,
            id AS book_id, 1L AS format_id, if(id < 3, 1L, 2L) AS publisher_id, 1L AS language_id, {stamp} AS updated_at
            FROM VALUES (1L), (2L), (3L) AS t(id)""",
        "author_isbn": "SELECT * FROM VALUES (1L, 1L, 20L), (2L, 1L, 10L), (3L, 2L, 10L) AS t(author_isbn_id, book_isbn_id, author_id)",
        "isbn_rating": """SELECT 1L AS book_isbn_id, CAST(i AS BIGINT) AS review_type_id, n AS count
            FROM VALUES (1, 10), (2, 5), (3, 3), (4, 1), (5, 1) AS t(i, n)""",
    }.items()}


def raw_sales(spark, *isbns, month="Jan", year="2025"):
    rows = [(isbn, month, year, "1", "2", "3", "6", " $5.00", "$1,030.00", "1", "5") for isbn in isbns]
    columns = ["isbn13", "month", "year", "in_person_sales", "online_sales", "wholesale_sales", "total_sales",
               "average_price", "total_revenue", "count_returns", "net_sales"]
    return spark.createDataFrame(rows, columns)


def incoming(spark, *isbns, category="Best Hardcover"):
    typed = raw_sales(spark, *isbns).select("isbn13", F.lit(1).alias("month"), F.lit(2026).alias("year"), *[
        F.regexp_replace(c, "[ $,]", "").cast("decimal(10,2)" if c in ("average_price", "total_revenue") else "int").alias(c)
        for c in MEASURES])
    return typed.withColumn("nyt_best_selling_category", F.lit(category))


@pytest.fixture
def store(spark):
    store = TableStore(spark, f"{shared_folder(spark)}/mart-{uuid.uuid4().hex}")
    monthly.first_load(store, oltp(spark), raw_sales(spark, "9780000000001", "9780000000003", "999"), FIRST_TS)
    return store


def test_monthly_load(spark, store):
    assert store.read("sales_fact").count() == 1
    isbns = ["9780000000001", "9780000000002", "9780000000003", "999"]
    monthly.add_sales(store, incoming(spark, *isbns))
    with pytest.raises(checks.RejectedRows):
        monthly.add_sales(store, incoming(spark, isbns[0]))
    monthly.process_monthly_sales(store, 1, 2026, RUN_TS)
    t = store.read_all()
    new = reports.fact_of_month(t, 1, 2026)
    assert collect(new, "sales_fact_id", "book_dim_id", "author_dim_id_1", "author_dim_id_2", "avg_rating") == [
        (2, 1, 2, 1, Decimal("4.10")), (3, 2, 1, None, None)]
    assert collect(t["synthetic_unmatched"], "isbn13", "notes") == [
        ("9780000000003", "no contributor"), ("999", "no current book")]
    assert monthly.load_status(store, 1, 2026) == 4
    log = t["etl_log"].filter("details = 'load_sales_to_warehouse'")
    assert collect(log, "rows_from_raw_data", "rows_inserted_to_dw") == [(4, 2)]

    monthly.process_monthly_sales(store, 1, 2026, RUN_TS + dt.timedelta(days=1))
    assert store.read("sales_fact").count() == 3
    for table in sums.KEYS:
        merged, want = sums.sums(store.read_all(), table), sums.sums_of(store.read("sales_fact"), table)
        assert collect(merged, *want.columns) == collect(want, *want.columns)

    monthly.add_sales(store, incoming(spark, "9780000000002x"))
    monthly.process_monthly_sales(store, 1, 2026, RUN_TS + dt.timedelta(days=2))
    assert store.read("synthetic_unmatched").count() == 3 and store.read("sales_fact").count() == 3
    again = TableStore(spark, store.root)
    assert again.paths() == store.paths()


def test_stored_sales_are_made_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rows in batches:
            seen.add(len(rows))
            yield rows
    sales = incoming(spark, "9780000000001", "9780000000002").withColumn("loaded_to_warehouse", F.lit(False))
    monthly.store_sales(store, sales.mapInPandas(counted, sales.schema))
    assert seen.value == 2 and monthly.open_months(store) == ["2026-01"]
    before = store.paths()
    monthly.store_sales(store, sales.limit(0))
    assert store.paths() == before


def test_fact_is_numbered_without_texts_and_moves_for_no_ratings(spark, store, monkeypatch):
    t, written = oltp(spark), []
    star = {name: store.read(name) for name in monthly.DIMENSIONS}
    monkeypatch.setattr(warehouse, "settle", lambda rows, name: written.append(rows) or rows)
    fact = warehouse.init_sales_fact(store.read("sales"), star, t, t["isbn_rating"])
    assert not {"title", "full_name", "isbn13", "nyt_best_selling_category"} & set(written[0].columns)
    assert "avg_rating" in written[0].columns
    plain = warehouse.fill_avg_rating(warehouse.init_sales_fact(store.read("sales"), star, t), star["book_dim"], t["isbn_rating"])
    assert fact.columns == plain.columns and fact.collect() == plain.collect() == store.read("sales_fact").collect()
    assert fact.first()["avg_rating"] == Decimal("4.10")


def test_failed_run_leaves_failure_rows(spark, store):
    monthly.add_sales(store, incoming(spark, "9780000000001", category=None))
    with pytest.raises(checks.RejectedRows):
        monthly.process_monthly_sales(store, 1, 2026, RUN_TS)
    failed = store.read("etl_log").filter("rows_failed = 1")
    assert collect(failed, "details") == [("insert_monthly_sales",), ("update_nyt_bestseller_dim",)]
    assert monthly.load_status(store, 1, 2026) == 0


def test_failure_in_the_fact_step_changes_nothing_but_the_log(spark, store, monkeypatch):
    monthly.add_sales(store, incoming(spark, "9780000000001", "9780000000002"))
    before = store.paths()

    def broken(*args):
        raise ArithmeticError
    with monkeypatch.context() as patch:
        patch.setattr(monthly.warehouse, "monthly_fact", broken)
        with pytest.raises(ArithmeticError):
            monthly.process_monthly_sales(store, 1, 2026, RUN_TS)
    after = TableStore(spark, store.root).paths()
    assert {k for k in after if after[k] != before.get(k)} == {("etl_log", "")}
    failed = store.read("etl_log").filter("rows_failed = 1")
    assert collect(failed, "details", "rows_from_raw_data") == [("insert_monthly_sales", 0), ("load_sales_to_warehouse", 2)]
    monthly.process_monthly_sales(store, 1, 2026, RUN_TS + dt.timedelta(days=1))
    assert monthly.load_status(store, 1, 2026) == 2
    assert monthly.open_months(store) == []


def test_sales_without_a_month_are_rejected(spark, store):
    with pytest.raises(checks.RejectedRows, match="month"):
        monthly.add_sales(store, incoming(spark, "9780000000001").withColumn("month", F.lit(None).cast("int")))


def test_publisher_rename(spark, store):
    t = oltp(spark)
    publisher, dim, log = warehouse.rename_publisher(
        t["publisher"], store.read("book_dim"), "two dollar radio", "two dollar radio publishing", RUN_TS)
    assert collect(publisher, "publisher_id", "publisher") == [(1, "two dollar radio publishing"), (2, "viking")]
    open_ = dim.filter("current_flag")
    assert collect(open_, "book_dim_id", "book_isbn_id", "publisher") == [
        (3, 3, "viking"), (4, 1, "two dollar radio publishing"), (5, 2, "two dollar radio publishing")]
    assert collect(dim.filter("NOT current_flag"), "book_dim_id", "expire_date") == [
        (1, RUN_TS.date()), (2, RUN_TS.date())]
    assert collect(log, "details", "rows_inserted_to_dw") == [("publisher_update", 2)]
    per_book = dim.filter("current_flag").groupBy("book_isbn_id").count()
    assert per_book.filter("count <> 1").count() == 0


def test_book_dim_refresh(spark, store):
    t = oltp(spark)
    t["book"] = t["book"].withColumn("title", F.when(F.col("book_id") == 2, "second").otherwise(F.col("title")))
    dim = store.read("book_dim")
    assert warehouse.update_book_dim(dim, t, RUN_TS.date(), None).count() == 3
    refreshed = warehouse.update_book_dim(dim, t, RUN_TS.date(), None, refresh=True)
    assert collect(refreshed.filter("book_isbn_id = 2"), "book_title", "current_flag") == [
        ("second", True), ("two", False)]


# Invariants against brute force

quick = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe = st.none() | st.integers(0, 4)


@quick
@given(st.lists(st.tuples(maybe, maybe), max_size=8), st.lists(st.tuples(maybe, maybe), max_size=8))
def test_either_key_join(spark, left, right):
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(left)], "l int, a1 int, a2 int")
    b = spark.createDataFrame([(i, *p) for i, p in enumerate(right)], "r int, b1 int, b2 int")
    want = sorted((i, j) for i, (x, y) in enumerate(left) for j, (u, v) in enumerate(right)
                  if (x is not None and x == u) or (y is not None and y == v))
    assert collect(joins.either_key_join(a, b, [("a1", "b1"), ("a2", "b2")]), "l", "r") == want


@quick
@given(st.lists(st.tuples(maybe, maybe), max_size=8))
def test_membership_join(spark, facts):
    f = spark.createDataFrame([(i, *p) for i, p in enumerate(facts)], "f int, a1 int, a2 int")
    d = spark.createDataFrame([(k,) for k in range(4)], "id int")
    want = sorted((i, k) for i, p in enumerate(facts) for k in range(4) if k in p)
    assert collect(joins.membership_join(f, d, ["a1", "a2"], "id"), "f", "id") == want


@quick
@given(st.lists(maybe, max_size=30), st.integers(1, 4))
def test_salted_lookup(spark, values, hot_rows):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, k int")
    counts = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    got = collect(skew.salted_lookup(rows, counts, "k", "n", spread="i", hot_rows=hot_rows), "i", F.coalesce("n", F.lit(0)))
    assert got == [(i, 0 if v is None else values.count(v)) for i, v in enumerate(values)]


@quick
@given(st.sets(st.integers(0, 1 << 40), max_size=20), st.integers(0, 100))
def test_assign_ids(spark, places, start):
    df = spark.createDataFrame([(p,) for p in places], "p bigint")
    assert collect(keys.assign_ids(df, "id", ["p"], start), "p", "id") == [
        (p, start + i) for i, p in enumerate(sorted(places), 1)]


@quick
@given(st.lists(st.tuples(maybe, st.integers(0, 9)), max_size=20))
def test_keep_one_per(spark, rows):
    df = spark.createDataFrame([(k, i) for i, (k, _) in enumerate(rows)], "k int, _src_pos int")
    seen, want = set(), []
    for i, (k, _) in enumerate(rows):
        if k is None or k not in seen:
            want.append(i)
            seen.add(k)
    assert [i for (i,) in collect(dedup.keep_one_per(df, "k"), "_src_pos")] == want


@quick
@given(st.lists(st.text(alphabet=" \t\n \x1caB", max_size=8), min_size=1, max_size=6))
def test_text_is_idempotent(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    once = df.select("i", text.normalize_text(F.col("c")).alias("c"))
    twice = once.select("i", text.normalize_text(F.col("c")).alias("c"))
    assert collect(once, "i", "c") == collect(twice, "i", "c") == [
        (i, " ".join(v.lower().split())) for i, v in enumerate(values)]
