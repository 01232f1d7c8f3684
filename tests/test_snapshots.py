"""Snapshots: checked, logged and published together, or not at all."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.checks import RejectedRows
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import constraints, snapshot
from shelfmark.sources.tables import TableStore

RUN_TS = dt.datetime(2026, 1, 15, 12, 0)
ISBN = ("book_isbn_id long, isbn10 string, isbn13 string, book_id long, format_id long, publish_date date, original_publish_date date")


def tables(spark, isbns, books=((1, "a"), (2, "b")), ratings=((1, 1, 1, 5),)):
    others = {name: f"{name}_id long, {value} string" for name, value in
              [("edition", "edition"), ("publisher", "publisher"), ("language", "language"), ("series", "series_name")]}
    isbns = spark.createDataFrame(isbns, ISBN).withColumns({f"{name}_id": F.lit(None).cast("long") for name in others})
    return {name: spark.createDataFrame([], schema) for name, schema in others.items()} | {
            "book": spark.createDataFrame(list(books), "book_id long, title string"),
            "format": spark.createDataFrame([(1, "cloth")], "format_id long, format string"),
            "review_type": spark.createDataFrame([(1, "5_star")], "review_type_id long, review_type string"),
            "book_isbn": isbns,
            "isbn_rating": spark.createDataFrame(list(ratings), "isbn_rating_id long, book_isbn_id long, review_type_id long, count int")}


GOOD = [(1, None, "9780000000001", 1, 1, None, None), (2, "0000000001", None, 2, None, dt.date(2000, 1, 1), None)]


def rules(rejected):
    return sorted((r.table_name, r.rule, r.row_id) for r in rejected.collect())


def test_each_rule_finds_its_rows(spark):
    assert rules(constraints.check_tables(tables(spark, GOOD), RUN_TS.date())) == []
    bad = [(1, None, "9780000000001", 1, 1, None, None), (1, None, "9780000000001", 3, 1, None, None),
           (4, "12", None, None, 9, dt.date(2027, 1, 1), None), (None, None, None, 2, 1, None, None)]
    got = rules(constraints.check_tables(tables(spark, bad, ratings=[(1, 7, 2, -1), (2, 1, 1, None)]), RUN_TS.date(),
                                         only=["book_isbn", "isbn_rating"]).fillna(-9))
    assert got == sorted([
        ("book_isbn", "unique book_isbn_id", 1), ("book_isbn", "unique book_isbn_id", 1), ("book_isbn", "unique isbn13", 1),
        ("book_isbn", "unique isbn13", 1), ("book_isbn", "foreign book_id", 1), ("book_isbn", "foreign format_id", 4),
        ("book_isbn", "required", 4), ("book_isbn", "required", -9), ("book_isbn", "isbn", 4), ("book_isbn", "isbn", -9),
        ("book_isbn", "publish_date", 4), ("isbn_rating", "foreign book_isbn_id", 1), ("isbn_rating", "foreign review_type_id", 1),
        ("isbn_rating", "required", 2), ("isbn_rating", "rating", 1)])


def test_what_is_not_there_is_reported(spark):
    some = tables(spark, GOOD)
    del some["format"]
    some["book_isbn"] = some["book_isbn"].drop("publish_date")
    assert rules(constraints.check_tables(some, RUN_TS.date())) == [("book_isbn", "foreign format_id", None), ("book_isbn", "publish_date", None)]


def test_additions_are_checked_against_stored_keys(spark):
    stored = tables(spark, GOOD)
    new = {"book": spark.createDataFrame([(3, "c"), (2, "b")], "book_id long, title string"),
           "book_isbn": tables(spark, [(3, None, "9780000000001", 3, 1, None, None), (4, None, "9780000000004", 9, None, None, None),
                                       (5, None, "9780000000005", 3, 2, None, None)])["book_isbn"]}
    assert rules(constraints.check_additions(new, stored, RUN_TS.date())) == [
        ("book", "unique book_id", 2), ("book_isbn", "foreign book_id", 4), ("book_isbn", "foreign format_id", 5), ("book_isbn", "unique isbn13", 3)]
    with pytest.raises(RejectedRows):
        constraints.check_additions(new, stored, RUN_TS.date(), strict=True)


def test_additions_move_no_stored_rows_that_cannot_have_their_keys(spark, monkeypatch):
    stored = {"book": spark.createDataFrame([(i, f"t{i}") for i in range(1, 9)], "book_id int, title string"),
              "book_isbn": tables(spark, GOOD)["book_isbn"]}
    new = {"book": spark.createDataFrame([(8, "b"), (9, "c"), (9, "d")], "book_id int, title string")}
    assert rules(constraints.check_additions(new, stored, RUN_TS.date())) == [("book", "unique book_id", r) for r in (8, 9, 9)]
    isbns = {"book_isbn": tables(spark, [(7, None, "9780000000007", 8, None, None, None), (8, None, "9780000000008", 9, None, None, None)])["book_isbn"]}
    plans = []
    monkeypatch.setattr(constraints, "settle", lambda rows, name: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or settle(rows, name))
    assert [r for r in rules(constraints.check_additions(isbns, stored, RUN_TS.date())) if r[1].startswith("foreign book")] == [("book_isbn", "foreign book_id", 8)]
    # Stored ISBNs are cut down to the range of the new ids before they are grouped.
    (line,) = [line for line in plans[0].splitlines() if ">= 7" in line]
    assert "<= 8" in line


def test_a_table_is_read_three_times_for_all_its_rules(spark, tmp_path):
    some = tables(spark, GOOD)
    some["book_isbn"].write.parquet(str(tmp_path / "isbns"))
    some["book_isbn"] = spark.read.parquet(str(tmp_path / "isbns"))
    plan = constraints.check_table("book_isbn", some, RUN_TS.date())._jdf.queryExecution().optimizedPlan().toString()
    # The pass over the keys is written before; the other two are in the plan.
    assert plan.count("Relation [book_isbn_id") <= 2


def test_keys_are_counted_as_stored_values(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(constraints, "settle", lambda rows, name: written.setdefault(name, rows))
    assert constraints.check_table("book_isbn", tables(spark, GOOD), RUN_TS.date()).collect() == []
    plan = written["keys"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = {line.split("Aggregate [")[1].split("]")[0].split("#")[0] for line in plan if "Aggregate [" in line}
    assert {"isbn13", "isbn10", "book_id"} <= grouped and not {"rule", "key"} & grouped


@pytest.fixture
def store(spark):
    store = TableStore(spark, f"{shared_folder(spark)}/oltp-{uuid.uuid4().hex}")
    store.publish(tables(spark, GOOD))
    return store


def test_snapshot_logs_and_replaces(spark, store):
    new = tables(spark, GOOD, books=[(1, "a2"), (2, "b"), (3, "c")], ratings=[(1, 1, 1, 7)])
    snapshot.publish_snapshot(store, {name: new[name] for name in ("book", "isbn_rating")}, RUN_TS)
    again = TableStore(spark, store.root)
    assert sorted(r.log_message for r in again.read("book_logs").collect()) == ["Book Updated from a to a2", "New Book Added = 3"]
    assert [(r.old_count, r.new_count) for r in again.read("isbn_rating_logs").collect()] == [(5, 7)]
    snapshot.publish_snapshot(store, {"book": new["book"]}, RUN_TS)
    assert TableStore(spark, store.root).read("book_logs").count() == 2


@pytest.mark.parametrize("books", [((1, "a"),), ((1, "a"), (2, "b"), (2, "b"))])
def test_broken_snapshot_changes_nothing(spark, store, books):
    before = store.paths()
    with pytest.raises(RejectedRows):
        snapshot.publish_snapshot(store, {"book": tables(spark, GOOD, books=books)["book"]}, RUN_TS)
    assert TableStore(spark, store.root).paths() == before
