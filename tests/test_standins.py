"""Queries make only the tables they read."""

import uuid

import pytest

from queries import load_all, normalised, registry, standins
from queries.registry import QUERIES, Inputs
from queries.star import star
from queries.standins import books

load_all()
SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def made(spark, monkeypatch):
    monkeypatch.setattr(registry, "STORED", {})
    return lambda: {name for _, _, name in registry.STORED}


def test_a_listing_of_series_makes_no_bridges(spark, made):
    QUERIES["r7_series_listing"](spark, SMOKE).collect()
    assert made() == {"book_isbn", "series"}


def test_unmatched_sales_need_no_fact(spark, made):
    QUERIES["h14_unmatched_sales"](spark, SMOKE).collect()
    assert "book_isbn_genre" not in made() and "isbn_rating" not in made()
    assert not {"sales_fact", "nyt_bestseller_dim"} & set(registry.STORED[spark.sparkContext.applicationId, SMOKE, "star"].made)


def test_tables_are_made_once(spark, made):
    t = Inputs(spark, SMOKE)
    assert books(t)["series"].inputFiles() == books(t)["series"].inputFiles()
    assert star(t)["book_dim"].inputFiles() == star(t)["book_dim"].inputFiles()
    assert set(star(t)) == {"month_year_dim", "author_dim", "book_dim", "nyt_bestseller_dim", "sales_fact"} and "genre" in books(t)


def test_orders_are_dealt_out_before_their_texts_are_made(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(standins, "settle", lambda rows, name: seen.append(rows) or rows)
    orders = spark.sql("SELECT id AS o_orderkey, id AS o_custkey, DATE '1998-05-01' AS o_orderdate FROM range(5)")
    part = spark.sql("SELECT id AS p_partkey, 'n' AS p_name, 't' AS p_type, 'b' AS p_brand FROM range(5)")
    inputs = Inputs(spark, f"no-such-folder-{uuid.uuid4().hex}")
    inputs.orders, inputs.part = orders, part
    assert standins.raw_books(inputs).count() == 5
    text = seen[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(text) if "RepartitionByExpression" in line)
    assert any("AS title" in line for line in text[:dealt]) and not any("AS title" in line for line in text[dealt:])


@pytest.mark.parametrize("name", ["author_isbn", "book_isbn_genre"])
def test_keys_are_made_distinct_before_the_rows_are_made(spark, made, monkeypatch, name):
    seen = []
    monkeypatch.setattr(standins, "settle", lambda rows, name: seen.append(rows) or rows)
    t = Inputs(spark, SMOKE)
    rows = books(t)[name]
    (grouped,) = [line for line in seen[0]._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert grouped.split("]")[0].count("#") == 2
    want = t.sql(standins.BOOKS[name])
    assert rows.schema == want.schema and rows.count() == want.count() and rows.exceptAll(want).count() == 0


def test_ids_of_a_checked_bridge_stand_once_with_many_suppliers(spark):
    def bridge(*pairs):
        lines = spark.createDataFrame(pairs, "l_partkey long, l_suppkey long")
        return spark.sql(standins.BOOKS["author_isbn"], lineitem=lines)

    few, many = bridge((1, 99999), (2, 0)), bridge((1, 100000), (2, 0), (2, 99999))
    assert many.select("author_isbn_id").distinct().count() == 2
    assert normalised.bridge_with_own_ids(many).select("author_isbn_id").distinct().count() == 3
    assert sorted(normalised.bridge_with_own_ids(few).drop("role_id").collect()) == sorted(few.drop("role_id").collect())
