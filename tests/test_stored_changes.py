"""A further catalogue into filled tables, and deletes from them, on hand-made rows."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.checks import RejectedRows
from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import additions, cleaning, constraints, deletions, normalise
from shelfmark.schemas import CATALOGUE_COLUMNS
from shelfmark.sources.tables import TableStore

RUN_TS, LATER = dt.datetime(2026, 1, 15, 12, 0), dt.datetime(2026, 2, 1)


def catalogue(spark, *rows):
    schema = ", ".join(f"{c} string" for c in CATALOGUE_COLUMNS) + ", _src_pos bigint"
    full = []
    for pos, values in enumerate(rows):
        row = dict.fromkeys(CATALOGUE_COLUMNS) | {"bookId": f"b{pos}", "title": f"Title {pos}", "language": "English", "author": "Ann Lee"} | values
        full.append((*[row[c] for c in CATALOGUE_COLUMNS], pos))
    return settle(cleaning.run_cleaning(spark.createDataFrame(full, schema), 2026).coalesce(1), "cleaned")


FIRST = [{"isbn": "9780000000001", "title": "One", "author": "Ann Lee, Bo Poe (Editor)", "genres": "['Fantasy', 'Tea']", "publisher": "Tor",
          "ratingsByStars": "['5','4','3','2','1']"},
         {"isbn": "9780000000002", "title": "Two", "author": "Cy Doe", "publisher": "Ace", "language": "English"}]


@pytest.fixture(scope="module")
def loaded(spark):
    tables = normalise.normalise(catalogue(spark, *FIRST), RUN_TS, strict=True)
    return {name: settle(rows.coalesce(1), name) for name, rows in tables.items()}


@pytest.fixture
def store(spark, loaded):
    store = TableStore(spark, f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}")
    store.publish(loaded)
    return store


def ids(store, table, *columns):
    return sorted((tuple(r) for r in store.read(table).select(f"{table}_id", *columns).collect()), key=repr)


def test_second_load_keeps_ids_and_adds_rows(spark, store):
    before, old = store.paths(), {name: ids(store, name) for name in normalise.TABLE_NAMES}
    # Another order: a new book, a further edition of the first by title and author, and the second with a new contributor.
    more = [{"isbn": "9780000000009", "title": "Nine", "author": "Di Fox, Ann Lee", "publisher": "Tor", "genres": "['Poetry']"},
            {"isbn": "9780000000003", "title": "One", "author": "Ann Lee", "publisher": "Daw"},
            {"isbn": "9780000000002", "title": "Two, revised", "author": "Cy Doe, Eve Day", "genres": "['Tea']", "ratingsByStars": "['9','9','9','9','9']"},
            FIRST[0] | {"ratingsByStars": "['7','7','7','7','7']"}]
    additions.add_catalogue(store, catalogue(spark, *more), LATER)
    again = TableStore(spark, store.root)
    assert all(set(old[name]) <= set(ids(again, name)) for name in normalise.TABLE_NAMES)
    assert ids(again, "book", "title") == [(1, "one"), (2, "two"), (3, "nine")]
    assert ids(again, "book_isbn", "isbn13", "book_id") == [(1, "9780000000001", 1), (2, "9780000000002", 2), (3, "9780000000009", 3), (4, "9780000000003", 1)]
    assert [r[1] for r in ids(again, "author", "full_name")] == ["ann lee", "bo poe", "cy doe", "di fox", "eve day"]
    # Counts that are there stay.
    assert [r[1:] for r in ids(again, "isbn_rating", "book_isbn_id", "count") if r[1] == 1] == [(1, 5), (1, 4), (1, 3), (1, 2), (1, 1)]
    assert {r[1:] for r in ids(again, "isbn_rating", "book_isbn_id", "count") if r[1] == 2} == {(2, 9)}
    assert again.read("book").filter("title = 'nine'").first().updated_at == LATER
    assert [r.log_message for r in again.read("book_logs").collect()] == ["New Book Added = 3"]
    assert again.read("isbn_rating_logs").count() == 5
    # No file that was there is rewritten.
    assert all(set(paths) <= set(again.paths()[part]) for part, paths in before.items())
    tables = {name: again.read(name) for name in normalise.TABLE_NAMES}
    assert constraints.check_tables(tables, LATER.date()).collect() == []
    paths = again.paths()
    additions.add_catalogue(again, catalogue(spark, *more), LATER)
    assert again.paths() == paths
    additions.add_catalogue(again, catalogue(spark, {"isbn": None}), LATER)
    assert again.paths() == paths


def test_a_bad_second_load_changes_nothing(spark, store):
    before = store.paths()
    with pytest.raises(RejectedRows):
        additions.add_catalogue(store, catalogue(spark, {"isbn": "9780000000004", "publishDate": "April 1st 2026"}), dt.datetime(2026, 1, 16))
    assert TableStore(spark, store.root).paths() == before


def test_deletes_follow_the_parents(spark, store):
    before = store.paths()
    of_one = store.read("book_isbn").filter("isbn13 = '9780000000001'").select("publisher_id")
    counts = deletions.delete_rows(store, {"book": store.read("book").filter("title = 'two'"), "publisher": of_one}, LATER)
    assert counts == {"book": 1, "publisher": 1, "book_isbn": 1, "author_isbn": 1}
    again = TableStore(spark, store.root)
    (left,) = again.read("book_isbn").collect()
    assert (left.isbn13, left.publisher_id, left.updated_at) == ("9780000000001", None, LATER)
    assert {r.book_isbn_id for r in again.read("author_isbn").collect()} == {left.book_isbn_id}
    assert [r.log_message for r in again.read("book_logs").collect()] == ["Book Deleted = 2"]
    # Untouched tables keep their files.
    assert all(again.paths()[name, ""] == before[name, ""] for name in ("author", "genre", "isbn_rating", "book_isbn_genre", "language"))
    assert constraints.check_tables({n: again.read(n) for n in normalise.TABLE_NAMES}, LATER.date()).collect() == []


def test_deleted_ratings_are_logged_to_zero(spark, store):
    deletions.delete_rows(store, {"review_type": store.read("review_type").filter("review_type = '5_star'")}, LATER)
    assert [(r.operation_type, r.old_count, r.new_count) for r in store.read("isbn_rating_logs").collect()] == [("DELETE", 5, 0)]


def test_deletes_of_nothing(spark, store):
    before = store.paths()
    assert deletions.delete_rows(store, {"book": spark.range(77, 78).select(F.col("id").alias("book_id"))}, LATER) == {}
    assert store.paths() == before
    with pytest.raises(KeyError):
        deletions.delete_rows(store, {"shelf": store.read("book")}, LATER)


def test_books_of_one_name_are_looked_up_once(spark, monkeypatch):
    books = range(1, 31)
    stored = {"book_isbn": spark.createDataFrame([(i, i) for i in books], "book_isbn_id long, book_id long"),
              "book": spark.createDataFrame([(i, "one") for i in books], "book_id long, title string"),
              "author_isbn": spark.createDataFrame([(i, i, 1) for i in books], "author_isbn_id long, book_isbn_id long, author_id long"),
              "author": spark.createDataFrame([(1, "ann lee")], "author_id long, full_name string")}
    staging = spark.createDataFrame([(i, 100 + i, "one", "ann lee") for i in books] + [(99, 7, "two", None)],
                                    "_src_pos long, book_uid long, title_norm string, primary_author_name string")
    known = spark.createDataFrame([(2, 20, 20), (3, 31, 31)], "_src_pos long, book_isbn_id long, book_id long")
    plans = []
    monkeypatch.setattr(additions, "settle", lambda rows, name: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or settle(rows, name))
    got = {r.book_uid: r.book_id for r in additions.match_books(staging, stored, known, "_src_pos").collect()}
    assert got == {100 + i: {2: 20, 3: 31}.get(i, 1) for i in books} | {7: 31}
    # Each name has one row, the smallest id, before it is joined.
    assert any("Aggregate [title" in line and "min(book_id" in line for line in plans[0].splitlines())


def test_stored_contributors_are_left_out_while_they_are_grouped(spark):
    columns = [*normalise.AUTHOR_COLUMNS, *normalise.ROLE_COLUMNS]
    staging = spark.createDataFrame([(1, "a", "b", "a", "b", "c", "poet", None, "poet", None, None)],
                                    "_src_pos long, " + ", ".join(f"{c} string" for c in columns))
    link = spark.createDataFrame([(1, 5), (1, 6)], "_src_pos long, book_isbn_id long")
    author = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "author_id long, full_name string")
    role = spark.createDataFrame([(9, "poet")], "role_id long, role string")
    stored = spark.createDataFrame([(6, 1, 9), (6, 3, None)], "book_isbn_id long, author_id long, role_id long")
    rows = normalise.contributors(staging, link, author, role, stored=stored)
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == sorted(
        [(5, 1, 9, 1), (5, 2, None, 2), (5, 2, None, 4), (5, 3, None, 5), (6, 2, None, 2), (6, 2, None, 4)], key=repr)


def test_stored_ratings_are_left_out_while_they_are_grouped(spark):
    stars = ", ".join(f"`{star}` long" for star in normalise.STARS)
    staging = spark.createDataFrame([(1, 5, None, 3, 2, 1), (2, 9, 4, None, 2, 0)], f"_src_pos long, {stars}")
    link = spark.createDataFrame([(1, 5), (2, 5), (2, 6)], "_src_pos long, book_isbn_id long")
    stored = spark.createDataFrame([(6, 1), (6, 5), (7, 2)], "book_isbn_id long, review_type_id long")
    assert sorted(tuple(r) for r in normalise.ratings(staging, link, stored=stored).collect()) == [
        (5, 1, 9), (5, 2, 4), (5, 3, 3), (5, 4, 2), (5, 5, 1), (6, 2, 4), (6, 4, 2)]
    assert normalise.ratings(staging, link).schema["count"].dataType.simpleString() == "int"


@pytest.mark.parametrize("keys", [{"book": "book_id"}, None])
def test_added_rows_are_made_once(spark, keys):
    store = TableStore(spark, f"{shared_folder(spark)}/added-{uuid.uuid4().hex}", part_rows=10)
    store.publish({"book": spark.createDataFrame([(1, "a"), (11, "b")], "book_id long, title string")}, keys)
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    new = spark.createDataFrame([(12, "c"), (21, "d")], "book_id long, title string").mapInPandas(counted, "book_id long, title string")
    rows, before = store.add("book", new, "book_id"), store.paths()
    assert sorted(map(tuple, rows.collect())) == [(12, "c"), (21, "d")] and made.value == 2
    assert sorted(r.book_id for r in store.read("book").collect()) == [1, 11, 12, 21]
    assert store.add("book", new.filter("book_id > 99"), "book_id") is None and store.paths() == before
